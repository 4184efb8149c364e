import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", cpus="8", partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def house(spark):
    """Stored tables over the smallest test tables."""
    from checks.spark_queries import Data

    built = Data(spark, "/root/testdata/sf0.001").warehouse
    built.build(after=())
    return built


@pytest.fixture
def plan():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture(scope="session")
def local(spark):
    """Rows as a local table: its size is known and no Python worker is needed to read it."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    def make(rows, schema):
        schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        dicts = [r if isinstance(r, dict) else dict(zip(schema.names, r)) for r in rows]
        arrow = to_arrow_schema(schema)
        return spark.createDataFrame(pa.Table.from_pylist(dicts, schema=arrow), schema)

    return make


@pytest.fixture(scope="session")
def raw(local):
    """Rows of a raw table from dictionaries; what is not given is NULL."""
    from tallyhouse.schemas import RAW_TABLES

    def make(table, *rows):
        schema = RAW_TABLES[table].schema
        return local([{n: r.get(n) for n in schema.names} for r in rows], schema)

    return make
