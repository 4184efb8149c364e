"""Sinks: append, replace, replace single partitions, bucketed tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every load of an append-only table keeps a folder of its own, whoever writes it.
LOAD = "load"


def append(df: DataFrame, path: str, load: str | None = None) -> None:
    """Add rows to an append-only table; a load that is named again replaces itself."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{LOAD}={load or uuid.uuid4().hex}")


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace a table and read it back.

    Partitioned tables are rebalanced on the partition columns first: small partitions
    share a task and a large one is split over several, so neither tiny files nor one
    overloaded task come out.
    """
    writer = balanced(df, partition_by).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return read(df.sparkSession, path, df.schema)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows for; all others stay."""
    (balanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def save_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Catalog table hashed and sorted on ``keys``: joins on the keys need no shuffle.

    All rows of a key value lie in one bucket. Where a value may hold a large share of the
    rows, a plain table and adaptive execution's split of skewed partitions serve better.
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders below ``path`` whose write was committed."""
    found = matching(spark, f"{path}/*/_SUCCESS")
    return sorted(int(p.getParent().getName()) for p in found)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders with all that is in them."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name, if there is such a folder."""
    place, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(place):
        files.rename(place, target)


def exists(spark: SparkSession, path: str) -> bool:
    return bool(matching(spark, path))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of text."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a small file of text; it appears under its name when it is complete."""
    place, draft = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.draft"))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files.delete(place, False)
    files.rename(draft, place)


def matching(spark: SparkSession, pattern: str) -> list:
    """Paths that fit a pattern."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath() for status in found or []]


def balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in columns]) if columns else df
