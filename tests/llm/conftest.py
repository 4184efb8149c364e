import pytest
from pyspark.sql import functions as F

from tallyhouse.llm.common import documents

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, _rest string, shard string, words long, spans string"


@pytest.fixture(scope="session")
def docs(spark):
    """200 documents, as they are given."""
    return documents(spark, SF).cache()


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def messy(spark, docs):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    prose = docs.orderBy(F.length("text").desc()).select("text").limit(3).collect()
    long_, other = prose[0].text, prose[1].text
    rows = [
        (None, None, None, None, None), (None, "", None, "s", 0), (1, None, "en", None, None), (2, "", "en", "s", 0),
        (3, " \t\n ", None, None, 4), (4, "one", "en", "s", 3), (4, "one", "en", "s", 3), (4, "one two", "de", "s", 7),
        (5, long_ * 20, "en", "s", None), (6, other, "en", "s", None), (7, other, "en", "s", None), (None, other, "en", "s", None),
        (8, other[: len(other) // 2], None, "s", None), (9, "é" * 3000, "fr", "s", None), (10, "x" * 50_000, "en", "s", None),
        (11, "password = 'abc12345' <|endoftext|> 12 34", "en", "s", None), (12, "123 456 !!", None, None, None), (13, other.upper(), "en", None, None),
    ]
    return spark.createDataFrame([r + ("a", "b", "c", 1, "d") for r in rows], SCHEMA).cache()


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)
