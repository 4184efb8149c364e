"""Reading documents, unique row keys, word and byte hashes, scratch tables."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.runtime import scratch_dir

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text that one numpy pass looks at; longer documents get a pass of their own.
PASS_BYTES = 1 << 21


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def kept_table(df: DataFrame) -> DataFrame:
    """``df`` written once below the shared checkpoint folder: later jobs read the files again."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts, one narrow pass."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def shards_for(total: int, each: int) -> int:
    return max(1, -(-total // each))


def keyed(docs: DataFrame, rest: bool = False) -> DataFrame:
    """``_row``, ``doc_id``, ``text`` with a unique, never null ``_row`` in the order of doc_id.

    With ``rest``, also ``_rest``: all columns as they came. Where ids are unique and not null, ``_row`` is the id. Otherwise rows are sorted by id
    (null first) and text, numbered, and written once so that every later job sees the
    same numbers; equal rows get different numbers.
    """
    whole = [F.struct(*docs.columns).alias("_rest")] if rest else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *whole)
    rows, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if rows == ids:
        return docs.select(F.col("doc_id").alias("_row"), "*")
    ordered = docs.orderBy(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return kept_table(ordered.select(F.monotonically_increasing_id().alias("_row"), "*"))


def crc_of_id(column: str = "doc_id") -> Column:
    """CRC-32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves every bit of the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n + n // 4, 1 << 18)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums over bytes; slices of them give hashes of substrings."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SYMBOL[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes [start, end); equal bytes have equal hashes."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def passes(texts: list[bytes], limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes, one document at least."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def binary_texts(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def text_ranges(column: pa.Array, limit: int) -> Iterator[tuple[int, list[bytes]]]:
    """The first row and the texts of ranges of about ``limit`` bytes; only one range at a time is held as objects."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > limit:
            yield first, binary_texts(column.slice(first, i - first))
            first, size = i, 0
        size += n + 1
    if first < len(column):
        yield first, binary_texts(column.slice(first))


def text_parts(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut in front of a space."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of documents, A-Z lower-cased: bytes, starts, ends, and the document of each word."""
    data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    space = np.empty(len(data) + 2, bool)
    space[0] = space[-1] = True
    space[1:-1] = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    borders = np.cumsum([len(t) + 1 for t in texts])
    return data, starts, ends, np.searchsorted(borders, starts, side="right")


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of documents, and the document of each."""
    data, starts, ends, owner = word_spans(texts)
    return span_hashes(prefix_hashes(data), starts, ends), owner


def give_back() -> None:
    """Return freed memory to the system: after large arrays a worker's allocator keeps blocks of up to 32 MB each."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # only some C libraries have it
        pass


def crc(data) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
