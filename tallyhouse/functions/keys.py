"""Hash keys: the same inputs give the same key on every run and every cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def micros_text(ts: Column | str) -> Column:
    """``2024-01-31 08:15:00.250000``: always six digits, whatever the session time zone."""
    text = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz").cast("string")
    whole = F.length(text) == 19
    return F.rpad(F.when(whole, F.concat(text, F.lit("."))).otherwise(text), 26, "0")


def versioned_key(load_ts: Column | str, *parts: Column | str) -> Column:
    """SHA-256 of the business key followed by the load time; NULL counts as empty text.

    The parts are joined without a separator, which keeps keys compatible with the
    tables users already hold.
    """
    texts = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts]
    return F.sha2(F.concat(*texts, F.coalesce(micros_text(load_ts), F.lit(""))), 256)


def date_key(day: Column | str) -> Column:
    """SHA-256 of ``yyyymmdd``."""
    return F.sha2(F.date_format(day, "yyyyMMdd"), 256)


KEY_BYTES = 32  # of a SHA-256


def packed(key: Column | str) -> Column:
    """A hash key as its 32 bytes, half of its text, to travel through shuffles; any other text stands behind 33 zeros."""
    key = F.col(key) if isinstance(key, str) else key
    hashed = (F.length(key) == 2 * KEY_BYTES) & (F.lower(F.hex(F.unhex(key))) == key)
    return F.when(hashed, F.unhex(key)).otherwise(F.concat(F.lit(bytes(KEY_BYTES + 1)), key.cast("binary")))


def unpacked(key: Column | str) -> Column:
    """The text that :func:`packed` was given."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(F.length(key) == KEY_BYTES, F.lower(F.hex(key))).otherwise(F.substring(key, KEY_BYTES + 2, 1 << 30).cast("string"))


def beyond(key: Column | str, made: Column) -> Column:
    """What is left of a hash key beside the columns that it is made of, to travel with those through shuffles.

    NULL where the key is ``made``, no bytes for a missing key, :func:`packed` for any other.
    """
    key = F.col(key) if isinstance(key, str) else key
    other = F.coalesce(packed(key), F.lit(bytearray()))
    return F.when(key.eqNullSafe(made), F.lit(None).cast("binary")).otherwise(other)


def restored(left: Column | str, made: Column) -> Column:
    """The key that :func:`beyond` was given."""
    left = F.col(left) if isinstance(left, str) else left
    return F.when(left.isNull(), made).when(F.length(left) > 0, unpacked(left))


def is_hash_key(df: DataFrame, column: str) -> bool:
    """Whether a column holds hash keys as text, by its name and type."""
    return column.endswith("_key") and isinstance(df.schema[column].dataType, T.StringType)


def grouped(df: DataFrame, keys: Sequence[str], *sums: Column) -> DataFrame:
    """``df`` grouped by ``keys`` and ``sums`` of each group; hash keys cross the shuffle as bytes."""
    hashed = [f.name for f in df.schema.fields if f.name in keys and is_hash_key(df, f.name)]
    out = df.withColumns({k: packed(k) for k in hashed}).groupBy(*keys).agg(*sums)
    return out.withColumns({k: unpacked(k) for k in hashed})
