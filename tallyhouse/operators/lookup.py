"""Equi-joins from many rows to at most one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import runtime


def small(df: DataFrame, limit: int | None = None) -> bool:
    return runtime.source_bytes(df) <= (runtime.BROADCAST_BYTES if limit is None else limit)


def lookup(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str = "inner",
    *,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Join ``many`` to ``one`` on ``key``; ``one`` holds each key at most once.

    If ``one`` is read from few bytes it is broadcast and ``many`` is not shuffled; Spark's
    own estimate multiplies the sizes of joined tables and would miss that. Otherwise both
    sides are shuffled on the key, and adaptive execution picks a broadcast or splits the
    partition of a hot key from the sizes it measures.
    """
    return many.join(F.broadcast(one) if small(one, broadcast_bytes) else one, key, how)
