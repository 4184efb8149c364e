"""Values of neighbouring rows within a key, also for keys too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse import runtime

CHUNK = "__chunk"


def chunked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    skew_bytes: int | None = None,
    spread: Sequence[Column] = (),
) -> DataFrame:
    """``df``, cut into bounded chunks along (keys, order) where it is large.

    A small input comes back as it is. A large one is range-partitioned, so a key with a
    third of all rows covers many chunks, and written once with its chunk number: the
    chunk borders come from a sample and must stay the same for every later step.
    ``spread`` orders rows that are equal in (keys, order), where their order is free.
    """
    if not runtime.may_be_skewed(df, skew_bytes):
        return df
    pieces = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), runtime.pieces(df))
    ranged = df.repartitionByRange(pieces, *[F.col(c).asc_nulls_first() for c in (*keys, *order)], *spread)
    return runtime.stored(ranged.withColumn(CHUNK, F.spark_partition_id()))


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Add columns taken from other rows of the same key, in the given order.

    ``values`` maps a new name to ``("previous" | "next" | "carried", expression)``;
    ``carried`` is the last non-NULL value up to and including the row. ``df`` comes
    from :func:`chunked`; every window covers one key within one chunk.
    """
    groups = [*keys, CHUNK] if CHUNK in df.columns else list(keys)
    w = Window.partitionBy(*groups).orderBy(*[F.asc_nulls_first(c) for c in order])
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a struct keeps "the neighbour holds NULL" apart from "there is no neighbour"
    packed = {
        name: F.when(value.isNotNull(), F.struct(value.alias("v"))) if kind == "carried" else F.struct(value.alias("v"))
        for name, (kind, value) in values.items()
    }
    reach = {
        "previous": lambda p: F.lag(p).over(w),
        "next": lambda p: F.lead(p).over(w),
        "carried": lambda p: F.last(p, ignorenulls=True).over(so_far),
    }
    near = df.select("*", *[reach[kind](packed[n]).alias(f"__{n}") for n, (kind, _) in values.items()])
    if CHUNK not in df.columns:
        return near.select(*df.columns, *[F.col(f"__{n}.v").alias(n) for n in values])

    far = _beyond_chunk(df, keys, order, values, packed)
    same = [F.col(f"n.{CHUNK}") == F.col(f"f.{CHUNK}"), *[F.col(f"n.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]]
    joined = near.alias("n").join(far.alias("f"), reduce(lambda a, b: a & b, same), "left")
    return joined.select(
        *[F.col(f"n.{c}") for c in df.columns],
        *[F.coalesce(F.col(f"n.__{n}"), F.col(f"f.{n}"))["v"].alias(n) for n in values],
    )


def _beyond_chunk(df, keys, order, values, packed) -> DataFrame:
    """What each key finds outside a chunk, for keys that span chunks: at most two rows per chunk."""
    position = F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in order])
    edge = {
        "previous": lambda p: F.max_by(p, position),
        "next": lambda p: F.min_by(p, position),
        "carried": lambda p: F.max_by(p, F.when(p.isNotNull(), position)),
    }
    edges = df.groupBy(*keys, CHUNK).agg(*[edge[kind](packed[n]).alias(n) for n, (kind, _) in values.items()])
    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    step = {
        "previous": lambda n: F.lag(n).over(by_chunk),
        "next": lambda n: F.lead(n).over(by_chunk),
        "carried": lambda n: F.last(n, ignorenulls=True).over(earlier),
    }
    spans = F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("__spans")
    found = edges.select(*keys, CHUNK, spans, *[step[kind](n).alias(n) for n, (kind, _) in values.items()])
    return found.filter("__spans > 1").drop("__spans")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` with the position of each row among those of its key, from 1 on, in the given order.

    ``df`` comes from :func:`chunked`. A key that covers many chunks is numbered within each;
    what the chunks before hold is added, one row per key and chunk.
    """
    groups = [*keys, CHUNK] if CHUNK in df.columns else list(keys)
    w = Window.partitionBy(*groups).orderBy(*[F.asc_nulls_first(c) for c in order])
    near = df.withColumn(name, F.row_number().over(w).cast("long"))
    if CHUNK not in df.columns:
        return near
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("__rows"))
    before = counts.select(*groups, F.sum("__rows").over(earlier).alias("__before")).filter("__before is not null")
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"b.{k}")) for k in groups]
    joined = near.alias("n").join(before.alias("b"), reduce(lambda a, b: a & b, same), "left")
    return joined.select(*[F.col(f"n.{c}") for c in df.columns], (F.col(f"n.{name}") + F.coalesce("b.__before", F.lit(0))).alias(name))
