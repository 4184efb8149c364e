"""Distinct counts that merge: sets of numbered keys as bitmaps.

Keys get dense numbers once. A group's keys are then bits, kept in pieces of 64 numbers that
hold a key, and the distinct keys of any union of groups are the bits of the pieces put
together with OR. A piece is one long: it is aggregated in place, without a sort, and a group of
few keys among many numbers takes few bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.ordered import CHUNK, numbered
from tallyhouse.runtime import stored

NUMBER, PIECE, BITS = "number", "piece", "bits"


def numbers(keys: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``column`` and its ``number``, from 1 on without holes; keys already ``known`` keep theirs.

    New keys are dealt to partitions by a hash and numbered within each, from where the
    partitions before end, so no task sees them all. They are written once with their
    partition, which must not change between counting and numbering.
    """
    wanted = keys.select(column).filter(F.col(column).isNotNull()).distinct()
    first = 0
    if known is not None:
        wanted = wanted.join(known.select(column), column, "left_anti")
        first = known.agg(F.max(NUMBER)).first()[0] or 0
    dealt = stored(wanted.repartition(column).withColumn(CHUNK, F.spark_partition_id()))
    new = numbered(dealt, [], [column], NUMBER).select(column, (F.col(NUMBER) + first).alias(NUMBER))
    return new if known is None else known.select(column, NUMBER).unionByName(new)


def bitmaps(rows: DataFrame, by: Sequence[str], number: str = NUMBER) -> DataFrame:
    """The numbers of each group as pieces of bits."""
    piece = F.shiftright(F.col(number), 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(number).bitwiseAND(63).cast("int"))
    return rows.groupBy(*by, piece.alias(PIECE)).agg(F.bit_or(bit).alias(BITS))


def distinct_of(pieces: DataFrame, by: Sequence[str | Column], name: str) -> DataFrame:
    """Distinct keys of the groups ``by``, each put together from any number of stored groups.

    Pieces are put together before the shuffle, so a group that many rows belong to sends
    one piece a map task for each 64 numbers.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in by]
    names = [c if isinstance(c, str) else f"__{i}" for i, c in enumerate(by)]
    merged = pieces.groupBy(*[c.alias(n) for c, n in zip(columns, names)], PIECE).agg(F.bit_or(BITS).alias(BITS))
    return merged.groupBy(*names).agg(F.sum(F.bit_count(BITS)).alias(name))
