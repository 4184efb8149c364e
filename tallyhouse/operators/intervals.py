"""Joins of points with the intervals that hold them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.lookup import small

STEP = 8  # bins that an interval may cover on its level; the next level's bins are so many times as wide
LEVELS = 20  # levels at most
NEVER = 1 << 58  # after every time and number that can be joined


def position(column: str, kind: T.DataType) -> Column:
    """A date, time or number as a long; the order stays."""
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("long")


def interval_join(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, on: Sequence[str] = (), width: int | None = None
) -> DataFrame:
    """Each point with every interval that holds it: ``start <= at < end``, and equal columns ``on``.

    Time is cut into bins, and bin and ``on`` are an equi-join; the exact test follows. Bins are
    as wide as a usual interval is long. A longer interval goes to a level of wider bins, where
    it covers ``STEP`` + 1 at most, and a point looks into its one bin of every level in use. So
    an interval over all time is one row on a high level and meets the points it holds, no more;
    and the work is the points times the levels, plus what shares a bin.

    A missing ``end`` never comes, a missing ``start`` or ``at`` matches nothing, an empty
    interval holds nothing. The three are of one kind, dates, times or whole numbers below
    ``NEVER``. Columns of both sides must differ, but for ``on``.
    """
    kind = points.schema[at].dataType
    now, first = position(at, kind), position(start, intervals.schema[start].dataType)
    last = F.coalesce(position(end, intervals.schema[end].dataType) - 1, F.lit(NEVER))
    held = intervals.filter(F.col(start).isNotNull()).withColumns({"__first": first, "__last": last}).filter("__last >= __first")
    if width is None:
        usual = held.filter(F.col(end).isNotNull()).agg(F.percentile_approx(F.col("__last") - F.col("__first") + 1, 0.5, 1000)).first()[0]
        width = max(1, -(-(usual or 1) // (STEP // 2)))
    widths = [width * STEP**k for k in range(LEVELS) if width * STEP**k <= 1 << 56]
    span = F.col("__last") - F.col("__first")
    level = F.lit(len(widths) - 1)
    for k in reversed(range(len(widths) - 1)):
        level = F.when(span <= widths[k] * STEP, k).otherwise(level)
    wide = lambda k: F.element_at(F.array(*[F.lit(w).cast("long") for w in widths]), k + 1)
    held = held.withColumn("__level", level).withColumn("__width", wide(F.col("__level")))
    bins = lambda x, w: F.expr(f"({x} - pmod({x}, {w})) div {w}")
    spread = held.withColumn("__bin", F.explode(F.sequence(bins("__first", "__width"), bins("__last", "__width"))))
    used = sorted(r[0] for r in held.select("__level").distinct().collect())  # LEVELS at most
    if not used:
        used = [0]
    levels = F.array(*[F.struct(F.lit(k).alias("__level"), F.lit(widths[k]).cast("long").alias("__width")) for k in used])
    asked = points.filter(F.col(at).isNotNull()).withColumn("__at", now).select("*", F.explode(levels).alias("__l")).select(
        "*", "__l.__level", "__l.__width").drop("__l")
    asked = asked.withColumn("__bin", bins("__at", "__width")).drop("__width")
    other = spread.drop("__width")
    joined = asked.join(F.broadcast(other) if small(intervals) else other, [*on, "__level", "__bin"])
    kept = joined.filter("__at >= __first and __at <= __last")
    names = [*points.columns, *[c for c in intervals.columns if c not in on]]
    return kept.select(*names)
