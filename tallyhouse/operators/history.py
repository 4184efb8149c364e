"""Dimension history: versions with start and end, and the version that held at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.latest import keep_latest
from tallyhouse.operators.lookup import small
from tallyhouse.operators.ordered import chunked, neighbours, numbered
from tallyhouse.schemas import FILE_NAME, LOAD_TS, ROW_NUMBER

START, END, CURRENT = "effective_start_ts", "effective_end_ts", "is_current"


def open_end() -> Column:
    """End of a version that is still in use (fixed value)."""
    return F.lit("9999-12-31 23:59:59").cast("timestamp_ntz")


def only_version(load_ts: str) -> list[Column]:
    """Version columns of a dimension that keeps just the newest row of each key."""
    return [F.col(load_ts).alias(START), open_end().alias(END), F.lit(True).alias(CURRENT)]


def history(
    df: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    order: Sequence[str] = (LOAD_TS, ROW_NUMBER, FILE_NAME),
    skew_bytes: int | None = None,
) -> DataFrame:
    """One row per version of a key: reloads that change none of ``tracked`` are dropped.

    A version ends where the next one of its key starts, the last one is current. Of rows
    with one key and one time (the first column of ``order``) the last counts, as everywhere;
    so no version is empty, and copies, which map tasks drop first, are no versions.
    """
    state = F.struct(*tracked)
    df = keep_latest(df, [*keys, order[0]], order[1:] or order)
    seen = neighbours(
        chunked(df, keys, order, skew_bytes), keys, order,
        {"__before": ("previous", state), "__known": ("previous", F.lit(True))},
    )
    changed = seen.filter(F.col("__known").isNull() | ~F.col("__before").eqNullSafe(state))
    dated = neighbours(
        changed.drop("__before", "__known"), keys, order, {"__next": ("next", F.col(order[0]))}
    )
    return dated.select(
        *df.columns,
        F.col(order[0]).alias(START),
        F.coalesce("__next", open_end()).alias(END),
        F.col("__next").isNull().alias(CURRENT),
    )


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    how: str = "inner",
    skew_bytes: int | None = None,
) -> DataFrame:
    """Each fact with ``columns`` of the version of its key that held at time ``at``.

    Facts and versions are put in one time order per key and the newest version is
    carried forward, so the work is linear in both: no fact meets more than one
    version, and a hot key is cut into chunks. Facts are expected to carry a unique key.
    Of versions that start together the one that ends last holds.
    """
    version = F.struct(*columns, F.col(END).alias("__end"))
    events = versions.select(
        F.col(key), F.col(START).alias("__at"), F.lit(0).alias("__kind"), F.col(END).alias("__until"),
        version.alias("__version"))
    wanted = facts.select(
        F.col(key), F.col(at).alias("__at"), F.lit(1).alias("__kind"), F.struct(*facts.columns).alias("__fact"))
    both = events.unionByName(wanted, allowMissingColumns=True)
    order = ["__at", "__kind", "__until"]
    cut = chunked(both, [key], order, skew_bytes, spread=[F.xxhash64("__fact")])
    carried = neighbours(cut, [key], order, {"__held": ("carried", F.col("__version"))})
    found = carried.filter("__kind = 1").withColumn(
        "__held", F.when(F.col("__at") < F.col("__held.__end"), F.col("__held")))
    if how == "inner":
        found = found.filter("__held is not null")
    return found.select("__fact.*", *[F.col(f"__held.{c}") for c in columns])


def first_moment() -> Column:
    """Before every version."""
    return F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")


def intersected(
    left: DataFrame, right: DataFrame, ref: str, columns: Sequence[str], how: str = "inner", skew_bytes: int | None = None
) -> DataFrame:
    """Versions of ``left`` cut where the version of the row they refer to changes.

    Both have START and END; versions of one ``ref`` on the right do not overlap. Each piece
    carries ``columns`` of the version on the right that holds then; where none does the piece
    is dropped, or with ``how="left"`` kept with NULLs.

    The versions on the right are completed by empty ones, so that each moment has exactly one,
    and numbered in order. One sweep over the borders of both sides, sorted by time within a
    ref, gives every left version the numbers that hold at its start and before its end; the
    pieces are then an equi-join on ref and number. So no pair is looked at that is no piece,
    and a ref that a third of all rows share is cut into chunks like any other hot key.
    """
    held = right.select(F.col(ref), START, END, F.struct(*columns).alias("__held"))
    lined = neighbours(
        chunked(held, [ref], [START], skew_bytes), [ref], [START],
        {"__next": ("next", F.col(START)), "__known": ("previous", F.lit(True))})
    none = F.lit(None).cast(held.schema["__held"].dataType)
    own = F.struct(F.col(START).alias("s"), F.col(END).alias("e"), F.col("__held").alias("v"))
    gap = lambda s, e: F.struct(s.alias("s"), e.alias("e"), none.alias("v"))
    until = F.coalesce("__next", open_end())
    pieces = F.filter(F.array(
        F.when(F.col("__known").isNull() & (F.col(START) > first_moment()), gap(first_moment(), F.col(START))), own,
        F.when(F.col(END) < until, gap(F.col(END), until))), lambda p: p.isNotNull())
    line = lined.select(ref, F.explode(pieces).alias("__p")).select(ref, F.col("__p.s").alias("__at"), F.col("__p.e").alias("__until"), F.col("__p.v").alias("__held"))
    line = numbered(chunked(line, [ref], ["__at"], skew_bytes), [ref], ["__at"], "__number").select(ref, "__at", "__until", "__held", "__number")

    # at one moment: what ends there still sees the version before, what starts there the new one
    whole = F.struct(*left.columns)
    starts = left.select(F.col(ref), F.col(START).alias("__at"), F.lit(2).alias("__kind"), whole.alias("__row"))
    ends = left.select(F.col(ref), F.col(END).alias("__at"), F.lit(0).alias("__kind"), whole.alias("__row"))
    borders = line.select(F.col(ref), "__at", F.lit(1).alias("__kind"), "__number")
    both = starts.unionByName(ends).unionByName(borders, allowMissingColumns=True)
    order = ["__at", "__kind"]
    cut = chunked(both, [ref], order, skew_bytes, spread=[F.xxhash64("__row")])
    swept = neighbours(cut, [ref], order, {"__holds": ("carried", F.col("__number"))}).filter("__kind <> 1")
    number = lambda kind: F.max(F.when(F.col("__kind") == kind, F.col("__holds")))
    ranges = swept.groupBy("__row").agg(number(2).alias("__first"), number(0).alias("__last"))
    spread = ranges.select("__row", F.col(f"__row.{ref}").alias("__ref"), F.explode(F.when(
        F.col("__first").isNotNull(), F.sequence("__first", "__last")).otherwise(F.array(F.lit(0).cast("long")))).alias("__wanted"))
    other = line.withColumnRenamed(ref, "__other")
    same = (F.col("__ref") == F.col("__other")) & (F.col("__wanted") == F.col("__number"))
    out = spread.join(F.broadcast(other) if small(right) else other, same, "left")
    if how == "inner":
        out = out.filter("__held is not null")
    kept = [c for c in left.columns if c not in (START, END, CURRENT)]
    starting = F.greatest(F.col(f"__row.{START}"), F.coalesce("__at", first_moment()))
    ending = F.least(F.col(f"__row.{END}"), F.coalesce("__until", open_end()))
    return out.select(*[F.col(f"__row.{c}") for c in kept], *[F.col(f"__held.{c}") for c in columns], starting.alias(START), ending.alias(END))


def merged(pieces: DataFrame, keys: Sequence[str], tracked: Sequence[str], skew_bytes: int | None = None) -> DataFrame:
    """Pieces of versions that follow each other without a gap and without a change, made one version.

    Pieces of a key do not overlap. The version that has no end is the current one.
    """
    state = F.struct(*tracked)
    seen = neighbours(
        chunked(pieces, keys, [START], skew_bytes), keys, [START],
        {"__before": ("previous", F.struct(state.alias("state"), F.col(END).alias("until"))), "__after": ("next", F.lit(True))})
    first = F.col("__before").isNull() | ~F.col("__before.state").eqNullSafe(state) | (F.col("__before.until") < F.col(START))
    # of each version its first piece, and of each key the last one, which tells where the last version ends
    edges = seen.withColumn("__first", first).filter(F.col("__first") | F.col("__after").isNull())
    dated = neighbours(
        edges.withColumn("__until", F.col("__before.until")).drop("__before", "__after"), keys, [START],
        {"__next": ("next", F.struct("__first", "__until", F.col(END).alias("end")))}).filter("__first")
    end = F.when(F.col("__next").isNull(), F.col(END)).when(F.col("__next.__first"), F.col("__next.__until")).otherwise(F.col("__next.end"))
    return dated.withColumn(END, end).select(*keys, *tracked, START, END, (F.col(END) >= open_end()).alias(CURRENT))
