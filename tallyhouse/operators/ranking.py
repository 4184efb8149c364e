"""The best rows of each group, and sums on several levels at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.lookup import lookup


def best_of_each(df: DataFrame, groups: Sequence[str], measure: str, k: int, share: str | None = None) -> DataFrame:
    """Rows among the ``k`` highest of ``measure`` in their group, ties included, with ``rank`` and ``dense_rank``.

    Spark limits each group to its best k, ties included, before the shuffle: a group with a
    third of all rows sends k rows a map task. ``share`` names a column for the row's part of
    its group's total, which is added up on its own, one row a group. Rows without a measure
    come last.
    """
    order = Window.partitionBy(*groups).orderBy(F.desc_nulls_last(measure))
    best = df.withColumn("rank", F.rank().over(order)).filter(F.col("rank") <= k)
    best = best.withColumn("dense_rank", F.dense_rank().over(order))
    if not share:
        return best
    # one text for all group columns: a missing value is a group like any other
    name = F.to_json(F.struct(*groups), {"ignoreNullFields": "false"}).alias("__group")
    totals = df.groupBy(name).agg(F.sum(measure).alias("__total"))
    found = lookup(best.withColumn("__group", name), totals, "__group")
    part = F.col(measure).cast("double") / F.nullif(F.col("__total").cast("double"), F.lit(0.0))
    return found.withColumn(share, part).drop("__group", "__total")


def on_levels(
    df: DataFrame, levels: Mapping[str, Sequence[str]], sums: Mapping[str, Column], distinct: Mapping[str, str], level: str = "level"
) -> DataFrame:
    """One row for every group of every level: the level's name, its columns, ``sums`` and ``distinct`` counts.

    ``levels`` names the columns of each level, none for the total. The rows are first added
    up by the columns of all levels and the counted column: one pass, combined before the
    shuffle. The levels are grouping sets of those few sums, in which the counted column stays
    a key, so its distinct values are rows; a second grouping adds up both. Columns that do
    not belong to a row's level are NULL there; the level's name tells them from missing values.

    Several counted columns take a pass of their own each over the finest sums.
    """
    columns = list(dict.fromkeys(c for names in levels.values() for c in names))
    counted = list(dict.fromkeys(distinct.values()))
    finest = df.groupBy(*columns, *counted).agg(*[c.alias(n) for n, c in sums.items()])
    sets = F.array(*[F.struct(F.lit(n).alias(level), *[(F.col(c) if c in names else F.lit(None).cast(df.schema[c].dataType)).alias(f"__{c}") for c in columns])
                     for n, names in levels.items()])
    spread = finest.select(*counted, *sums, F.explode(sets).alias("__s")).select(
        *counted, *sums, f"__s.{level}", *[F.col(f"__s.__{c}").alias(c) for c in columns])
    groups = [level, *columns]
    out = None
    for i, column in enumerate(counted):
        once = spread.groupBy(*groups, column).agg(*[F.sum(n).alias(n) for n in (sums if not i else [])])
        names = [n for n, c in distinct.items() if c == column]
        part = once.groupBy(*groups).agg(*[F.sum(n).alias(n) for n in (sums if not i else [])], *[F.count(column).alias(n) for n in names])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spread.groupBy(*groups).agg(*[F.sum(n).alias(n) for n in sums])
    return out if len(counted) == 1 else out.groupBy(*groups).agg(*[F.max(n).alias(n) for n in [*sums, *distinct]])
