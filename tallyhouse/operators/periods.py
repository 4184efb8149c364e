"""Comparison of a period with the one before and with the same one a year earlier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_index(year: str, month: str) -> Column:
    return F.col(year) * 12 + F.col(month) - 1


def week_index(first_day: str) -> Column:
    """Weeks since Monday 1970-01-05: steps by one over year ends too."""
    return F.floor(F.datediff(F.col(first_day), F.lit("1970-01-05").cast("date")) / 7)


def year_index(year: str) -> Column:
    return F.col(year)


def with_changes(
    df: DataFrame,
    within: Sequence[str],
    index: Column,
    measure: str,
    steps: dict[str, int],
) -> DataFrame:
    """For each name in ``steps``: the measure that many periods earlier and the change since.

    A missing period stays missing: the frame reaches exactly one period index, so a gap
    is not bridged by the next older row. ``df`` is an aggregate with one row per period
    in each group, so a group is never longer than the number of periods.
    """
    at = df.withColumn("__index", index.cast("long"))
    by_period = Window.partitionBy(*within).orderBy("__index")
    earlier = {name: F.sum(measure).over(by_period.rangeBetween(-n, -n)) for name, n in steps.items()}
    out = at.select("*", *[c.alias(f"{name}_{measure}") for name, c in earlier.items()]).drop("__index")
    for name in steps:
        before = F.col(f"{name}_{measure}")
        out = out.withColumn(f"{name}_change", F.col(measure) - before)
        out = out.withColumn(
            f"{name}_ratio",
            F.when(before != 0, (F.col(measure) - before).cast("double") / before.cast("double")))
    return out
