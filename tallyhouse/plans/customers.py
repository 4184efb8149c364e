"""Customers of each day and place as bitmaps, for distinct counts over any span of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.keys import packed, unpacked
from tallyhouse.operators import bitmaps
from tallyhouse.operators.lookup import lookup
from tallyhouse.plans.summaries import PLACE
from tallyhouse.streaming.jobs import MONTH

KEY = "customer_dim_key"


def customer_numbers(dim_customer: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return bitmaps.numbers(dim_customer, KEY, known)


def customer_days(customers: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bitmaps of a day, country, channel and currency, from the customers of stored groups.

    A customer of several stores sets the same bit more than once. Hash keys cross the
    shuffles as bytes.
    """
    keys = ["date_dim_key", "country_dim_key"]
    held = customers.select(MONTH, "date_dim_key", *PLACE, KEY).withColumns({k: packed(k) for k in [*keys, KEY]})
    days = bitmaps.bitmaps(lookup(held, numbers.withColumn(KEY, packed(KEY)), KEY), [MONTH, "date_dim_key", *PLACE])
    return days.withColumns({k: unpacked(k) for k in keys})


def unique_customers(days: DataFrame, dim_date: DataFrame, by: Sequence[str | Column] = (), within: Column | None = None) -> DataFrame:
    """Distinct customers of the days that meet ``within``, a condition on the columns of the date dimension.

    ``by`` are columns of the stored bitmaps or of the date dimension. Reads bitmaps only,
    and of those only the months that hold such a day.
    """
    wanted = dim_date if within is None else dim_date.filter(within)
    if within is not None:
        months = [r[0] for r in wanted.select(F.date_format("date_key", "yyyy-MM")).distinct().collect()]
        days = days.filter(F.col(MONTH).isin(months))
    days = lookup(days, wanted, "date_dim_key")
    return bitmaps.distinct_of(days, by, "unique_customers")
