"""Daily, weekly and monthly summaries of the transaction fact.

Sales are grouped by keys alone; the descriptive columns are joined to the groups, which
are few, instead of to every sale. Distinct customers do not add up over periods, so they are
counted from the customers of each group. Groups and their customers can be stored and kept
up to date by adding sales that came and taking off those that went.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import iso_year
from tallyhouse.functions.keys import grouped
from tallyhouse.operators.lookup import lookup

GEOGRAPHY = ["country_code", "country_name", "region_code", "region_name"]
PLACE = ["country_dim_key", "channel_id", "currency"]
GROUP = ["date_dim_key", "store_dim_key", *PLACE]
AMOUNTS = {"total_gross_amount": "gross_amount", "total_discount": "total_discount", "total_tax": "total_tax", "total_net_sales": "net_total"}
WEEK = (["year_number", "week_number"], "week_start_date", "week_end_date")  # columns of the period, names of its first and last day
CALENDAR_MONTH = (["year_number", "month_number", "year_month", "month_name", "quarter_number", "year_quarter", "fiscal_year", "fiscal_quarter"],
                  "month_start_date", "month_end_date")
COUNTS = {total: f"{total}_rows" for total in AMOUNTS}  # rows that hold the amount: without any the sum is NULL, not zero


def mean(column: str) -> Column:
    """Average as the exact decimal sum over the count, unrounded."""
    return F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("gross_amount").alias("total_gross_amount"),
        F.sum("total_discount").alias("total_discount"),
        F.sum("total_tax").alias("total_tax"),
        F.sum("net_total").alias("total_net_sales"),
        mean("net_total").alias("avg_transaction_value"),
        F.countDistinct("customer_dim_key").alias("unique_customers"),
    ]


def _measure_names() -> list[str]:
    return ["transaction_count", "total_gross_amount", "total_discount", "total_tax", "total_net_sales",
            "avg_transaction_value", "unique_customers"]


def fact_sales_daily(header: DataFrame, dim_date: DataFrame, dim_store: DataFrame, dim_country: DataFrame) -> DataFrame:
    return _described_days(header.groupBy(*GROUP).agg(*_measures()), dim_date, dim_store, dim_country)


def _described_days(groups: DataFrame, dim_date: DataFrame, dim_store: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Groups of a day, store, country, channel and currency with the columns that describe them."""
    days = ["date_key", "year_number", "quarter_number", "month_number", "week_number", "year_month", "month_name",
            "day_name", "is_weekend"]
    stores = ["store_code", "store_name", "format_code"]
    out = lookup(groups, dim_date.select("date_dim_key", *days), "date_dim_key")
    out = lookup(out, dim_store.select("store_dim_key", *stores), "store_dim_key")
    out = lookup(out, dim_country.select("country_dim_key", *GEOGRAPHY), "country_dim_key")
    return out.select("date_dim_key", *days, "country_dim_key", *GEOGRAPHY, "store_dim_key", *stores, "channel_id",
                      "currency", *_measure_names())


def day_groups(header: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums of the sales of a day, store, country, channel and currency.

    Counts and sums only, so groups of several sets of sales can be added up and taken off.
    """
    return grouped(
        header, [*by, *GROUP], F.count(F.lit(1)).alias("transaction_count"), *[F.sum(a).alias(t) for t, a in AMOUNTS.items()],
        *[F.count(a).alias(COUNTS[t]) for t, a in AMOUNTS.items()])


def day_customers(header: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sales of each customer in a group of :func:`day_groups`."""
    return grouped(header, [*by, *GROUP, "customer_dim_key"], F.count(F.lit(1)).alias("transaction_count"))


def changed_groups(stored: DataFrame, changes: DataFrame, sign: str, by: Sequence[str] = ()) -> DataFrame:
    """Stored groups with changed sales added or, where their sign is -1, taken off; empty groups go.

    ``changes`` are sales; ``stored`` holds groups or customers of groups. Both are added up
    in one step, and what no sale is left of is dropped.
    """
    keys = [*by, *GROUP, *(["customer_dim_key"] if "customer_dim_key" in stored.columns else [])]
    totals = [c for c in stored.columns if c not in keys]
    amount = {"transaction_count": F.lit(1), **{t: F.col(a) for t, a in AMOUNTS.items()}, **{COUNTS[t]: F.when(F.col(a).isNotNull(), 1) for t, a in AMOUNTS.items()}}
    signed = changes.select(*keys, *[(amount[t] * F.col(sign)).alias(t) for t in totals])
    kinds = {f.name: f.dataType for f in stored.schema.fields}
    added = stored.unionByName(signed).groupBy(*keys).agg(*[F.sum(t).cast(kinds[t]).alias(t) for t in totals])
    for total, rows in COUNTS.items():
        if total in totals:
            added = added.withColumns({total: F.when(F.col(rows) > 0, F.col(total)), rows: F.coalesce(rows, F.lit(0).cast("long"))})
    return added.filter("transaction_count > 0").select(*stored.columns)


def daily_from_groups(groups: DataFrame, customers: DataFrame, dim_date: DataFrame, dim_store: DataFrame, dim_country: DataFrame) -> DataFrame:
    """The daily summary of stored groups and their customers: what :func:`fact_sales_daily` gives for the sales."""
    bought = customers.groupBy(*GROUP).agg(F.count("customer_dim_key").alias("unique_customers"))
    both = groups.unionByName(bought, allowMissingColumns=True)
    values = ["transaction_count", *AMOUNTS, *COUNTS.values(), "unique_customers"]
    out = both.groupBy(*GROUP).agg(*[F.max(c).alias(c) for c in values])
    return _described_days(_averaged(out), dim_date, dim_store, dim_country)


def _averaged(groups: DataFrame) -> DataFrame:
    counted = F.nullif(F.col(COUNTS["total_net_sales"]), F.lit(0).cast("long"))
    return groups.withColumn("avg_transaction_value", F.col("total_net_sales").cast("double") / counted)


def _by_period(
    header: DataFrame, dim_date: DataFrame, dim_country: DataFrame, period: list[str], first: str, last: str
) -> DataFrame:
    """Sums of a period from daily groups of the sales, customers from the distinct ones of each day."""
    bought = header.select("date_dim_key", *PLACE, "customer_dim_key").distinct()
    return period_from_groups(day_groups(header), bought, dim_date, dim_country, period, first, last)


def period_from_groups(
    groups: DataFrame, customers: DataFrame, dim_date: DataFrame, dim_country: DataFrame, period: list[str], first: str, last: str
) -> DataFrame:
    """Sums of a period from the groups of its days.

    Each distinct count is a count of groups, so no row is repeated for it: stores are the
    groups of the first step, days are bits of the day of the month (a period, also a week of
    a calendar year, has each such day once at most), customers are groups of their own.
    """
    days = dim_date.select("date_dim_key", "date_key", *period)
    kinds = {f.name: f.dataType for f in groups.schema.fields}
    sums = ["transaction_count", *AMOUNTS, *COUNTS.values()]
    day = F.expr("shiftleft(1L, dayofmonth(date_key))")
    stores = lookup(groups.select(*GROUP, *sums), days, "date_dim_key").groupBy(*period, *PLACE, "store_dim_key").agg(
        *[F.sum(c).alias(c) for c in sums], F.min("date_key").alias(first), F.max("date_key").alias(last),
        F.bit_or(day).alias("__days"))
    bought = lookup(customers.select("date_dim_key", *PLACE, "customer_dim_key"), days, "date_dim_key")
    bought = bought.select(*period, *PLACE, "customer_dim_key").distinct()
    both = stores.unionByName(bought, allowMissingColumns=True)
    out = both.groupBy(*period, *PLACE).agg(
        F.min(first).alias(first), F.max(last).alias(last), *[F.sum(c).cast(kinds[c]).alias(c) for c in sums],
        F.count("customer_dim_key").alias("unique_customers"), F.count("store_dim_key").alias("active_stores"),
        F.bit_count(F.bit_or("__days")).cast("long").alias("selling_days"))
    out = lookup(_averaged(out), dim_country.select("country_dim_key", *GEOGRAPHY), "country_dim_key")
    return out.select(*period, first, last, "country_dim_key", *GEOGRAPHY, "channel_id", "currency",
                      *_measure_names(), "active_stores", "selling_days")


def fact_sales_weekly(
    header: DataFrame, dim_date: DataFrame, dim_country: DataFrame, iso: bool = False
) -> DataFrame:
    """Calendar year and ISO week number, as the tables in use have it.

    With that pair the last days of December can share a group with the first of January
    of the same year; ``iso`` names the year of the week instead. First and last day are
    days with sales.
    """
    if iso:
        dim_date = dim_date.withColumn("year_number", iso_year(F.col("date_key")))
    return _by_period(header, dim_date, dim_country, *WEEK)


def fact_sales_monthly(header: DataFrame, dim_date: DataFrame, dim_country: DataFrame) -> DataFrame:
    return _by_period(header, dim_date, dim_country, *CALENDAR_MONTH)
