"""Facts and summaries brought up to date from what changed since their last version.

Which sales are touched follows from the rows that the raw tables got and from the dimension
rows that came, went or got another key. Their old rows are taken out of the fact and their
new ones put in, month by month, and both are kept beside the new version as images with
a sign. Sums of groups add up those images, so a summary reads neither the fact nor any month
that no sale came to or left.

Every function here gives None where the table has to be made anew: nothing is kept that
tells the difference, because a version or the batches of a raw table are gone already.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import calendar
from tallyhouse.operators.lookup import small
from tallyhouse.plans import customers, facts, summaries
from tallyhouse.runtime import stored
from tallyhouse.sources.versions import SIGN
from tallyhouse.streaming.jobs import MONTH, month_of

if TYPE_CHECKING:
    from tallyhouse.plans.warehouse import Warehouse


@dataclass
class Update:
    """New rows of some parts of a table, or of the whole table where ``parts`` is None."""

    rows: DataFrame
    parts: Sequence[str] | None = None
    changes: DataFrame | None = None
    note: dict | None = None


def one_sided(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that only one of two tables holds, or one of them more often."""
    signed = before.withColumn(SIGN, F.lit(-1)).unionByName(after.withColumn(SIGN, F.lit(1)))
    return signed.groupBy(*before.columns).agg(F.sum(SIGN).alias(SIGN)).filter(f"{SIGN} <> 0").drop(SIGN)


def rows_of(df: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` with one of some keys, or with none of them; a missing key equals another."""
    names = keys.columns
    other = keys.select(*[F.col(k).alias(f"__{k}") for k in names])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in names])
    return df.join(F.broadcast(other) if small(keys) else other, same, how)


def _before_and_after(house: Warehouse, name: str, made_of: dict) -> tuple[DataFrame, DataFrame] | None:
    """A gold table as it was when something was made of it, and as it is now."""
    table, version = house.stored(name), made_of.get("inputs", {}).get(name)
    return (table.read(version), table.read()) if version in table.versions() else None


def _replaced(house: Warehouse, name: str, keys: DataFrame, after: DataFrame) -> Update:
    """A fact with the rows of some keys replaced by ``after``, in the months that lose or get one."""
    table = house.stored(name)
    keys = stored(keys.distinct())
    after = after.withColumn(MONTH, month_of("transaction_timestamp"))
    images = stored(rows_of(table.read(), keys).withColumn(SIGN, F.lit(-1)).unionByName(after.withColumn(SIGN, F.lit(1))))
    months = [r[0] for r in images.select(MONTH).distinct().collect()]
    stay = rows_of(table.read_parts(months, table.version()), keys, "left_anti")
    return Update(stay.unionByName(images.filter(f"{SIGN} = 1").drop(SIGN)), months, images)


def header(house: Warehouse, made_of: dict) -> Update | None:
    """Transactions that were loaded again, or whose customer, store or country changed."""
    came = house.changes("sales_header", made_of.get("raw", {}).get("sales_header", -1))
    dims = [_before_and_after(house, n, made_of) for n in ("dim_customer", "dim_store", "dim_country")]
    if came is None or None in dims:
        return None
    (old_customers, customers), (old_stores, stores), (old_countries, countries) = dims
    sales = house.silver_rows("sales_header")
    keys = came.select("transaction_id")
    if (old_customers, old_stores, old_countries) != (customers, stores, countries):
        people = ["customer_id", "customer_dim_key"]
        moved = one_sided(*(facts.current(c).select(*people) for c in (old_customers, customers))).select("customer_id")
        places = one_sided(facts.stores_with_country(old_stores, old_countries), facts.stores_with_country(stores, countries)).select("store_id")
        for other in (moved, places):
            keys = keys.unionByName(rows_of(sales, stored(other.distinct())).select("transaction_id"))
    keys = stored(keys.distinct())
    after = facts.fact_sales_header(rows_of(sales, keys), customers, stores, countries)
    return _replaced(house, "fact_sales_header", keys, after)


def item(house: Warehouse, made_of: dict) -> Update | None:
    """Lines that were loaded again, or whose transaction or article changed."""
    came = house.changes("sales_item", made_of.get("raw", {}).get("sales_item", -1))
    sales = house.stored("fact_sales_header").changes(made_of.get("inputs", {}).get("fact_sales_header", 0))
    articles = _before_and_after(house, "dim_product", made_of)
    if came is None or sales is None or articles is None:
        return None
    lines = house.silver_rows("sales_item")
    keys = came.select("transaction_line_id").unionByName(rows_of(lines, stored(sales.select("transaction_id").distinct())).select("transaction_line_id"))
    if articles[0] is not articles[1]:
        moved = one_sided(*(facts.current(a).select("sku_code", "product_dim_key") for a in articles)).select("sku_code")
        keys = keys.unionByName(rows_of(lines, stored(moved.distinct())).select("transaction_line_id"))
    keys = stored(keys.distinct())
    after = facts.fact_sales_item(rows_of(lines, keys), house.stored("fact_sales_header").read(), articles[1])
    return _replaced(house, "fact_sales_item", keys, after)


def groups(name: str) -> Callable[[Warehouse, dict], Update | None]:
    def update(house: Warehouse, made_of: dict) -> Update | None:
        """Stored groups with the sales that went taken off and those that came added."""
        changes = house.stored("fact_sales_header").changes(made_of.get("inputs", {}).get("fact_sales_header", 0))
        if changes is None:
            return None
        table, months = house.stored(name), [r[0] for r in changes.select(MONTH).distinct().collect()]
        before = table.read_parts(months, table.version())
        return Update(summaries.changed_groups(before, changes, SIGN, [MONTH]), months)
    return update


def _changed_months(house: Warehouse, made_of: dict, dims: Sequence[str]) -> set[str] | None:
    """Months whose groups or customers changed; None if a dimension that describes them did."""
    inputs = made_of.get("inputs", {})
    if any(inputs.get(n) != house.stored(n).version() for n in dims):
        return None
    found = [house.stored(n).changed_parts(inputs.get(n, 0)) for n in ("sales_groups", "sales_customers")]
    return None if None in found else set().union(*found)


def _parts(house: Warehouse, months: set[str]) -> list[DataFrame]:
    return [house.stored(n).read_parts(months, house.stored(n).version()) for n in ("sales_groups", "sales_customers")]


def daily(house: Warehouse, made_of: dict) -> Update | None:
    months = _changed_months(house, made_of, ["dim_store", "dim_country"])
    if months is None:
        return None
    rows = summaries.daily_from_groups(*_parts(house, months), *(house.open(n) for n in ("dim_date", "dim_store", "dim_country")))
    return Update(rows.withColumn(MONTH, month_of("date_key")), sorted(months))


def _days_of(house: Warehouse, months: set[str]) -> DataFrame:
    """All days of some months, with the columns of the calendar."""
    first = F.to_date(F.concat(MONTH, F.lit("-01")))
    days = house.spark.createDataFrame([(m,) for m in sorted(months)], f"{MONTH} string")
    days = days.select(MONTH, F.explode(F.sequence(first, F.last_day(first))).alias("date_key"))
    return days.select(MONTH, "date_key", *[c.alias(n) for n, c in calendar("date_key").items()])


def periods(name: str, period: tuple) -> Callable[[Warehouse, dict], Update | None]:
    def update(house: Warehouse, made_of: dict) -> Update | None:
        """Only the periods with a day in a changed month are added up again, from all months they reach into."""
        months = _changed_months(house, made_of, ["dim_country"])
        if months is None:
            return None
        columns = period[0]
        table, every = house.stored(name), set(house.stored("sales_groups").note(house.stored("sales_groups").version())["parts"])
        touched = _days_of(house, months).select(*columns).distinct()
        reached = {r[0] for r in rows_of(_days_of(house, every | months), touched).select(MONTH).distinct().collect()}
        days = rows_of(house.open("dim_date"), touched)
        again = summaries.period_from_groups(*_parts(house, reached), days, house.open("dim_country"), *period)
        return Update(rows_of(table.read(), touched, "left_anti").unionByName(again))
    return update


def numbers(house: Warehouse, made_of: dict) -> Update:
    """Known customers keep their numbers, new ones get the next."""
    table = house.stored("customer_numbers")
    rows = customers.customer_numbers(house.open("dim_customer"), table.read())
    return Update(rows, note={"grown_from": table.version()})


def customer_days(house: Warehouse, made_of: dict) -> Update | None:
    """Bitmaps of the months whose customers changed, as long as the numbers only grew."""
    inputs, table = made_of.get("inputs", {}), house.stored("customer_numbers")
    then, now = inputs.get("customer_numbers", 0), table.version()
    if then != now and table.made_of(now).get("grown_from") != then:
        return None
    months = house.stored("sales_customers").changed_parts(inputs.get("sales_customers", 0))
    if months is None:
        return None
    held = house.stored("sales_customers")
    return Update(customers.customer_days(held.read_parts(months, held.version()), table.read()), sorted(months))


UPDATES: dict[str, Callable[[Warehouse, dict], Update | None]] = {
    "fact_sales_header": header,
    "fact_sales_item": item,
    "sales_groups": groups("sales_groups"),
    "sales_customers": groups("sales_customers"),
    "customer_numbers": numbers,
    "customer_days": customer_days,
    "fact_sales_daily": daily,
    "fact_sales_weekly": periods("fact_sales_weekly", summaries.WEEK),
    "fact_sales_monthly": periods("fact_sales_monthly", summaries.CALENDAR_MONTH),
}
