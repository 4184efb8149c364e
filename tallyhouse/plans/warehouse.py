"""All tables from raw to gold, each written once and read back by what follows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans import customers, dimensions, facts, increments, summaries
from tallyhouse.plans.comments import described
from tallyhouse.plans.silver import silver
from tallyhouse.runtime import fitted_shuffles
from tallyhouse.schemas import RAW_TABLES
from tallyhouse.sources.versions import VersionedTable
from tallyhouse.streaming.jobs import MONTH, month_of


def _period(period: tuple, groups: DataFrame, customers: DataFrame, dim_date: DataFrame, dim_country: DataFrame) -> DataFrame:
    return summaries.period_from_groups(groups, customers, dim_date, dim_country, *period)


# Gold table -> how it is built and from which tables.
GOLD: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "dim_country": (dimensions.dim_country, (
        "silver_country_master", "silver_region_master", "silver_currency_master", "silver_tax_master")),
    "dim_product": (dimensions.dim_product, (
        "silver_product_sku_master", "silver_product_model_master", "silver_product_family_master",
        "silver_product_category_master")),
    "bridge_product_country": (dimensions.bridge_product_country, (
        "silver_product_country_availability", "silver_product_sku_master", "silver_country_master")),
    "dim_store": (dimensions.dim_store, ("silver_store_master",)),
    "dim_customer": (dimensions.dim_customer, ("silver_customer_master",)),
    "dim_date": (dimensions.dim_date, ("silver_sales_header",)),
    "fact_sales_header": (facts.fact_sales_header, (
        "silver_sales_header", "dim_customer", "dim_store", "dim_country")),
    "fact_sales_item": (facts.fact_sales_item, ("silver_sales_item", "fact_sales_header", "dim_product")),
    # what the summaries are made from: sums of a day and place, and who bought there
    "sales_groups": (partial(summaries.day_groups, by=[MONTH]), ("fact_sales_header",)),
    "sales_customers": (partial(summaries.day_customers, by=[MONTH]), ("fact_sales_header",)),
    # customers by number, and those of a day and place as bits: distinct counts over any days
    "customer_numbers": (customers.customer_numbers, ("dim_customer",)),
    "customer_days": (customers.customer_days, ("sales_customers", "customer_numbers")),
    "fact_sales_daily": (summaries.daily_from_groups, ("sales_groups", "sales_customers", "dim_date", "dim_store", "dim_country")),
    "fact_sales_weekly": (partial(_period, summaries.WEEK), ("sales_groups", "sales_customers", "dim_date", "dim_country")),
    "fact_sales_monthly": (partial(_period, summaries.CALENDAR_MONTH), ("sales_groups", "sales_customers", "dim_date", "dim_country")),
}

# Layout of the stored facts and groups, at every size: split by month, so that questions about
# a time skip the other months and a change rewrites only the months it touches. Partitions
# are rebalanced on writing, so small months share a task and a large one is split. The day
# that names the month, or None where the rows carry it already.
BY_MONTH = {"fact_sales_header": "transaction_timestamp", "fact_sales_item": "transaction_timestamp",
            "sales_groups": None, "sales_customers": None, "customer_days": None, "fact_sales_daily": "date_key"}
HIDDEN = {"fact_sales_daily"}  # readers see no column of the month
KEPT_VERSIONS = 2  # a reader that opened the last version may go on reading it


class NotBuilt(LookupError):
    """A table that was never built under this root."""


SALES = {"silver_sales_header", "silver_sales_item"}

# Silver tables that are stored before gold reads them: those of several readers.
STORED = {
    n for _, needs in GOLD.values() for n in needs
    if n.startswith("silver_") and sum(n in other for _, other in GOLD.values()) > 1}


class Warehouse:
    """Tables of one environment under ``root``.

    ``open`` reads a stored table and never writes. ``build`` writes tables into new versions;
    a version counts once it is complete, and those who opened an older one go on reading that.

    ``raw`` gives a raw table by name, ``silver`` makes the silver table from it; a job that
    keeps the newest rows itself passes its own. Both are needed for building only.

    ``marks`` gives what a raw table holds by now, as a number that grows with it. Every version
    remembers the marks it was made of, so what lags behind is known from the tables alone,
    however a run before ended. With ``changes``, the rows that a raw table got since a mark,
    facts and summaries are brought up to date from those instead of being made anew.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        raw: Callable[[str], DataFrame] | None = None,
        env: str = "dev",
        silver: Callable[[DataFrame, str], DataFrame] = silver,
        marks: Callable[[str], int] | None = None,
        changes: Callable[[str, int], DataFrame | None] | None = None,
    ):
        self.spark, self.root, self.raw, self.silver = spark, f"{root.rstrip('/')}/{env}", raw, silver
        self.marks, self.changes = marks, changes
        self._stored: dict[str, VersionedTable] = {}

    def stored(self, name: str) -> VersionedTable:
        """The versions of a table."""
        if name not in self._stored:
            self._stored[name] = VersionedTable(self.spark, self._folder(name), KEPT_VERSIONS, facts.derived_keys(name))
        return self._stored[name]

    def open(self, name: str) -> DataFrame:
        """The newest stored version of a silver or gold table."""
        version = self.stored(name).version()
        if not version:
            raise NotBuilt(f"{name} was not built under {self.root}")
        return self.stored(name).read(version)

    table = open

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: self.open(n) for n in names}

    def views(self, *names: str) -> None:
        """Temporary views of the stored tables, all gold tables unless named, for use from SQL."""
        for name in names or GOLD:
            self.open(name).createOrReplaceTempView(name)

    def build(self, *names: str, after: Iterable[str] | None = None, stale: bool = False) -> dict[str, DataFrame]:
        """Build the named tables, all unless named, and what they need, each once.

        With ``after``, names of raw tables that have new rows, only the tables that depend
        on one of them are written; with ``stale``, only those made of less than the raw
        tables hold now. The others are opened.
        """
        names = names or (*[f"silver_{n}" for n in RAW_TABLES], *GOLD)
        run = _Run(stale, None if after is None else {f"silver_{n}" for n in after})
        return {n: self._build(n, run) for n in names}

    def _build(self, name: str, run: _Run) -> DataFrame:
        if name not in run.built:
            run.built[name] = self._current(name, run) or self._updated(name, run) or self._whole(name, run)
        return run.built[name]

    def _current(self, name: str, run: _Run) -> DataFrame | None:
        """The stored table, if it need not be built."""
        if not run.stale and run.changed is None or run.changed and needs(name) & run.changed:
            return None
        table = self.stored(name)
        version = table.version()
        if not version or run.stale and table.made_of(version).get("raw") != self._marks(name):
            return None
        return table.read(version)

    def _updated(self, name: str, run: _Run) -> DataFrame | None:
        """The table brought up to date from what changed, where that can be done."""
        if not run.stale or self.changes is None or name not in increments.UPDATES:
            return None
        table, sources = self.stored(name), [n for n in GOLD[name][1] if n in GOLD]
        version = table.version()
        if not version:
            return None
        for source in sources:
            self._build(source, run)
        update = increments.UPDATES[name](self, table.made_of(version))
        if update is None:
            return None
        made_of = self._made_of(name) | (update.note or {})
        rows = described(update.rows)
        if update.parts is None:
            return table.write(rows, made_of)
        return table.write_parts(rows, update.parts, made_of, update.changes)

    def _whole(self, name: str, run: _Run) -> DataFrame:
        with self._sources(name, run) as df:
            split = None
            if name in BY_MONTH:
                split = MONTH
                if BY_MONTH[name]:
                    df = df.withColumn(MONTH, month_of(BY_MONTH[name]))
            if name not in facts.TRAVELLING:
                return self.stored(name).write(described(df), self._made_of(name), split, name in HIDDEN)
            _, finished = facts.TRAVELLING[name]
            return self.stored(name).write(
                df, self._made_of(name), split, name in HIDDEN, lambda rows: described(finished(rows, [MONTH])))

    def _made_of(self, name: str) -> dict:
        """Marks of the raw tables and versions of the gold tables that a table is made of now."""
        return {"raw": self._marks(name), "inputs": {n: self.stored(n).version() for n in GOLD.get(name, (None, ()))[1] if n in GOLD}}

    def _marks(self, name: str) -> dict[str, int]:
        raw = sorted(n.removeprefix("silver_") for n in needs(name) if n.startswith("silver_"))
        return {n: self.marks(n) for n in raw} if self.marks else {}

    @contextmanager
    def _sources(self, name: str, run: _Run) -> Iterator[DataFrame]:
        if name.startswith("silver_"):
            raw_name = name.removeprefix("silver_")
            raw = self.raw(raw_name)
            with fitted_shuffles(self.spark, raw):
                yield self.silver(raw, raw_name)
            return
        define, sources = GOLD[name]
        define, _ = facts.TRAVELLING.get(name, (define, None))
        inputs = [self._input(n, run) for n in sources]
        with fitted_shuffles(self.spark, *inputs):
            yield define(*inputs)

    def _input(self, name: str, run: _Run) -> DataFrame:
        """A silver table that only one gold table reads becomes part of that table's plan.

        So do sales where the newest rows are kept: the silver table is a view of those.
        """
        kept = name in STORED and not (self.changes and name in SALES)
        if name.startswith("silver_") and not kept and name not in run.built:
            return self.silver_rows(name.removeprefix("silver_"))
        return self._build(name, run)

    def silver_rows(self, raw_name: str) -> DataFrame:
        """A silver table made from its raw table, not stored."""
        return self.silver(self.raw(raw_name), raw_name)

    def _folder(self, name: str) -> str:
        return f"{self.root}/{'silver' if name.startswith('silver_') else 'gold'}/{name}"


class _Run:
    """What one call of ``build`` asked for and has built so far."""

    def __init__(self, stale: bool, changed: set[str] | None):
        self.stale, self.changed = stale, changed
        self.built: dict[str, DataFrame] = {}


def needs(name: str) -> set[str]:
    """A table and all tables it is made from."""
    return {name}.union(*[needs(n) for n in GOLD.get(name, (None, ()))[1]])
