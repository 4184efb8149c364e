"""Registered queries and their SQL: one entry per operator of the blueprint.

``@check(name, sql)`` registers a function of :class:`Data`. Results are shown in types
both engines spell alike: decimals as DOUBLE, days and times as text, integers as BIGINT.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import answers, loads
from checks.oracle import AVERAGE, FLAWS, KEYS, columns, key, sql, table
from tallyhouse.functions import calendar as cal
from tallyhouse.functions.keys import date_key, micros_text, packed, versioned_key
from tallyhouse.operators import history, integrity, periods, quality, ranking
from tallyhouse.operators.intervals import interval_join
from tallyhouse.operators.latest import keep_latest
from tallyhouse.operators.lookup import lookup
from tallyhouse.plans import customers, dimensions, facts, metrics, questions, summaries, versions
from tallyhouse.plans.silver import BRONZE_TS, flagged, silver, valid
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.runtime import scratch_dir
from tallyhouse.schemas import FILE_NAME, LOAD_TS, RAW_TABLES, ROW_NUMBER
from tallyhouse.sources import landing, tables
from tallyhouse.sources.samples import SOURCES, read
from tallyhouse.streaming import jobs
from tallyhouse.streaming.latest_table import LatestTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_warehouses: dict[tuple[str, str], Warehouse] = {}


class Data:
    """The test tables as raw, silver and gold tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def source(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        return SOURCES[name](self.spark, self.sf_dir)

    def silver(self, name: str) -> DataFrame:
        return silver(self.raw(name), name)

    @property
    def warehouse(self) -> Warehouse:
        """Stored tables, as the questions and reports find them in use."""
        at = (self.spark.sparkContext.applicationId, self.sf_dir)
        if at not in _warehouses:
            _warehouses[at] = Warehouse(self.spark, scratch_dir(self.spark), self.raw)
        return _warehouses[at]

    def stored(self, name: str) -> DataFrame:
        """A stored table; built, with what it needs, if no query has asked for it yet."""
        self.warehouse.build(name, after=())
        return self.warehouse.open(name)

    def gold(self, name: str) -> DataFrame:
        return self.stored(name)

    @property
    def model(self) -> metrics.Model:
        return metrics.Model(self.gold, groups=lambda: self.gold("sales_groups"))

    def folder(self) -> str:
        return scratch_dir(self.spark)

    def landed(self, name: str, files: int | None = None, extra: int = 0) -> str:
        """The raw table written as CSV files with a header line, as a source system would."""
        spec = RAW_TABLES[name]
        out = self.raw(name).select(*spec.columns, *[F.lit("x").alias(f"unused {i}") for i in range(extra)])
        path = f"{self.folder()}/landing/{spec.folder}/{name}"
        (out.repartition(files) if files else out).write.option("header", "true").option("escape", '"').csv(path)
        return path


def shown(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = micros_text(c)
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def check(name: str, answer: str | None = None):
    def register(build: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: shown(build(Data(spark, sf_dir)))
        if answer:
            ORACLES[name] = answer
        return build

    return register


# -- columns of the tables, with their marks --------------------------------------------

def _raw_columns(name: str) -> str:
    marks = {T.DateType: "d", T.TimestampNTZType: "t", T.DecimalType: "n", T.IntegerType: "i", T.LongType: "i"}
    return " ".join(
        f"{f.name}:{marks[type(f.dataType)]}" if type(f.dataType) in marks else f.name
        for f in RAW_TABLES[name].loaded)


AUDIT = "__file_name __row_number:i __load_ts:t"
SILVER_TAIL = "is_valid_record __file_name __source_row_number:i __bronze_load_ts:t"
TAIL = "effective_start_ts:t effective_end_ts:t is_current __source_load_ts:t"
GOLD_COLUMNS = {
    "dim_country": "country_dim_key country_code country_name primary_language timezone market_tier "
                   "ecommerce_supported retail_store_supported region_code region_name currency_code currency_name "
                   f"currency_symbol tax_code tax_type tax_rate:n tax_inclusive_flag {TAIL}",
    "dim_product": "product_dim_key sku_code variant price_tier sku_launch_date:d sku_is_active model_code model_name "
                   "model_launch_date:d model_discontinue_date:d lifecycle_status family_code family_name "
                   f"family_launch_year:i category_code category_name reporting_segment {TAIL}",
    "dim_store": "store_dim_key store_code store_name format_code lifecycle_status country_code region_code state_code "
                 "city postal_code address_line1 latitude:n longitude:n tax_jurisdiction_code floor_area_sqft:i "
                 f"annual_rent_usd:i store_open_date:d store_close_date:d is_active {TAIL}",
    "dim_customer": "customer_dim_key customer_id customer_number first_name last_name full_name gender "
                    "date_of_birth:d email phone_number street_address city state_province postal_code country_code "
                    "country_name region preferred_language customer_segment loyalty_tier registration_date:d "
                    f"is_active source_system record_source {TAIL}",
    "dim_date": "date_dim_key date_key:d year_number:i quarter_number:i month_number:i week_number:i day_of_year:i "
                "day_of_month:i day_of_week:i year_name quarter_name month_name month_short_name day_name year_month "
                "year_quarter fiscal_year:i fiscal_quarter:i is_weekend is_holiday",
    "bridge_product_country": "bridge_key product_dim_key country_dim_key sku_code country_code local_launch_date:d "
                              "local_discontinue_date:d is_available __source_load_ts:t",
    "fact_sales_header": "fact_sales_header_key customer_dim_key store_dim_key country_dim_key date_dim_key "
                         "transaction_id transaction_number transaction_timestamp:d channel_id payment_method "
                         "currency gross_amount:n total_discount:n total_tax:n net_total:n transaction_count:i "
                         "__source_load_ts:t",
    "fact_sales_item": "fact_sales_item_key fact_sales_header_key customer_dim_key product_dim_key store_dim_key "
                       "country_dim_key date_dim_key transaction_line_id transaction_id transaction_number "
                       "transaction_timestamp:d channel_id currency quantity:i unit_price:n discount_amount:n "
                       "tax_amount:n line_total:n line_count:i __source_load_ts:t",
}
_PLACE = "country_dim_key country_code country_name region_code region_name"
_SUMS = ("transaction_count:i total_gross_amount:n total_discount:n total_tax:n total_net_sales:n "
         "avg_transaction_value unique_customers:i")
GOLD_COLUMNS |= {
    "fact_sales_daily": "date_dim_key date_key:d year_number:i quarter_number:i month_number:i week_number:i "
                        f"year_month month_name day_name is_weekend {_PLACE} store_dim_key store_code store_name "
                        f"format_code channel_id currency {_SUMS}",
    "fact_sales_weekly": f"year_number:i week_number:i week_start_date:d week_end_date:d {_PLACE} channel_id currency "
                         f"{_SUMS} active_stores:i selling_days:i",
    "fact_sales_monthly": "year_number:i month_number:i year_month month_name quarter_number:i year_quarter "
                          "fiscal_year:i fiscal_quarter:i month_start_date:d month_end_date:d "
                          f"{_PLACE} channel_id currency {_SUMS} active_stores:i selling_days:i",
}


def names(text: str) -> list[str]:
    return [item.partition(":")[0] for item in text.split()]


# -- sources and sinks ------------------------------------------------------------------

def _load(d: Data, name: str, path: str, load_ts: datetime | None = None) -> DataFrame:
    spec, target = RAW_TABLES[name], d.folder()
    landing.load(d.spark, spec, path, target, load_ts)
    return tables.read(d.spark, target, spec.schema)


@check("src_01_csv_scan", table("b_customer_master", _raw_columns("customer_master")))
def _(d):
    spec = RAW_TABLES["customer_master"]
    return landing.read_by_position(d.spark, spec, d.landed(spec.name)).select(*spec.columns)


@check("src_02_file_listing", "SELECT 4 AS files, true AS with_size, true AS with_time")
def _(d):
    files = landing.list_files(d.spark, d.landed("sales_header", files=4))
    return files.agg(F.count("path").alias("files"), (F.min("length") > 0).alias("with_size"),
                     (F.count("modificationTime") == F.count("path")).alias("with_time"))


@check("src_03_positional_load", table("b_sales_header", _raw_columns("sales_header")))
def _(d):
    return _load(d, "sales_header", d.landed("sales_header", files=3)).select(*RAW_TABLES["sales_header"].columns)


@check("src_04_prefix_load", table("b_store_master", _raw_columns("store_master")))
def _(d):
    # the file has two more columns than the table
    return _load(d, "store_master", d.landed("store_master", extra=2)).select(*RAW_TABLES["store_master"].columns)


@check("src_05_file_name",
       sql("SELECT true AS below_root, true AS csv_names, 3 AS files, count(*) AS rows FROM b_sales_header"))
def _(d):
    spec, target, path = RAW_TABLES["sales_header"], d.folder(), d.landed("sales_header", files=3)
    landing.load(d.spark, spec, path, target, root=path.partition("/sales-transaction")[0])
    return tables.read(d.spark, target, spec.schema).agg(
        F.min(F.col(FILE_NAME).startswith("sales-transaction/sales_header/")).alias("below_root"),
        F.min(F.col(FILE_NAME).endswith(".csv")).alias("csv_names"),
        F.countDistinct(FILE_NAME).alias("files"), F.count(F.lit(1)).alias("rows"))


@check("src_06_row_numbers", sql(
    "SELECT count(*) AS rows, count(*) AS numbered, count(*) AS places, 1 AS first_number FROM b_sales_item"))
def _(d):
    loaded = _load(d, "sales_item", d.landed("sales_item", files=5))
    per_file = loaded.groupBy(FILE_NAME).agg(
        F.count(F.lit(1)).alias("rows"), F.max(ROW_NUMBER).alias("numbered"),
        F.countDistinct(ROW_NUMBER).alias("places"), F.min(ROW_NUMBER).alias("first_number"))
    return per_file.agg(F.sum("rows").alias("rows"), F.sum("numbered").alias("numbered"),
                        F.sum("places").alias("places"), F.max("first_number").alias("first_number"))


@check("src_07_load_ts", sql(
    "SELECT count(*) AS rows, 1 AS load_times, '2024-05-06 07:08:09.123456' AS __load_ts FROM b_customer_master"))
def _(d):
    loaded = _load(d, "customer_master", d.landed("customer_master", files=3), datetime(2024, 5, 6, 7, 8, 9, 123456))
    return loaded.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(LOAD_TS).alias("load_times"),
                      F.max(LOAD_TS).alias(LOAD_TS))


@check("src_08_append", sql(
    "SELECT customer_id, 2 AS copies, 2 AS loads FROM b_customer_master"))
def _(d):
    spec, target, path = RAW_TABLES["customer_master"], d.folder(), d.landed("customer_master")
    for day in (1, 2):
        landing.load(d.spark, spec, path, target, datetime(2024, 5, day))
    return tables.read(d.spark, target, spec.schema).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("copies"), F.countDistinct(LOAD_TS).alias("loads"))


@check("src_09_typed_load", sql(f"""
    SELECT channel_id, CAST(sum(net_total) AS DOUBLE) AS net_total, CAST(max(transaction_timestamp) AS VARCHAR) AS last_day
    FROM b_sales_header GROUP BY channel_id"""))
def _(d):
    loaded = _load(d, "sales_header", d.landed("sales_header"))
    return loaded.groupBy("channel_id").agg(
        F.sum("net_total").alias("net_total"), F.max("transaction_timestamp").alias("last_day"))


@check("src_10_inferred_columns",
       "SELECT c_custkey AS customer_no, c_name AS customer_name, c_acctbal AS account_balance_usd FROM customer")
def _(d):
    path = d.folder()
    (d.source("customer").select(F.col("c_custkey").alias("Customer No."), F.col("c_name").alias(" Customer Name"),
                                 F.col("c_acctbal").alias("Account-Balance (USD)"))
     .write.option("header", "true").csv(path))
    return landing.read_inferred(d.spark, path).withColumn("customer_no", F.col("customer_no").cast("bigint"))


@check("src_12_create_or_replace", table("s_customer_master", _raw_columns("customer_master") + " is_valid_record"))
def _(d):
    # built twice by one warehouse, opened by another that cannot build
    root = d.folder()
    for _ in range(2):
        Warehouse(d.spark, root, d.raw).build("silver_customer_master")
    return Warehouse(d.spark, root).open("silver_customer_master").select(
        *RAW_TABLES["customer_master"].columns, "is_valid_record")


for _number, _name in enumerate(RAW_TABLES, 1):
    @check(f"load_{_number:02d}_{_name}", table(f"b_{_name}", _raw_columns(_name)))
    def _(d, name=_name):
        spec = RAW_TABLES[name]
        return _load(d, name, d.landed(name, extra=spec.trailing)).select(*spec.columns)


# -- projections and filters ------------------------------------------------------------

@check("prj_01_columns", table("b_sales_header", "transaction_id customer_id net_total:n"))
def _(d):
    return d.raw("sales_header").select("transaction_id", "customer_id", "net_total")


@check("prj_02_rename", sql(
    "SELECT transaction_id, __row_number AS __source_row_number, strftime(__load_ts, '%Y-%m-%d %H:%M:%S.%f') "
    "AS __bronze_load_ts FROM b_sales_header"))
def _(d):
    return d.raw("sales_header").select(
        "transaction_id", F.col(ROW_NUMBER).alias("__source_row_number"), F.col(LOAD_TS).alias(BRONZE_TS))


@check("prj_03_literals", sql(
    "SELECT transaction_id, true AS is_current, 1 AS transaction_count, false AS is_holiday FROM b_sales_header"))
def _(d):
    return d.raw("sales_header").select(
        "transaction_id", F.lit(True).alias("is_current"), F.lit(1).alias("transaction_count"),
        F.lit(False).alias("is_holiday"))


@check("prj_04_case", sql(
    "SELECT sku_code, country_code, CASE WHEN local_discontinue_date < local_launch_date THEN 'withdrawn' "
    "WHEN is_available = 'N' THEN 'closed' ELSE 'open' END AS state FROM b_product_country_availability"))
def _(d):
    # a NULL test is no match, so rows without an end fall through to the next branch
    return d.raw("product_country_availability").select(
        "sku_code", "country_code",
        F.when(F.col("local_discontinue_date") < F.col("local_launch_date"), "withdrawn")
        .when(F.col("is_available") == "N", "closed").otherwise("open").alias("state"))


@check("prj_05_cast", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, "
       "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount, '9999-12-31 23:59:59.000000' AS open_end FROM orders")
def _(d):
    return d.source("orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"), history.open_end().alias("open_end"))


@check("prj_06_arithmetic", "SELECT o_orderkey, year(o_orderdate) - 1 AS last_year, quarter(o_orderdate) - 1 AS q_down, "
       "quarter(o_orderdate) + 3 AS q_up FROM orders")
def _(d):
    day = F.col("o_orderdate")
    return d.source("orders").select(
        "o_orderkey", (F.year(day) - 1).alias("last_year"), (F.quarter(day) - 1).alias("q_down"),
        (F.quarter(day) + 3).alias("q_up"))


def _filter(name: str, raw: str, text: str, where: str, test: Callable[[], Column]):
    @check(name, sql(f"SELECT {columns(text)} FROM b_{raw} WHERE {where}"))
    def _(d):
        return d.raw(raw).filter(test()).select(*names(text))


@check("flt_01_valid_rows", table("s_sales_header WHERE is_valid_record", "transaction_id store_id"))
def _(d):
    return valid(d.silver("sales_header")).select("transaction_id", "store_id")


_filter("flt_02_null_tests", "sales_header", "transaction_id customer_id", "store_id IS NULL AND customer_id IS NOT NULL",
        lambda: F.col("store_id").isNull() & F.col("customer_id").isNotNull())
_filter("flt_03_not_in", "currency_master", "currency_code is_active", "is_active NOT IN ('Y', 'N')",
        lambda: ~F.col("is_active").isin("Y", "N"))
_filter("flt_04_bounds", "sales_item", "transaction_line_id quantity:i unit_price:n",
        "quantity <= 3 OR unit_price > 90000", lambda: (F.col("quantity") <= 3) | (F.col("unit_price") > 90000))
_filter("flt_05_column_pairs", "product_model_master", "model_code launch_date:d discontinue_date:d",
        "discontinue_date < launch_date", lambda: F.col("discontinue_date") < F.col("launch_date"))
_filter("flt_06_not_like", "customer_master", "customer_id full_name", "full_name NOT LIKE '%#%1_'",
        lambda: ~F.col("full_name").like("%#%1_"))
_filter("flt_07_three_valued", "country_master", "country_code tax_code", "tax_code IS NULL OR tax_code < 'T10' AND "
        "region_code <> 'R1'",
        lambda: F.col("tax_code").isNull() | ((F.col("tax_code") < "T10") & (F.col("region_code") != "R1")))
_filter("flt_08_not_blank", "store_master", "store_code state_code", "trim(state_code) <> ''",
        lambda: F.trim("state_code") != "")


@check("flt_09_window_filter", sql(
    "SELECT transaction_id, transaction_line_id, CAST(line_total AS DOUBLE) AS line_total FROM b_sales_item QUALIFY row_number() "
    "OVER (PARTITION BY transaction_id ORDER BY line_total DESC, transaction_line_id, sku_code) = 1"))
def _(d):
    largest = Window.partitionBy("transaction_id").orderBy(
        F.desc("line_total"), F.asc("transaction_line_id"), F.asc("sku_code"))
    return (d.raw("sales_item").withColumn("rank", F.row_number().over(largest)).filter("rank = 1")
            .select("transaction_id", "transaction_line_id", "line_total"))


@check("flt_10_current_in_join", sql(
    "SELECT h.transaction_id, c.loyalty_tier FROM s_sales_header h "
    "JOIN g_dim_customer c ON h.customer_id = c.customer_id AND c.is_current"))
def _(d):
    customers = facts.current(dimensions.dim_customer(d.silver("customer_master")))
    return lookup(d.silver("sales_header"), customers.select("customer_id", "loyalty_tier"), "customer_id").select(
        "transaction_id", "loyalty_tier")


@check("flt_11_named_filters", sql(
    "SELECT currency, CAST(sum(net_total) AS DOUBLE) AS total_net_sales FROM g_fact_sales_header "
    "WHERE channel_id = 'POS' GROUP BY currency"))
def _(d):
    return d.model.query(["total_net_sales"], ["currency"], ["pos_sales"])


# -- validity rules ---------------------------------------------------------------------

def _first_flaw(name: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{label}'" for test, label in FLAWS[name]) + " END"


for _number, _name in enumerate(RAW_TABLES, 1):
    @check(f"dq_{_number:02d}_{_name}", sql(
        f"SELECT {KEYS[_name]}, is_valid_record, {_first_flaw(_name)} AS first_broken FROM s_{_name}"))
    def _(d, name=_name):
        return d.silver(name).select(
            *RAW_TABLES[name].keys, "is_valid_record",
            quality.first_broken(quality.rules_for(name)).alias("first_broken"))


def _lengths_sql() -> str:
    parts = []
    for name, spec in RAW_TABLES.items():
        for f in spec.schema.fields:
            if "max_length" in f.metadata:
                # one half of the declared length, so that there is something to find
                most = f.metadata["max_length"] // 2
                parts.append(f"SELECT '{name}' AS table_name, '{f.name}' AS column_name, "
                             f"count(*) FILTER (length({f.name}) > {most}) AS too_long, count(*) AS total_rows FROM b_{name}")
    return " UNION ALL ".join(parts)


@check("dq_14_lengths", sql(_lengths_sql()))
def _(d):
    parts = []
    for name, spec in RAW_TABLES.items():
        halved = T.StructType([
            T.StructField(f.name, f.dataType, True, {**f.metadata, "max_length": f.metadata["max_length"] // 2})
            for f in spec.schema.fields if "max_length" in f.metadata])
        parts.append(quality.rule_summary(d.raw(name), quality.length_rules(halved), name))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("table_name", F.split("rule_name", " ")[0].alias("column_name"), F.col("broken_rows").alias("too_long"), "total_rows")


# -- joins ------------------------------------------------------------------------------

def _join(name: str, left: str, right: str, on: str, how: str, shows: str, answer: str):
    """Valid rows of one silver table joined to valid rows of another."""
    @check(name, sql(answer))
    def _(d):
        both = lookup(valid(d.silver(left)), valid(d.silver(right)).select(on, *names(shows)[1:]), on, how)
        return both.select(*names(shows))


for _n, _master, _code, _text in (
        (1, "region", "region_code", "region_name"), (2, "currency", "currency_code", "currency_name"),
        (3, "tax", "tax_code", "tax_type")):
    _join(f"jn_{_n:02d}_country_{_master}", "country_master", f"{_master}_master", _code, "left", f"country_code {_text}",
          f"SELECT c.country_code, m.{_text} FROM s_country_master c LEFT JOIN s_{_master}_master m "
          f"ON c.{_code} = m.{_code} AND m.is_valid_record WHERE c.is_valid_record")
for _n, _left, _right, _on, _shows in (
        (4, "product_sku_master", "product_model_master", "model_code", "sku_code model_name"),
        (5, "product_model_master", "product_family_master", "family_code", "model_code family_name"),
        (6, "product_family_master", "product_category_master", "category_code", "family_code category_name")):
    _join(f"jn_{_n:02d}_{_left.split('_')[1]}_{_right.split('_')[1]}", _left, _right, _on, "inner", _shows,
          f"SELECT a.{_shows.split()[0]}, b.{_shows.split()[1]} FROM s_{_left} a JOIN s_{_right} b "
          f"ON a.{_on} = b.{_on} AND b.is_valid_record WHERE a.is_valid_record")
for _n, _right, _on, _text in (
        (7, "product_sku_master", "sku_code", "variant"), (8, "country_master", "country_code", "market_tier")):
    @check(f"jn_{_n:02d}_availability_{_right.split('_')[-2]}", sql(
        f"SELECT a.sku_code, a.country_code, b.{_text} FROM s_product_country_availability a JOIN s_{_right} b "
        f"ON a.{_on} = b.{_on} AND b.is_valid_record WHERE a.is_valid_record"))
    def _(d, right=_right, on=_on, text=_text):
        pairs = valid(d.silver("product_country_availability")).select("sku_code", "country_code")
        return lookup(pairs, valid(d.silver(right)).select(on, text), on).select("sku_code", "country_code", text)


@check("jn_09_header_customer", sql(
    "SELECT h.transaction_id, c.customer_dim_key FROM s_sales_header h JOIN g_dim_customer c USING (customer_id) "
    "WHERE h.is_valid_record"))
def _(d):
    customers = facts.current(dimensions.dim_customer(d.silver("customer_master")))
    return lookup(valid(d.silver("sales_header")), customers.select("customer_id", "customer_dim_key"),
                  "customer_id").select("transaction_id", "customer_dim_key")


@check("jn_09_shuffled", ORACLES["jn_09_header_customer"])
def _(d):
    customers = facts.current(dimensions.dim_customer(d.silver("customer_master")))
    return lookup(valid(d.silver("sales_header")), customers.select("customer_id", "customer_dim_key"),
                  "customer_id", broadcast_bytes=0).select("transaction_id", "customer_dim_key")


@check("jn_10_header_store", sql(
    "SELECT h.transaction_id, s.store_dim_key FROM s_sales_header h JOIN g_dim_store s ON h.store_id = s.store_code "
    "WHERE h.is_valid_record"))
def _(d):
    stores = facts.current(dimensions.dim_store(d.silver("store_master"))).select(
        F.col("store_code").alias("store_id"), "store_dim_key")
    return lookup(valid(d.silver("sales_header")), stores, "store_id").select("transaction_id", "store_dim_key")


def _country(d: Data) -> DataFrame:
    return dimensions.dim_country(*[d.silver(f"{n}_master") for n in ("country", "region", "currency", "tax")])


@check("jn_11_store_country", sql(
    "SELECT s.store_code AS store_id, s.store_dim_key, n.country_dim_key FROM g_dim_store s "
    "JOIN g_dim_country n USING (country_code)"))
def _(d):
    return facts.stores_with_country(dimensions.dim_store(d.silver("store_master")), _country(d))


@check("jn_12_header_date", sql(
    "SELECT h.transaction_id, x.date_dim_key FROM s_sales_header h JOIN g_dim_date x "
    "ON h.transaction_timestamp = x.date_key WHERE h.is_valid_record"))
def _(d):
    header = d.silver("sales_header")
    days = dimensions.dim_date(header).select(F.col("date_key").alias("transaction_timestamp"), "date_dim_key")
    return lookup(valid(header), days, "transaction_timestamp").select("transaction_id", "date_dim_key")


@check("jn_13_item_header", sql(
    "SELECT i.transaction_line_id, f.fact_sales_header_key FROM s_sales_item i JOIN g_fact_sales_header f "
    "USING (transaction_id) WHERE i.is_valid_record"))
def _(d):
    header = d.gold("fact_sales_header").select("transaction_id", "fact_sales_header_key")
    return lookup(valid(d.silver("sales_item")), header, "transaction_id").select(
        "transaction_line_id", "fact_sales_header_key")


@check("jn_13_item_header_bucketed", sql(
    "SELECT i.transaction_line_id, f.fact_sales_header_key FROM s_sales_item i JOIN g_fact_sales_header f "
    "USING (transaction_id) WHERE i.is_valid_record"))
def _(d):
    def bucketed(df: DataFrame) -> DataFrame:
        path = d.folder()
        return tables.save_bucketed(df, f"bucketed_{path[-32:]}", path, ["transaction_id"], 8)

    lines = bucketed(valid(d.silver("sales_item")).select("transaction_id", "transaction_line_id"))
    header = bucketed(d.gold("fact_sales_header").select("transaction_id", "fact_sales_header_key"))
    return lines.join(header.hint("merge"), "transaction_id").select("transaction_line_id", "fact_sales_header_key")


@check("jn_14_item_product", sql(
    "SELECT i.transaction_line_id, p.product_dim_key FROM s_sales_item i JOIN g_dim_product p USING (sku_code) "
    "WHERE i.is_valid_record"))
def _(d):
    articles = facts.current(d.gold("dim_product")).select("sku_code", "product_dim_key")
    return lookup(valid(d.silver("sales_item")), articles, "sku_code").select("transaction_line_id", "product_dim_key")


def _star(d: Data, *dims: tuple[str, str, str]) -> DataFrame:
    out = d.gold("fact_sales_header")
    for name, on, text in dims:
        out = lookup(out, d.gold(name).select(on, text), on)
    return out.select("transaction_id", *[text for _, _, text in dims])


@check("jn_15_daily_star", sql(
    "SELECT f.transaction_id, d.year_month, s.store_name, n.country_name FROM g_fact_sales_header f "
    "JOIN g_dim_date d USING (date_dim_key) JOIN g_dim_store s USING (store_dim_key) "
    "JOIN g_dim_country n ON n.country_dim_key = f.country_dim_key"))
def _(d):
    return _star(d, ("dim_date", "date_dim_key", "year_month"), ("dim_store", "store_dim_key", "store_name"),
                 ("dim_country", "country_dim_key", "country_name"))


for _n, _grain, _text in ((16, "weekly", "week_number"), (17, "monthly", "month_number")):
    @check(f"jn_{_n}_{_grain}_star", sql(
        f"SELECT f.transaction_id, d.{_text}, n.region_name FROM g_fact_sales_header f "
        "JOIN g_dim_date d USING (date_dim_key) JOIN g_dim_country n USING (country_dim_key)"))
    def _(d, text=_text):
        return _star(d, ("dim_date", "date_dim_key", text), ("dim_country", "country_dim_key", "region_name"))


@check("jn_18_fact_dimension", sql(
    "SELECT f.transaction_id, c.loyalty_tier FROM g_fact_sales_header f JOIN g_dim_customer c USING (customer_dim_key)"))
def _(d):
    return _star(d, ("dim_customer", "customer_dim_key", "loyalty_tier"))


# the days of sale are moved by 20 years, to where the models are on the market
@check("jn_19_interval", sql("""
    SELECT p.family_code, CAST(p.day AS VARCHAR) AS day, count(*) AS models
    FROM (SELECT DISTINCT a.family_code, f.transaction_timestamp + 7305 AS day FROM g_fact_sales_item f JOIN g_dim_product a USING (product_dim_key)) p
    JOIN (FROM s_product_model_master WHERE is_valid_record) m
      ON m.family_code = p.family_code AND m.launch_date <= p.day AND (m.discontinue_date IS NULL OR p.day < m.discontinue_date)
    GROUP BY 1, 2"""))
def _(d):
    # models of a family on the market on each day on which an article of the family was sold
    lines = lookup(d.gold("fact_sales_item"), d.gold("dim_product").select("product_dim_key", "family_code"), "product_dim_key")
    days = lines.select("family_code", F.date_add("transaction_timestamp", 7305).alias("day")).distinct()
    models = valid(d.silver("product_model_master")).select("model_code", "family_code", "launch_date", "discontinue_date")
    held = interval_join(days, models, "day", "launch_date", "discontinue_date", ["family_code"])
    return held.groupBy("family_code", "day").agg(F.count(F.lit(1)).alias("models"))


@check("jn_19_interval_without_key", sql("""
    SELECT CAST(d.day AS VARCHAR) AS day, count(*) AS models, count(DISTINCT m.family_code) AS families
    FROM (SELECT date_key + 7305 AS day FROM g_dim_date) d JOIN (FROM s_product_model_master WHERE is_valid_record) m
      ON m.launch_date <= d.day AND (m.discontinue_date IS NULL OR d.day < m.discontinue_date) GROUP BY 1"""))
def _(d):
    models = valid(d.silver("product_model_master")).select("model_code", "family_code", "launch_date", "discontinue_date")
    days = d.gold("dim_date").select(F.date_add("date_key", 7305).alias("day"))
    held = interval_join(days, models, "day", "launch_date", "discontinue_date")
    return held.groupBy("day").agg(F.count(F.lit(1)).alias("models"), F.countDistinct("family_code").alias("families"))


# -- aggregates -------------------------------------------------------------------------

def _group(name: str, by: list[str], answer: str, *aggs: Callable[[], Column]):
    @check(name, sql(f"SELECT {', '.join(by)}, {answer} FROM b_sales_header GROUP BY {', '.join(by)}"))
    def _(d):
        return d.raw("sales_header").groupBy(*by).agg(*[a() for a in aggs])


_group("agg_01_count", ["channel_id"], "count(*) AS transactions", lambda: F.count(F.lit(1)).alias("transactions"))
_group("agg_02_sum", ["channel_id", "currency"],
       "CAST(sum(gross_amount) AS DOUBLE) AS gross, CAST(sum(total_tax) AS DOUBLE) AS tax",
       lambda: F.sum("gross_amount").alias("gross"), lambda: F.sum("total_tax").alias("tax"))
_group("agg_03_avg", ["currency"], f"{AVERAGE.format('net_total')} AS average",
       lambda: summaries.mean("net_total").alias("average"))
_group("agg_04_count_distinct", ["channel_id"], "count(DISTINCT customer_id) AS customers",
       lambda: F.countDistinct("customer_id").alias("customers"))
_group("agg_05_three_distinct_counts", ["channel_id", "currency"],
       "count(DISTINCT customer_id) AS customers, count(DISTINCT store_id) AS stores, "
       "count(DISTINCT transaction_timestamp) AS days, CAST(sum(net_total) AS DOUBLE) AS net",
       lambda: F.countDistinct("customer_id").alias("customers"), lambda: F.countDistinct("store_id").alias("stores"),
       lambda: F.countDistinct("transaction_timestamp").alias("days"), lambda: F.sum("net_total").alias("net"))
_group("agg_06_min_max_day", ["store_id"],
       "CAST(min(transaction_timestamp) AS VARCHAR) AS first_day, CAST(max(transaction_timestamp) AS VARCHAR) AS last_day",
       lambda: F.min("transaction_timestamp").alias("first_day"), lambda: F.max("transaction_timestamp").alias("last_day"))


@check("agg_07_many_keys", sql(
    "SELECT year_number, week_number, country_code, region_name, channel_id, currency, sum(transaction_count) AS sales "
    "FROM g_fact_sales_weekly GROUP BY 1, 2, 3, 4, 5, 6"))
def _(d):
    keys = ["year_number", "week_number", "country_code", "region_name", "channel_id", "currency"]
    return d.gold("fact_sales_weekly").groupBy(*keys).agg(F.sum("transaction_count").alias("sales"))


_LEVELS = {"store": ["region_name", "country_name", "store_code"], "country": ["region_name", "country_name"], "region": ["region_name"], "all": []}


@check("agg_11_levels", sql("""
    SELECT CASE WHEN grouping(s.store_code) = 0 THEN 'store' WHEN grouping(n.country_name) = 0 THEN 'country'
                WHEN grouping(n.region_name) = 0 THEN 'region' ELSE 'all' END AS level, n.region_name, n.country_name, s.store_code,
           count(*) AS transactions, CAST(sum(f.net_total) AS DOUBLE) AS net, count(DISTINCT f.customer_dim_key) AS unique_customers
    FROM g_fact_sales_header f JOIN g_dim_store s USING (store_dim_key) JOIN g_dim_country n ON n.country_dim_key = f.country_dim_key
    GROUP BY GROUPING SETS ((n.region_name, n.country_name, s.store_code), (n.region_name, n.country_name), (n.region_name), ())"""))
def _(d):
    sales = lookup(d.gold("fact_sales_header"), d.gold("dim_store").select("store_dim_key", "store_code"), "store_dim_key")
    sales = lookup(sales, d.gold("dim_country").select("country_dim_key", "region_name", "country_name"), "country_dim_key")
    return ranking.on_levels(sales, _LEVELS, {"transactions": F.count(F.lit(1)), "net": F.sum("net_total")}, {"unique_customers": "customer_dim_key"})


def _distinct_sql(by: str, where: str = "true") -> str:
    return sql(f"SELECT {by + ', ' if by else ''}count(DISTINCT customer_dim_key) AS unique_customers FROM g_fact_sales_header "
               f"JOIN g_dim_date USING (date_dim_key) WHERE {where} {'GROUP BY ALL' if by else ''}")


def _unique_customers(d: Data, by=(), within=None) -> DataFrame:
    return customers.unique_customers(d.gold("customer_days"), d.gold("dim_date"), by, within)


@check("agg_05_weekly_from_bitmaps", _distinct_sql("year_number, week_number, country_dim_key, channel_id, currency"))
def _(d):
    return _unique_customers(d, ["year_number", "week_number", "country_dim_key", "channel_id", "currency"])


@check("agg_05_monthly_from_bitmaps", _distinct_sql("year_month, channel_id"))
def _(d):
    return _unique_customers(d, ["year_month", "channel_id"])


@check("agg_05_any_days_from_bitmaps", _distinct_sql("country_dim_key", "date_key BETWEEN DATE '1995-03-10' AND DATE '1996-02-20'"))
def _(d):
    return _unique_customers(d, ["country_dim_key"], F.col("date_key").between("1995-03-10", "1996-02-20"))


@check("agg_05_all_days_from_bitmaps", _distinct_sql(""))
def _(d):
    return _unique_customers(d)


@check("agg_08_by_name", sql(
    "SELECT n.region_name, CAST(sum(f.net_total) AS DOUBLE) AS net FROM g_fact_sales_header f "
    "JOIN g_dim_country n USING (country_dim_key) GROUP BY n.region_name"))
def _(d):
    both = lookup(d.gold("fact_sales_header"), d.gold("dim_country").select("country_dim_key", "region_name"),
                  "country_dim_key")
    return both.groupBy("region_name").agg(F.sum("net_total").alias("net"))


@check("agg_09_distinct", sql("SELECT DISTINCT CAST(transaction_timestamp AS VARCHAR) AS day, currency FROM b_sales_header"))
def _(d):
    return d.raw("sales_header").select(F.col("transaction_timestamp").alias("day"), "currency").distinct()


_group("agg_10_single_table", ["channel_id"],
       f"count(DISTINCT transaction_id) AS transactions, CAST(sum(net_total) AS DOUBLE) AS total, "
       f"{AVERAGE.format('net_total')} AS average",
       lambda: F.countDistinct("transaction_id").alias("transactions"), lambda: F.sum("net_total").alias("total"),
       lambda: summaries.mean("net_total").alias("average"))


# -- newest row per key -----------------------------------------------------------------

@check("win_01_keep_latest", sql(
    "SELECT transaction_line_id, sku_code, quantity, __source_row_number, "
    "strftime(__bronze_load_ts, '%Y-%m-%d %H:%M:%S.%f') AS __bronze_load_ts FROM s_sales_item"))
def _(d):
    return keep_latest(d.raw("sales_item"), ["transaction_line_id"]).select(
        "transaction_line_id", "sku_code", "quantity", F.col(ROW_NUMBER).alias("__source_row_number"),
        F.col(LOAD_TS).alias(BRONZE_TS))


@check("win_01_keep_latest_event", """
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def _(d):
    return keep_latest(d.source("events"), ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", "value")


@check("win_02_keep_latest_pair", sql(
    "SELECT sku_code, country_code, CAST(local_launch_date AS VARCHAR) AS local_launch_date, is_available "
    "FROM s_product_country_availability"))
def _(d):
    return keep_latest(d.raw("product_country_availability"), ["sku_code", "country_code"]).select(
        "sku_code", "country_code", "local_launch_date", "is_available")


_STORE_SALES = """
    SELECT n.region_name, s.store_code, sum(f.net_total) AS net FROM g_fact_sales_header f
    JOIN g_dim_store s USING (store_dim_key) JOIN g_dim_country n ON n.country_dim_key = f.country_dim_key GROUP BY 1, 2"""


def _best_sql(source: str, group: str, item: str, measure: str, k: int) -> str:
    order = f"(PARTITION BY {group} ORDER BY {measure} DESC)"
    return sql(f"""SELECT {group}, {item}, CAST({measure} AS DOUBLE) AS {measure}, rank() OVER {order} AS rank, dense_rank() OVER {order} AS dense_rank,
        CAST({measure} AS DOUBLE) / CAST(sum({measure}) OVER (PARTITION BY {group}) AS DOUBLE) AS share FROM ({source}) QUALIFY rank() OVER {order} <= {k}""")


@check("win_03_top_per_region", _best_sql(_STORE_SALES, "region_name", "store_code", "net", 3))
def _(d):
    sales = lookup(d.gold("fact_sales_header"), d.gold("dim_store").select("store_dim_key", "store_code"), "store_dim_key")
    sales = lookup(sales, d.gold("dim_country").select("country_dim_key", "region_name"), "country_dim_key")
    stores = sales.groupBy("region_name", "store_code").agg(F.sum("net_total").alias("net"))
    return ranking.best_of_each(stores, ["region_name"], "net", 3, "share")


@check("win_03_top_articles_with_ties", _best_sql("""
    SELECT p.category_name, p.sku_code, count(*) AS lines FROM g_fact_sales_item f JOIN g_dim_product p USING (product_dim_key) GROUP BY 1, 2""",
    "category_name", "sku_code", "lines", 2).replace("CAST(lines AS DOUBLE) AS lines", "lines"))
def _(d):
    lines = lookup(d.gold("fact_sales_item"), d.gold("dim_product").select("product_dim_key", "category_name", "sku_code"), "product_dim_key")
    return ranking.best_of_each(lines.groupBy("category_name", "sku_code").agg(F.count(F.lit(1)).alias("lines")), ["category_name"], "lines", 2, "share")


# -- order and limit --------------------------------------------------------------------

@check("srt_01_by_aggregate", sql(
    "SELECT store_id, CAST(sum(net_total) AS DOUBLE) AS total FROM b_sales_header GROUP BY store_id "
    "ORDER BY total DESC NULLS FIRST"))
def _(d):
    return d.raw("sales_header").groupBy("store_id").agg(F.sum("net_total").alias("total")).orderBy(
        F.desc_nulls_first("total"))


@check("srt_02_by_key", sql(
    "SELECT strftime(transaction_timestamp, '%Y-%m') AS month, count(*) AS sales FROM b_sales_header GROUP BY 1 ORDER BY 1"))
def _(d):
    months = d.raw("sales_header").groupBy(F.date_format("transaction_timestamp", "yyyy-MM").alias("month"))
    return months.agg(F.count(F.lit(1)).alias("sales")).orderBy("month")


@check("srt_03_top_10", sql(
    "SELECT customer_id, CAST(sum(net_total) AS DOUBLE) AS total FROM b_sales_header GROUP BY customer_id "
    "ORDER BY total DESC, customer_id LIMIT 10"))
def _(d):
    totals = d.raw("sales_header").groupBy("customer_id").agg(F.sum("net_total").alias("total"))
    return totals.orderBy(F.desc("total"), "customer_id").limit(10)


@check("srt_04_two_columns", sql(
    "SELECT currency, channel_id, count(*) AS sales FROM b_sales_header GROUP BY ALL ORDER BY currency, channel_id"))
def _(d):
    return d.raw("sales_header").groupBy("currency", "channel_id").agg(F.count(F.lit(1)).alias("sales")).orderBy(
        "currency", "channel_id")


# -- scalar functions -------------------------------------------------------------------

def _scalar(name: str, expression: str, value: Callable[[], Column], source: str = "orders", row: str = "o_orderkey"):
    @check(name, f"SELECT {row}, {expression} AS value FROM {source}")
    def _(d):
        return d.source(source).select(row, value().alias("value"))


_DAY = "o_orderdate"
_scalar("fn_01_sha256", "sha256(c_name)", lambda: F.sha2("c_name", 256), "customer", "c_custkey")
_scalar("fn_02_concat", "concat(c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR))",
        lambda: F.concat("c_name", "c_mktsegment", F.col("c_nationkey").cast("string")), "customer", "c_custkey")
_scalar("fn_03_concat_operator", f"'Q' || quarter({_DAY})", lambda: cal.calendar(_DAY)["quarter_name"])
_scalar("fn_04_null_default", "coalesce(nullif(p_type, 'PROMO'), '')",
        lambda: F.coalesce(F.nullif("p_type", F.lit("PROMO")), F.lit("")), "part", "p_partkey")
_scalar("fn_05_time_text", "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')", lambda: micros_text("ts"), "events", "event_id")
_scalar("fn_06_compact_day", f"strftime({_DAY}, '%Y%m%d')", lambda: F.date_format(_DAY, "yyyyMMdd"))
for _slug, _expression, _column in (
        ("fn_07_year_text", "strftime(o_orderdate, '%Y')", "year_name"),
        ("fn_08_month_name", "strftime(o_orderdate, '%B')", "month_name"),
        ("fn_09_short_month", "strftime(o_orderdate, '%b')", "month_short_name"),
        ("fn_10_short_day", "strftime(o_orderdate, '%a')", "day_name"),
        ("fn_11_year_month", "strftime(o_orderdate, '%Y-%m')", "year_month"),
        ("fn_12_year_quarter", "year(o_orderdate) || '-Q' || quarter(o_orderdate)", "year_quarter"),
        ("fn_14_week", "weekofyear(o_orderdate)", "week_number"),
        ("fn_16_day_of_week", "dayofweek(o_orderdate)", "day_of_week"),
        ("fn_17_fiscal_year", "CASE WHEN month(o_orderdate) > 3 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END",
         "fiscal_year"),
        ("fn_18_fiscal_quarter", "(quarter(o_orderdate) + 2) % 4 + 1", "fiscal_quarter"),
        ("fn_19_weekend", "isodow(o_orderdate) > 5", "is_weekend")):
    _scalar(_slug, _expression, partial(lambda column: cal.calendar(_DAY)[column], _column))


@check("fn_13_year_quarter_month", "SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, "
       "month(o_orderdate) AS m FROM orders")
def _(d):
    return d.source("orders").select("o_orderkey", F.year(_DAY).alias("y"), F.quarter(_DAY).alias("q"),
                                     F.month(_DAY).alias("m"))


@check("fn_15_day_numbers", "SELECT o_orderkey, dayofyear(o_orderdate) AS of_year, day(o_orderdate) AS of_month FROM orders")
def _(d):
    return d.source("orders").select("o_orderkey", F.dayofyear(_DAY).alias("of_year"),
                                     F.dayofmonth(_DAY).alias("of_month"))


_scalar("fn_20_trim", "trim('  ' || p_name || ' ')", lambda: F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))),
        "part", "p_partkey")
_scalar("fn_21_like", "p_name LIKE '%o%t'", lambda: F.col("p_name").like("%o%t"), "part", "p_partkey")


@check("fn_22_now", "SELECT count(*) AS rows, 1 AS moments, true AS recent FROM orders")
def _(d):
    stamped = d.source("orders").withColumn("now", F.current_timestamp())
    return stamped.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("now").alias("moments"),
        F.max(F.abs(F.unix_timestamp("now") - F.unix_timestamp(F.current_timestamp())) < 60).alias("recent"))


# -- streaming and refresh --------------------------------------------------------------

def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@check("inc_01_keep_latest_stream", sql(f"SELECT {columns(_raw_columns('sales_item') + ' ' + SILVER_TAIL)} FROM s_sales_item"))
def _(d):
    # the raw table arrives in six appends; every one is folded in by its own micro-batch
    spec, raw, at = RAW_TABLES["sales_item"], d.folder(), d.folder()
    d.raw("sales_item").repartition(6).write.parquet(raw)
    newest = LatestTable(d.spark, f"{at}/table", spec.schema, spec.keys)
    _finish(jobs.keep_newest(jobs.read_new_rows(d.spark, raw, spec.schema, 2), newest, f"{at}/checkpoint"))
    return flagged(newest.read(), "sales_item")


@check("inc_02_dimension_after_change", sql("""
    SELECT store_code, floor_area_sqft + 1 AS floor_area_sqft,
           sha256(store_code || '2024-02-01 00:00:00.000000') AS store_dim_key FROM g_dim_store"""))
def _(d):
    # every store is loaded twice, the second time one square foot larger
    spec, raw, at = RAW_TABLES["store_master"], d.folder(), d.folder()
    first = d.raw("store_master")
    later = first.withColumn("floor_area_sqft", F.col("floor_area_sqft") + 1).withColumn(
        LOAD_TS, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    newest = LatestTable(d.spark, f"{at}/table", spec.schema, spec.keys)
    for load in (first, later):
        tables.append(load, raw)
        _finish(jobs.keep_newest(jobs.read_new_rows(d.spark, raw, spec.schema), newest, f"{at}/checkpoint"))
    newest.compact()
    return dimensions.dim_store(flagged(newest.read(), spec.name)).select(
        "store_code", "floor_area_sqft", "store_dim_key")


def _monthly(d: Data, sales: DataFrame) -> DataFrame:
    out = summaries.fact_sales_monthly(sales, d.gold("dim_date"), d.gold("dim_country"))
    return out.withColumn(jobs.MONTH, F.col("year_month"))


def _refreshed_months(d: Data, first: DataFrame, then: DataFrame, newest: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The monthly summary after two streamed deliveries of facts; ``newest`` picks the rows that count."""
    fact, summary, checkpoint = d.folder(), d.folder(), d.folder()
    whole = lambda: newest(tables.read(d.spark, fact, first.schema))
    for part in (first, then):
        tables.append(part, fact)
        _finish(jobs.refresh_touched(
            d.spark.readStream.schema(first.schema).option("recursiveFileLookup", "true").parquet(fact), jobs.MONTH,
            ["transaction_id"], whole, lambda sales: _monthly(d, sales), summary, checkpoint))
    return d.spark.read.parquet(summary).select(*names(GOLD_COLUMNS["fact_sales_monthly"]))


@check("inc_03_refresh_touched_months", table("g_fact_sales_monthly", GOLD_COLUMNS["fact_sales_monthly"]))
def _(d):
    # the summary starts from the sales of two channels, then the third arrives
    header = d.gold("fact_sales_header")
    late = F.col("channel_id") == "WEB"
    return _refreshed_months(d, header.filter(~late), header.filter(late), lambda rows: rows)


@check("inc_03_moved_month", table("g_fact_sales_monthly", GOLD_COLUMNS["fact_sales_monthly"]))
def _(d):
    # every third sale is delivered in January 1992 first and then corrected to its true day
    header = d.gold("fact_sales_header").withColumn("delivery", F.lit(2))
    one = d.gold("dim_date").agg(F.min_by(F.struct("date_key", "date_dim_key"), "date_key").alias("day"))
    day = one.first()["day"]
    moved = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0
    wrong = header.filter(moved).withColumns({
        "transaction_timestamp": F.lit(day["date_key"]), "date_dim_key": F.lit(day["date_dim_key"]), "delivery": F.lit(1)})
    wrong = wrong.withColumn(jobs.MONTH, jobs.month_of("transaction_timestamp"))
    first = header.filter(~moved).unionByName(wrong)
    return _refreshed_months(d, first, header.filter(moved), lambda rows: keep_latest(rows, ["transaction_id"], ["delivery"]))


@check("inc_04_freshness", table("g_fact_sales_daily", GOLD_COLUMNS["fact_sales_daily"]))
def _(d):
    # a job with the trigger of the daily summary writes it for every batch of new sales
    header, target, arrived, checkpoint = d.gold("fact_sales_header"), d.folder(), d.folder(), d.folder()
    days, stores, countries = (d.gold(n) for n in ("dim_date", "dim_store", "dim_country"))

    def refresh() -> None:
        tables.replace(summaries.fact_sales_daily(tables.read(d.spark, arrived, header.schema), days, stores, countries), target)

    tables.append(header, arrived)
    changes = d.spark.readStream.schema(header.schema).option("recursiveFileLookup", "true").parquet(arrived)
    query = jobs.keep_fresh("fact_sales_daily", changes, refresh, checkpoint)
    try:
        until = time.time() + 120
        while not query.recentProgress and query.isActive and time.time() < until:
            time.sleep(0.1)  # the first batch runs at once, the next one when the trigger says so
    finally:
        query.stop()
    return d.spark.read.parquet(target).select(*names(GOLD_COLUMNS["fact_sales_daily"]))


@check("inc_05_batch_then_stream", table("b_sales_header", _raw_columns("sales_header")))
def _(d):
    # a batch load, an incremental one and another batch fill one raw table
    spec, target, checkpoint, landed = RAW_TABLES["sales_header"], d.folder(), d.folder(), [d.folder() for _ in range(3)]
    rows = d.raw(spec.name).select(*spec.columns)
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    for i, folder in enumerate(landed):
        rows.filter(part == i).write.option("header", "true").csv(folder)
    landing.load(d.spark, spec, landed[0], target)
    _finish(jobs.load_new_files(d.spark, spec, landed[1], target, checkpoint))
    landing.load(d.spark, spec, landed[2], target)
    return tables.read(d.spark, target, spec.schema).select(*spec.columns)


@check("inc_05_new_files_only", table("b_sales_header", _raw_columns("sales_header")))
def _(d):
    # the files of two days: the second run must not load the first day's again
    spec, landed, target, checkpoint = RAW_TABLES["sales_header"], d.folder(), d.folder(), d.folder()
    rows = d.raw(spec.name).select(*spec.columns)
    early = F.coalesce(F.col("transaction_timestamp") < F.lit("1998-01-01").cast("date"), F.lit(False))
    for part in (rows.filter(early), rows.filter(~early)):
        part.write.mode("append").option("header", "true").csv(landed)
        _finish(jobs.load_new_files(d.spark, spec, landed, target, checkpoint, files_per_batch=2))
    return tables.read(d.spark, target, spec.schema).select(*spec.columns)


# -- tables -----------------------------------------------------------------------------

for _number, _name in enumerate(RAW_TABLES, 1):
    @check(f"slv_{_number:02d}_{_name}", table(f"s_{_name}", f"{_raw_columns(_name)} {SILVER_TAIL}"))
    def _(d, name=_name):
        return d.silver(name)


@check("key_01_versioned_key", f"""
    SELECT event_id, {key('CAST(user_id AS VARCHAR)', "nullif(event_type, 'error')", ts='ts')} AS version_key FROM events""")
def _(d):
    return d.source("events").select(
        "event_id", versioned_key("ts", F.col("user_id").cast("string"), F.nullif("event_type", F.lit("error")))
        .alias("version_key"))


@check("key_02_bridge_keys", table("g_bridge_product_country", "bridge_key product_dim_key country_dim_key"))
def _(d):
    return dimensions.bridge_product_country(
        *[d.silver(n) for n in ("product_country_availability", "product_sku_master", "country_master")]).select(
        "bridge_key", "product_dim_key", "country_dim_key")


@check("key_03_date_key", "SELECT o_orderkey, sha256(strftime(o_orderdate, '%Y%m%d')) AS date_dim_key FROM orders")
def _(d):
    return d.source("orders").select("o_orderkey", date_key("o_orderdate").alias("date_dim_key"))


@check("scd_01_only_version", table("g_dim_customer", f"customer_id {TAIL}"))
def _(d):
    return dimensions.dim_customer(d.silver("customer_master")).select("customer_id", *names(TAIL))


@check("dim_01_country", table("g_dim_country", GOLD_COLUMNS["dim_country"]))
def _(d):
    return _country(d)


@check("dim_02_product", table("g_dim_product", GOLD_COLUMNS["dim_product"]))
def _(d):
    return dimensions.dim_product(*[d.silver(f"product_{n}_master") for n in ("sku", "model", "family", "category")])


@check("dim_03_store", table("g_dim_store", GOLD_COLUMNS["dim_store"]))
def _(d):
    return dimensions.dim_store(d.silver("store_master"))


@check("dim_04_customer", table("g_dim_customer", GOLD_COLUMNS["dim_customer"]))
def _(d):
    return dimensions.dim_customer(d.silver("customer_master"))


@check("dim_05_date", table("g_dim_date", GOLD_COLUMNS["dim_date"]))
def _(d):
    return dimensions.dim_date(d.silver("sales_header"))


@check("brg_01_product_country", table("g_bridge_product_country", GOLD_COLUMNS["bridge_product_country"]))
def _(d):
    return dimensions.bridge_product_country(
        *[d.silver(n) for n in ("product_country_availability", "product_sku_master", "country_master")])


@check("fct_01_sales_header", table("g_fact_sales_header", GOLD_COLUMNS["fact_sales_header"]))
def _(d):
    return facts.fact_sales_header(d.silver("sales_header"), dimensions.dim_customer(d.silver("customer_master")),
                                   dimensions.dim_store(d.silver("store_master")), _country(d))


@check("fct_02_sales_item", table("g_fact_sales_item", GOLD_COLUMNS["fact_sales_item"]))
def _(d):
    return facts.fact_sales_item(d.silver("sales_item"), d.gold("fact_sales_header"), d.gold("dim_product"))


for _number, _grain in enumerate(("daily", "weekly", "monthly"), 1):
    @check(f"agf_{_number:02d}_{_grain}", table(f"g_fact_sales_{_grain}", GOLD_COLUMNS[f"fact_sales_{_grain}"]))
    def _(d, grain=_grain):
        header, days, countries = d.gold("fact_sales_header"), d.gold("dim_date"), d.gold("dim_country")
        if grain == "daily":
            return summaries.fact_sales_daily(header, days, d.gold("dim_store"), countries)
        return getattr(summaries, f"fact_sales_{grain}")(header, days, countries)


@check("agf_02_weekly_iso_year", sql(
    "SELECT isoyear(d.date_key) AS year_number, d.week_number, f.country_dim_key, f.channel_id, f.currency, "
    "count(*) AS transaction_count, count(DISTINCT d.date_key) AS selling_days FROM g_fact_sales_header f "
    "JOIN g_dim_date d USING (date_dim_key) GROUP BY ALL"))
def _(d):
    weekly = summaries.fact_sales_weekly(d.gold("fact_sales_header"), d.gold("dim_date"), d.gold("dim_country"), iso=True)
    return weekly.select("year_number", "week_number", "country_dim_key", "channel_id", "currency",
                         "transaction_count", "selling_days")


# -- constraints ------------------------------------------------------------------------

def _pk_sql(name: str, column: str) -> str:
    return (f"SELECT '{name}' AS table_name, 'pk_{name}' AS constraint_name, 'PRIMARY KEY' AS constraint_type, "
            f"count(*) - count(DISTINCT {column}) AS violations FROM g_{name}")


def _fk_sql(ref: integrity.Reference) -> str:
    return (f"SELECT '{ref.table}' AS table_name, '{ref.name}' AS constraint_name, 'FOREIGN KEY' AS constraint_type, "
            f"count(*) AS violations FROM g_{ref.table} WHERE {ref.column} NOT IN (SELECT {ref.column} FROM g_{ref.parent})")


@check("cst_01_primary_keys", sql(" UNION ALL ".join(
    f"SELECT '{k.table}' AS table_name, count(*) - count({k.column}) AS null_rows, 0 AS repeated_keys, "
    f"count({k.column}) - count(DISTINCT {k.column}) AS surplus_rows FROM g_{k.table}" for k in integrity.KEYS)))
def _(d):
    parts = [integrity.key_violations(d.gold(k.table), [k.column]).select(F.lit(k.table).alias("table_name"), "*")
             for k in integrity.KEYS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@check("cst_01_repeated_lines", """
    SELECT 0 AS null_rows, count(*) FILTER (n > 1) AS repeated_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def _(d):
    return integrity.key_violations(d.source("lineitem"), ["l_orderkey", "l_linenumber"])


# Parents that lost rows: what the damaged copies keep, as SQL that both engines read.
_LEFT = {"dim_customer": "customer_id NOT LIKE '%7'", "dim_store": "store_code NOT LIKE '%3'", "dim_country": "country_code NOT LIKE '%1'",
         "dim_date": "date_key >= DATE '1993-01-01'", "dim_product": "sku_code NOT LIKE '%5'", "fact_sales_header": "transaction_id NOT LIKE '%9'"}


def _damaged_sql(ref: integrity.Reference) -> str:
    return (f"SELECT '{ref.name}' AS reference, count(*) AS orphan_rows FROM g_{ref.table} WHERE {ref.column} NOT IN "
            f"(SELECT {ref.column} FROM g_{ref.parent} WHERE {_LEFT[ref.parent]})")


for _query, _table in (("cst_02_header_references", "fact_sales_header"), ("cst_03_item_references", "fact_sales_item")):
    @check(_query, sql(" UNION ALL ".join(_damaged_sql(r) for r in integrity.REFERENCES if r.table == _table)))
    def _(d, child=_table):
        refs = [r for r in integrity.REFERENCES if r.table == child]
        return integrity.orphan_rows(d.gold(child), {r.name: (r.column, d.gold(r.parent).filter(_LEFT[r.parent]), r.column) for r in refs})


@check("cst_04_damaged_report", sql(" UNION ALL ".join(
    [f"SELECT '{k.table}' AS table_name, '{k.name}' AS constraint_name, 'PRIMARY KEY' AS constraint_type, "
     + (f"count(*) FILTER ({_LEFT[k.table]}) AS violations FROM g_{k.table}" if k.table == "dim_store" else f"0 AS violations FROM (SELECT 1)")
     for k in integrity.KEYS]
    + [_damaged_sql(r).replace(f"'{r.name}' AS reference, count(*) AS orphan_rows",
                               f"'{r.table}' AS table_name, '{r.name}' AS constraint_name, 'FOREIGN KEY' AS constraint_type, "
                               + ("2 * " if r.table == "dim_store" else "") + "count(*) AS violations")
       if r.parent in ("dim_store", "dim_date") else
       f"SELECT '{r.table}' AS table_name, '{r.name}' AS constraint_name, 'FOREIGN KEY' AS constraint_type, 0 AS violations"
       for r in integrity.REFERENCES])))
def _(d):
    # every store that is left is stored twice; stores and days that are gone leave sales behind
    tables_ = {n: d.gold(n) for n in sorted({k.table for k in integrity.KEYS})}
    stores = tables_["dim_store"].filter(_LEFT["dim_store"])
    tables_["dim_store"] = stores.unionByName(stores)
    tables_["dim_date"] = tables_["dim_date"].filter(_LEFT["dim_date"])
    return integrity.constraint_report(tables_)


@check("cst_03_missing_articles", sql("""
    SELECT sku_code AS missing_key, count(*) AS orphan_rows FROM s_sales_item
    WHERE sku_code NOT IN (SELECT sku_code FROM g_dim_product) GROUP BY sku_code"""))
def _(d):
    return integrity.orphans(d.silver("sales_item"), d.gold("dim_product"), "sku_code", "sku_code")


@check("cst_04_report", sql(" UNION ALL ".join(
    [_pk_sql(k.table, k.column) for k in integrity.KEYS] + [_fk_sql(r) for r in integrity.REFERENCES])))
def _(d):
    needed = {k.table for k in integrity.KEYS}
    return integrity.constraint_report({n: d.gold(n) for n in sorted(needed)})


# -- metrics ----------------------------------------------------------------------------

def _stacked(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@check("sem_01_logical_tables", sql(" UNION ALL ".join(
    f"SELECT '{n}' AS logical_table, count(*) AS rows FROM g_{n}" for n in answers.COLUMNS)))
def _(d):
    return _stacked([d.model.rows(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("logical_table"), "rows")
                     for n in metrics.LOGICAL])


def _logical_sql(name: str, text: str) -> str:
    cast = {"d": "CAST({0} AS VARCHAR)", "n": "CAST({0} AS DOUBLE)", "i": "CAST({0} AS BIGINT)", "": "{0}"}
    items = []
    for item in text.split():
        logical, _, column = item.partition("=")
        column, _, mark = column.partition(":")
        items.append(f"{cast[mark].format(column)} AS \"{logical}\"")
    return f"SELECT {', '.join(items)} FROM g_{name}"


for _name, _by_kind in answers.COLUMNS.items():
    for _kind, _text in _by_kind.items():
        _number = {"dimensions": "02", "times": "03", "row_facts": "04"}[_kind]

        @check(f"sem_{_number}_{_kind}_{_name}", sql(_logical_sql(_name, _text)))
        def _(d, name=_name, kind={"row_facts": "facts"}.get(_kind, _kind)):
            return d.model.rows(name, tuple(getattr(metrics.LOGICAL[name], kind)))


@check("sem_06_undeclared_values", sql(" UNION ALL ".join(
    f"SELECT '{table_}' AS table_name, '{n}' AS dimension, {column} AS value, count(*) AS rows "
    f"FROM g_{table_} WHERE {column} NOT IN ({', '.join(repr(v) for v in allowed)}) GROUP BY {column}"
    for table_, n, column, allowed in answers.VALUES)))
def _(d):
    return d.model.undeclared_values()


@check("sem_07_logical_keys", sql(" UNION ALL ".join(
    f"SELECT '{n}' AS logical_table, count(*) AS rows, count(DISTINCT {column}) AS keys FROM g_{n}"
    for n, (_, column) in answers.KEYS.items())))
def _(d):
    return _stacked([
        d.model.rows(t.name, [t.key]).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(packed(t.key)).alias("keys"))
        .select(F.lit(t.name).alias("logical_table"), "rows", "keys") for t in metrics.LOGICAL.values()])


for _link, (_source, _target, _on) in answers.LINKS.items():
    @check(f"sem_08_{_link}", sql(f"SELECT count(*) AS matched FROM g_{_source} a JOIN g_{_target} b ON a.{_on} = b.{_on}"))
    def _(d, link=_link):
        source, target = next((s, t) for n, s, _, t, _ in metrics.RELATIONSHIPS if n == link)
        left, right = metrics.relationship(source, target)
        other = d.gold(target).select(packed(right).alias(left))
        return lookup(d.gold(source).select(packed(left).alias(left)), other, left).agg(F.count(F.lit(1)).alias("matched"))


@check("sem_09_named_filters", sql("""
    SELECT d.fiscal_year, CAST(sum(i.line_total) AS DOUBLE) AS total_line_revenue, count(*) AS total_line_items
    FROM g_fact_sales_item i JOIN g_dim_date d USING (date_dim_key) WHERE i.channel_id = 'WEB' GROUP BY 1"""))
def _(d):
    return d.model.query(["total_line_revenue", "line count"], ["fy"], ["web_sales"]).withColumnsRenamed(
        {"fy": "fiscal_year", "line count": "total_line_items"})


@check("sem_10_two_facts", sql(f"""
    SELECT * FROM (SELECT n.region_name, CAST(sum(net_total) AS DOUBLE) AS net_sales, count(*) AS transactions
                   FROM g_fact_sales_header f JOIN g_dim_country n USING (country_dim_key) GROUP BY 1)
    FULL JOIN (SELECT n.region_name, CAST(sum(quantity) AS BIGINT) AS units, {AVERAGE.format('unit_price')} AS price
               FROM g_fact_sales_item i JOIN g_dim_country n USING (country_dim_key) GROUP BY 1) USING (region_name)"""))
def _(d):
    return d.model.query({"net_sales": "net sales", "transactions": "total_transactions", "units": "units sold",
                          "price": "avg price"}, {"region_name": "dim_country.region_name"})


@check("sem_11_conditions", sql("""
    SELECT s.format_code AS store_format, f.payment_method, count(*) AS total_transactions FROM g_fact_sales_header f
    JOIN g_dim_store s USING (store_dim_key) JOIN g_dim_date d USING (date_dim_key)
    WHERE d.year_number BETWEEN 1996 AND 1999 AND s.format_code IN ('MALL', 'MINI') GROUP BY ALL"""))
def _(d):
    return d.model.query(["total_transactions"], ["store_format", "payment_method"],
                         [("dim_date.year", "between", (1996, 1999)), ("store_format", "in", ("MALL", "MINI"))])


for _number, (_name, (_shown, _column, _value, _from)) in enumerate(answers.METRICS.items(), 1):
    @check(f"met_{_number:02d}_{_name}", sql(f"SELECT {_column} AS {_shown}, {_value} AS {_name} FROM {_from} GROUP BY {_column}"))
    def _(d, name=_name, by=_shown):
        return d.model.query([name], [by])


@check("met_11_late_join", sql("""
    SELECT c.loyalty_tier, CAST(sum(f.net_total) AS DOUBLE) AS total_net_sales FROM g_fact_sales_header f
    JOIN g_dim_customer c USING (customer_dim_key) GROUP BY 1"""))
def _(d):
    return d.model.query(["total_net_sales"], ["loyalty_tier"], broadcast_bytes=0)


_VQ = {
    "vq_01_total_sales_by_region": (questions.total_sales_by_region, """
        SELECT n.region_name AS region, CAST(sum(f.net_total) AS DOUBLE) AS total_sales FROM g_fact_sales_header f
        JOIN g_dim_country n USING (country_dim_key) GROUP BY 1 ORDER BY 2 DESC NULLS FIRST"""),
    "vq_02_top_10_products": (questions.top_10_products, """
        SELECT p.model_name AS product, p.category_name AS category, CAST(sum(i.line_total) AS DOUBLE) AS revenue,
               CAST(sum(i.quantity) AS BIGINT) AS units_sold FROM g_fact_sales_item i
        JOIN g_dim_product p USING (product_dim_key) GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"""),
    "vq_03_monthly_sales_trend": (questions.monthly_sales_trend, """
        SELECT d.year_month AS month, CAST(sum(f.net_total) AS DOUBLE) AS net_sales,
               count(DISTINCT f.transaction_id) AS transactions FROM g_fact_sales_header f
        JOIN g_dim_date d USING (date_dim_key) GROUP BY 1 ORDER BY 1"""),
    "vq_04_sales_by_loyalty_tier": (questions.sales_by_loyalty_tier, f"""
        SELECT c.loyalty_tier, count(DISTINCT f.transaction_id) AS transactions,
               CAST(sum(f.net_total) AS DOUBLE) AS total_sales, {AVERAGE.format('f.net_total')} AS avg_transaction
        FROM g_fact_sales_header f JOIN g_dim_customer c USING (customer_dim_key) GROUP BY 1 ORDER BY 3 DESC"""),
    "vq_05_top_stores": (questions.top_stores, """
        SELECT s.store_name AS store, s.city, s.format_code AS format, count(*) AS transactions,
               CAST(sum(f.net_total) AS DOUBLE) AS total_sales FROM g_fact_sales_header f
        JOIN g_dim_store s USING (store_dim_key) GROUP BY 1, 2, 3 ORDER BY 5 DESC, 1, 2, 3 LIMIT 10"""),
    "vq_06_sales_by_category": (questions.sales_by_category, """
        SELECT p.category_name AS category, CAST(sum(i.quantity) AS BIGINT) AS units_sold,
               CAST(sum(i.line_total) AS DOUBLE) AS revenue FROM g_fact_sales_item i
        JOIN g_dim_product p USING (product_dim_key) GROUP BY 1 ORDER BY 3 DESC"""),
    "vq_07_sales_by_channel": (questions.sales_by_channel, f"""
        SELECT channel_id AS channel, count(DISTINCT transaction_id) AS transactions,
               CAST(sum(net_total) AS DOUBLE) AS total_sales, {AVERAGE.format('net_total')} AS avg_order_value
        FROM g_fact_sales_header GROUP BY 1"""),
    "vq_08_quarterly_sales": (questions.quarterly_sales, """
        SELECT d.year_quarter AS quarter, CAST(sum(f.net_total) AS DOUBLE) AS total_sales FROM g_fact_sales_header f
        JOIN g_dim_date d USING (date_dim_key) GROUP BY 1 ORDER BY 1"""),
}
for _name, (_question, _answer) in _VQ.items():
    @check(_name, sql(_answer))
    def _(d, question=_question):
        return question(d.model)


# -- history, periods and reports -------------------------------------------------------

_HISTORY = """
    SELECT user_id, event_type, event_id, ts AS start_ts, lead(ts) OVER newest_last AS next_ts FROM (
        SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM {0})
    WHERE before IS DISTINCT FROM event_type WINDOW newest_last AS (PARTITION BY user_id ORDER BY ts, event_id)"""


@check("ext_01_history", f"""
    SELECT user_id, event_type, event_id, strftime(start_ts, '%Y-%m-%d %H:%M:%S.%f') AS effective_start_ts,
           strftime(coalesce(next_ts, TIMESTAMP '9999-12-31 23:59:59'), '%Y-%m-%d %H:%M:%S.%f') AS effective_end_ts,
           next_ts IS NULL AS is_current FROM ({_HISTORY.format('events')})""")
def _(d):
    return history.history(d.source("events"), ["user_id"], ["event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", history.START, history.END, history.CURRENT)


@check("ext_01_history_chunked", ORACLES["ext_01_history"])
def _(d):
    return history.history(d.source("events"), ["user_id"], ["event_type"], ["ts", "event_id"], skew_bytes=0).select(
        "user_id", "event_type", "event_id", history.START, history.END, history.CURRENT)


def _store_loads(d: Data) -> DataFrame:
    """Every store loaded three times: the second load changes nothing, the third the area."""
    first = d.raw("store_master")
    loads = [first] + [first.withColumn(LOAD_TS, F.lit(day).cast("timestamp_ntz")) for day in ("2024-02-01", "2024-03-01")]
    loads[2] = loads[2].withColumn("floor_area_sqft", F.col("floor_area_sqft") + 1)
    return loads[0].unionByName(loads[1]).unionByName(loads[2])


@check("ext_01_store_versions", sql("""
    SELECT store_code, area AS floor_area_sqft, is_valid_record, starts AS effective_start_ts, ends AS effective_end_ts,
           ends LIKE '9999%' AS is_current, sha256(store_code || starts) AS store_dim_key
    FROM s_store_master, LATERAL (VALUES
        (floor_area_sqft, '2024-01-01 06:00:00.250000', '2024-03-01 00:00:00.000000'),
        (floor_area_sqft + 1, '2024-03-01 00:00:00.000000', '9999-12-31 23:59:59.000000')) AS v(area, starts, ends)"""))
def _(d):
    return versions.versions(_store_loads(d), "store_master").select(
        "store_code", "floor_area_sqft", "is_valid_record", history.START, history.END, history.CURRENT, "store_dim_key")


def _product_versions(d: Data, skew_bytes: int | None = None) -> DataFrame:
    names = ("product_sku_master", "product_model_master", "product_family_master", "product_category_master")
    return versions.product_versions(*[loads.loaded(d.raw(n), n) for n in names], skew_bytes)


@check("ext_01_product_versions", loads.PRODUCT_VERSIONS)
def _(d):
    # category, family, model and article loaded at different times, some of them invalid for a while
    return _product_versions(d)


@check("ext_01_product_versions_chunked", loads.PRODUCT_VERSIONS)
def _(d):
    return _product_versions(d, 0)


@check("ext_01_country_versions", loads.COUNTRY_VERSIONS)
def _(d):
    names = ("country_master", "region_master", "currency_master", "tax_master")
    return versions.country_versions(*[loads.loaded(d.raw(n), n) for n in names])


@check("ext_02_sales_as_of", sql("""
    SELECT transaction_id, sha256(store_id || starts) AS store_dim_key FROM (
        SELECT transaction_id, store_id, CASE WHEN transaction_timestamp + 10500 < DATE '2024-03-01'
               THEN '2024-01-01 06:00:00.250000' ELSE '2024-03-01 00:00:00.000000' END AS starts
        FROM s_sales_header WHERE transaction_timestamp + 10500 >= DATE '2024-01-01')
    WHERE store_id IN (SELECT store_code FROM g_dim_store)"""))
def _(d):
    # the days of sale are moved by 10,500 days, so that they fall around the loads of the stores
    sales = d.silver("sales_header").select(
        "transaction_id", "store_id", F.date_add("transaction_timestamp", 10500).alias("transaction_timestamp"))
    dated = versions.versions(_store_loads(d), "store_master")
    return versions.sales_as_of(sales, dated, "store_master", "store_id").select("transaction_id", "store_dim_key")


@check("ext_02_point_in_time", f"""
    SELECT p.event_id, p.user_id, p.value, h.event_type AS state, h.event_id AS state_event
    FROM (FROM events WHERE event_type = 'purchase') p
    JOIN ({_HISTORY.format("(FROM events WHERE event_type <> 'purchase')")}) h
      ON p.user_id = h.user_id AND p.ts >= h.start_ts AND (h.next_ts IS NULL OR p.ts < h.next_ts)""")
def _(d):
    events = d.source("events")
    versions = history.history(events.filter("event_type <> 'purchase'"), ["user_id"], ["event_type"], ["ts", "event_id"])
    versions = versions.select("user_id", F.col("event_type").alias("state"), F.col("event_id").alias("state_event"),
                               history.START, history.END)
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    return history.as_of(bought, versions, "user_id", "ts", ["state", "state_event"]).drop("ts")


@check("ext_02_as_of_chunked", ORACLES["ext_02_point_in_time"])
def _(d):
    events = d.source("events")
    held = history.history(events.filter("event_type <> 'purchase'"), ["user_id"], ["event_type"], ["ts", "event_id"], 0)
    held = held.select("user_id", F.col("event_type").alias("state"), F.col("event_id").alias("state_event"),
                       history.START, history.END)
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    return history.as_of(bought, held, "user_id", "ts", ["state", "state_event"], skew_bytes=0).drop("ts")


def _twice_in_one_load(d: Data) -> DataFrame:
    """Every store twice in one load, the second row one square foot larger and further down in the file."""
    first = d.raw("store_master")
    later = first.withColumns({"floor_area_sqft": F.col("floor_area_sqft") + 1, ROW_NUMBER: F.col(ROW_NUMBER) + 1_000_000})
    return later.unionByName(first)


@check("ext_01_same_load_versions", sql("""
    SELECT store_code, floor_area_sqft + 1 AS floor_area_sqft, '2024-01-01 06:00:00.250000' AS effective_start_ts, true AS is_current,
           0 AS repeated_keys FROM s_store_master"""))
def _(d):
    dated = versions.versions(_twice_in_one_load(d), "store_master")
    repeated = integrity.key_violations(dated, ["store_dim_key"]).first()["repeated_keys"]
    return dated.select("store_code", "floor_area_sqft", history.START, history.CURRENT, F.lit(repeated).alias("repeated_keys"))


@check("ext_02_same_load_as_of", sql("""
    SELECT transaction_id, store_id FROM s_sales_header WHERE transaction_timestamp + 10500 >= DATE '2024-01-01'
    AND store_id IN (SELECT store_code FROM g_dim_store)"""))
def _(d):
    sales = d.silver("sales_header").select(
        "transaction_id", "store_id", F.date_add("transaction_timestamp", 10500).alias("transaction_timestamp"))
    dated = versions.versions(_twice_in_one_load(d), "store_master")
    return versions.sales_as_of(sales, dated, "store_master", "store_id").select("transaction_id", "store_id")


_SERIES = "country_code, channel_id, currency"


def _period_sql(source: str, index: str, shows: str, steps: dict[str, int]) -> str:
    parts = []
    for name, n in steps.items():
        frame = f"OVER (PARTITION BY {_SERIES} ORDER BY idx RANGE BETWEEN {n} PRECEDING AND {n} PRECEDING)"
        parts.append(f"CAST(sum(net) {frame} AS DOUBLE) AS {name}_net, CAST(net - sum(net) {frame} AS DOUBLE) AS {name}_change")
        parts.append(f"CAST(net - sum(net) {frame} AS DOUBLE) / CAST(sum(net) {frame} AS DOUBLE) AS {name}_ratio")
    return sql(f"SELECT {shows}, {_SERIES}, CAST(net AS DOUBLE) AS net, {', '.join(parts)} "
               f"FROM (SELECT *, total_net_sales AS net, {index} AS idx FROM {source})")


@check("ext_03_month_over_month", _period_sql(
    "g_fact_sales_monthly", "year_number * 12 + month_number", "year_month", {"month": 1, "year": 12}))
def _(d):
    monthly = d.gold("fact_sales_monthly").withColumn("net", F.col("total_net_sales"))
    out = periods.with_changes(monthly, _SERIES.split(", "), periods.month_index("year_number", "month_number"), "net",
                               {"month": 1, "year": 12})
    return out.select("year_month", *_SERIES.split(", "), "net", "month_net", "month_change", "month_ratio",
                      "year_net", "year_change", "year_ratio")


@check("ext_03_week_over_week", _period_sql(
    "(SELECT *, date_trunc('week', week_start_date) AS monday FROM (SELECT isoyear(d.date_key) AS year_number, "
    "d.week_number, min(d.date_key) AS week_start_date, n.country_code, f.channel_id, f.currency, "
    "sum(f.net_total) AS total_net_sales FROM g_fact_sales_header f JOIN g_dim_date d USING (date_dim_key) "
    "JOIN g_dim_country n USING (country_dim_key) GROUP BY ALL))",
    "datediff('week', DATE '1970-01-05', monday)", "year_number, week_number", {"week": 1}))
def _(d):
    weekly = summaries.fact_sales_weekly(
        d.gold("fact_sales_header"), d.gold("dim_date"), d.gold("dim_country"), iso=True).withColumn(
        "net", F.col("total_net_sales"))
    out = periods.with_changes(weekly, _SERIES.split(", "), periods.week_index("week_start_date"), "net", {"week": 1})
    return out.select("year_number", "week_number", *_SERIES.split(", "), "net", "week_net", "week_change", "week_ratio")


@check("ext_04_dropped_rows", sql(" UNION ALL ".join(f"""
    SELECT '{label}' AS reference, count(DISTINCT k) FILTER (k IS NOT NULL) AS orphan_keys,
           count(k) AS orphan_rows, count(*) - count(k) AS null_rows
    FROM (SELECT {column} AS k FROM {child}
          WHERE ({column} IS NULL OR {column} NOT IN (SELECT {parent_column} FROM g_{parent})))"""
    for label, child, column, parent, parent_column in (
        ("store to country", "g_dim_store", "country_code", "dim_country", "country_code"),
        ("header to customer", "(FROM s_sales_header WHERE is_valid_record)", "customer_id", "dim_customer", "customer_id"),
        ("header to store", "(FROM s_sales_header WHERE is_valid_record)", "store_id", "dim_store", "store_code"),
        ("item to header", "(FROM s_sales_item WHERE is_valid_record)", "transaction_id", "fact_sales_header", "transaction_id"),
        ("item to product", "(FROM s_sales_item WHERE is_valid_record)", "sku_code", "dim_product", "sku_code")))))
def _(d):
    header, item = valid(d.stored("silver_sales_header")), valid(d.stored("silver_sales_item"))
    stores = integrity.dropped_rows(d.gold("dim_store"), {"store to country": ("country_code", d.gold("dim_country"), "country_code")})
    sales = integrity.dropped_rows(header, {
        "header to customer": ("customer_id", d.gold("dim_customer"), "customer_id"),
        "header to store": ("store_id", d.gold("dim_store"), "store_code")})
    lines = integrity.dropped_rows(item, {
        "item to header": ("transaction_id", d.gold("fact_sales_header"), "transaction_id"),
        "item to product": ("sku_code", d.gold("dim_product"), "sku_code")})
    return stores.unionByName(sales).unionByName(lines)


def _summary_sql(name: str) -> str:
    rules = []
    for number, (test, label) in enumerate(FLAWS[name], 1):
        earlier = " OR ".join(f"coalesce({t}, false)" for t, _ in FLAWS[name][:number - 1]) or "false"
        rules.append(
            f"SELECT '{name}' AS table_name, count(*) AS total_rows, {number} AS rule_number, '{label}' AS rule_name, "
            f"count(*) FILTER ({test}) AS broken_rows, count(*) FILTER (({test}) AND NOT ({earlier})) "
            f"AS first_broken_rows FROM s_{name}")
    return " UNION ALL ".join(rules)


@check("ext_05_rule_summary", sql(" UNION ALL ".join(_summary_sql(n) for n in RAW_TABLES)))
def _(d):
    parts = [quality.rule_summary(d.silver(n), quality.rules_for(n), n) for n in RAW_TABLES]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
