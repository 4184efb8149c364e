"""Raw tables derived from the test tables, in the shapes of :mod:`tallyhouse.schemas`.

Everything is an expression over whole test tables. The tables bring natural flaws:
repeated lines, stores with a negative rent, customers without a mail address, sales
without a store, articles of a model that was withdrawn before its launch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.schemas import RAW_TABLES, RawTable

_AUDIT = "timestamp_ntz'2024-01-01 06:00:00.25'"
_PERIOD = ["date'2000-01-01' as effective_start_date", "date'9999-12-31' as effective_end_date"]
_ORIGIN = [f"{_AUDIT} as created_at", "'TEST' as source_system"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _shape(df: DataFrame, spec: RawTable, *columns: str) -> DataFrame:
    """Compute the columns, then cast them to the declared types and metadata."""
    named = df.selectExpr(*columns)
    return named.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in spec.schema])


def _audit(source: str, number: str, load_ts: str = _AUDIT) -> list[str]:
    return [f"'{source}' as __file_name", f"{number} as __row_number", f"{load_ts} as __load_ts"]


def region_master(spark, sf_dir):
    return _shape(
        read(spark, sf_dir, "region"), RAW_TABLES["region_master"],
        "concat('R', r_regionkey) as region_code", "r_name as region_name", "'Y' as is_active",
        *_PERIOD, *_ORIGIN, *_audit("region", "r_regionkey + 1"))


def currency_master(spark, sf_dir):
    return _shape(
        read(spark, sf_dir, "nation"), RAW_TABLES["currency_master"],
        "concat('C', lpad(n_nationkey, 2, '0')) as currency_code", "concat('Money of ', n_name) as currency_name",
        "concat('$', n_nationkey) as currency_symbol", "n_nationkey % 3 as minor_unit",
        "if(n_nationkey in (7, 19), '?', 'Y') as is_active", *_PERIOD, *_ORIGIN, *_audit("nation", "n_nationkey + 1"))


def tax_master(spark, sf_dir):
    return _shape(
        read(spark, sf_dir, "nation"), RAW_TABLES["tax_master"],
        "concat('T', lpad(n_nationkey, 2, '0')) as tax_code",
        "case when n_regionkey in (0, 1) then 'VAT' when n_regionkey = 2 then 'GST' else 'SALES_TAX' end as tax_type",
        "cast(n_nationkey as decimal(5,2)) / 20 as tax_rate", "if(n_regionkey = 2, 'Y', 'N') as tax_inclusive_flag",
        "if(n_nationkey = 5, null, date'2020-01-01') as effective_start_date", _PERIOD[1], "'Y' as is_active",
        *_ORIGIN, *_audit("nation", "n_nationkey + 1"))


def country_master(spark, sf_dir):
    return _shape(
        read(spark, sf_dir, "nation"), RAW_TABLES["country_master"],
        "concat('N', lpad(n_nationkey, 2, '0')) as country_code", "n_name as country_name",
        "concat('R', n_regionkey) as region_code", "concat('C', lpad(n_nationkey, 2, '0')) as currency_code",
        "if(n_nationkey = 3, null, concat('T', lpad(n_nationkey, 2, '0'))) as tax_code",
        "concat('Language ', n_regionkey) as primary_language", "concat('Zone/', n_name) as timezone",
        "'Y' as ecommerce_supported", "if(n_nationkey = 11, 'X', 'Y') as retail_store_supported",
        "concat('Tier', n_nationkey % 3 + 1) as market_tier", *_audit("nation", "n_nationkey + 1"))


def product_category_master(spark, sf_dir):
    types = read(spark, sf_dir, "part").groupBy("p_type").agg(F.min("p_partkey").alias("first_part"))
    return _shape(
        types, RAW_TABLES["product_category_master"],
        "concat('K-', p_type) as category_code", "p_type as category_name",
        "case when p_type in ('SMALL', 'MEDIUM', 'LARGE') then 'Hardware' when p_type = 'PROMO' then 'Services' "
        "else 'Accessories' end as reporting_segment",
        "'Y' as is_active", *_PERIOD, *_ORIGIN, *_audit("part", "first_part + 1"))


def product_family_master(spark, sf_dir):
    brands = read(spark, sf_dir, "part").groupBy("p_type", "p_brand").agg(
        F.min("p_partkey").alias("first_part"), F.max("p_size").alias("largest"))
    return _shape(
        brands, RAW_TABLES["product_family_master"],
        "concat(p_type, '-', p_brand) as family_code", "concat(p_brand, ' ', p_type) as family_name",
        "concat('K-', p_type) as category_code", "1860 + largest as launch_year", "'Y' as is_active",
        "'ACTIVE' as lifecycle_status", *_ORIGIN, *_audit("part", "first_part + 1"))


def product_model_master(spark, sf_dir):
    sizes = read(spark, sf_dir, "part").groupBy("p_type", "p_brand", "p_size").agg(
        F.min("p_partkey").alias("first_part"))
    code = "concat(p_type, '-', replace(p_brand, 'Brand#', ''), '-', p_size)"
    return _shape(
        sizes, RAW_TABLES["product_model_master"],
        f"{code} as model_code", f"concat('Model ', {code}) as model_name",
        "concat(p_type, '-', p_brand) as family_code", "date_add(date'2015-01-01', p_size * 30) as launch_date",
        "case when p_size = 50 then date'2015-01-01' when p_size >= 45 then date'2023-01-01' end as discontinue_date",
        "if(p_size >= 45, 'DISCONTINUED', 'ACTIVE') as lifecycle_status", "'Y' as is_active",
        *_ORIGIN, *_audit("part", "first_part + 1"))


def product_sku_master(spark, sf_dir):
    return _shape(
        read(spark, sf_dir, "part"), RAW_TABLES["product_sku_master"],
        "concat('P', p_partkey) as sku_code",
        "concat(p_type, '-', replace(p_brand, 'Brand#', ''), '-', p_size) as model_code", "p_name as variant",
        "if(p_retailprice > 950, 'Premium', 'Standard') as price_tier",
        "date_add(date'2016-01-01', p_size) as global_launch_date", "'Y' as is_active",
        *_ORIGIN, *_audit("part", "p_partkey + 1"))


def product_country_availability(spark, sf_dir):
    # four rows per article; the last falls on the country of the first, so every pair is there twice
    offers = read(spark, sf_dir, "part").select(
        "p_partkey", "p_size", F.posexplode(F.array(*[F.lit(n) for n in (0, 7, 14, 30)])).alias("pos", "shift"))
    return _shape(
        offers, RAW_TABLES["product_country_availability"],
        "concat('P', p_partkey) as sku_code", "concat('N', lpad((p_partkey + shift) % 30, 2, '0')) as country_code",
        "date_add(date'2016-01-01', pos) as local_launch_date",
        "if(pos = 2 and p_size > 40, date'2015-12-31', null) as local_discontinue_date",
        "if(pos = 1 and p_size < 5, 'N', 'Y') as is_available", *_ORIGIN, *_audit("part", "p_partkey * 4 + pos + 1"))


def store_master(spark, sf_dir):
    return _shape(
        read(spark, sf_dir, "supplier"), RAW_TABLES["store_master"],
        "concat('S', s_suppkey) as store_code", "s_name as store_name",
        "concat('N', lpad(s_nationkey, 2, '0')) as country_code", "concat('R', s_nationkey % 5) as region_code",
        "concat('T', lpad(s_nationkey, 2, '0')) as tax_jurisdiction_code",
        "case s_suppkey % 3 when 0 then 'MALL' when 1 then 'MINI' else 'FLG' end as format_code",
        "concat('City ', s_nationkey) as city", "if(s_suppkey % 2 = 0, 'ST', null) as state_code",
        "lpad(s_suppkey, 5, '0') as postal_code", "concat(s_suppkey, ' Main Street') as address_line1",
        "s_nationkey * 7 - 84 as latitude", "s_suppkey % 360 - 180 as longitude",
        "date_add(date'1990-01-01', cast(s_suppkey % 1500 as int)) as store_open_date",
        "cast(null as date) as store_close_date", "'ACTIVE' as lifecycle_status",
        "1000 + (s_suppkey * 37) % 20000 as floor_area_sqft", "floor(s_acctbal * 100) as annual_rent_usd",
        "'Y' as is_active", *_PERIOD, *_audit("supplier", "s_suppkey + 1"))


def customer_master(spark, sf_dir):
    return _shape(
        read(spark, sf_dir, "customer"), RAW_TABLES["customer_master"],
        "concat('CU', c_custkey) as customer_id", "concat('C', lpad(c_custkey, 12, '0')) as customer_number",
        "split_part(c_name, '#', 1) as first_name", "split_part(c_name, '#', 2) as last_name", "c_name as full_name",
        "if(c_custkey % 2 = 0, 'Female', 'Male') as gender",
        "date_add(date'1950-01-01', cast(c_custkey % 20000 as int)) as date_of_birth",
        "if(c_acctbal < 0, null, concat('c', c_custkey, '@shop.example')) as email",
        "concat('+', c_custkey) as phone_number", "concat(c_custkey, ' Side Street') as street_address",
        "concat('City ', c_nationkey) as city", "cast(null as string) as state_province",
        "lpad(c_nationkey, 5, '0') as postal_code", "concat('N', lpad(c_nationkey, 2, '0')) as country_code",
        "concat('NATION_', c_nationkey) as country_name",
        "case c_nationkey % 5 when 0 then 'EMEA' when 1 then 'AMER' when 2 then 'APAC' when 3 then 'EMEA' "
        "else 'GULF' end as region",
        "concat('Language ', c_nationkey % 5) as preferred_language", "c_mktsegment as customer_segment",
        "case when c_acctbal < 2500 then 'None' when c_acctbal < 5000 then 'Silver' when c_acctbal < 7500 then 'Gold' "
        "else 'Platinum' end as loyalty_tier",
        "date_add(date'1992-01-01', cast(c_custkey % 1000 as int)) as registration_date", "c_acctbal >= 0 as is_active",
        "'TEST' as source_system", "'WEB' as record_source", "date'1992-01-01' as created_at",
        "timestamp_ntz'2024-01-01 00:00:00' as updated_at", *_audit("customer", "c_custkey + 1"))


def sales_header(spark, sf_dir):
    gross = "cast(o_totalprice as decimal(12,2))"
    discount = f"cast({gross} * cast(0.05 as decimal(3,2)) as decimal(12,2))"
    tax = f"cast({gross} * cast(0.08 as decimal(3,2)) as decimal(12,2))"
    return _shape(
        read(spark, sf_dir, "orders"), RAW_TABLES["sales_header"],
        "concat('TX', o_orderkey) as transaction_id", "concat('T', lpad(o_orderkey, 12, '0')) as transaction_number",
        "cast(o_orderdate as date) as transaction_timestamp", "concat('CU', o_custkey) as customer_id",
        # customers and orders outnumber stores by 15 and 150, so every scale has matching stores
        "case when o_orderstatus = 'P' and o_orderpriority = '4-NOT SPECIFIED' then null "
        "when o_orderkey % 2 = 0 then concat('S', o_custkey div 15) "
        "else concat('S', o_orderkey div 150) end as store_id",
        "case o_orderstatus when 'F' then 'POS' when 'O' then 'WEB' else 'APP' end as channel_id",
        "o_orderpriority as payment_method",
        "case o_orderpriority when '3-MEDIUM' then 'EUR' when '4-NOT SPECIFIED' then 'JPY' when '5-LOW' then 'GBP' "
        "else 'USD' end as currency",
        f"{gross} as gross_amount", f"{discount} as total_discount", f"{tax} as total_tax",
        f"{gross} - {discount} + {tax} as net_total", "cast(o_orderdate as date) as created_at",
        *_audit("orders", "o_orderkey + 1", "o_orderdate"))


def sales_item(spark, sf_dir):
    price = "cast(l_extendedprice as decimal(12,2))"
    discount = f"cast({price} * cast(l_discount as decimal(4,2)) as decimal(12,2))"
    tax = f"cast({price} * cast(l_tax as decimal(4,2)) as decimal(12,2))"
    return _shape(
        read(spark, sf_dir, "lineitem"), RAW_TABLES["sales_item"],
        "concat(l_orderkey, '-', l_linenumber) as transaction_line_id", "concat('TX', l_orderkey) as transaction_id",
        "concat('P', l_partkey) as sku_code", "cast(l_quantity as bigint) as quantity", f"{price} as unit_price",
        f"{discount} as discount_amount", f"{tax} as tax_amount", f"{price} - {discount} + {tax} as line_total",
        "cast(l_shipdate as date) as created_at", *_audit("lineitem", "l_partkey", "l_shipdate"))


SOURCES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (region_master, currency_master, tax_master, country_master, product_category_master,
              product_family_master, product_model_master, product_sku_master, product_country_availability,
              store_master, customer_master, sales_header, sales_item)
}
