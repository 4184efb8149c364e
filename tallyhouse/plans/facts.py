"""Transaction and line facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.keys import beyond, date_key, packed, restored, unpacked, versioned_key
from tallyhouse.operators.lookup import lookup
from tallyhouse.plans.dimensions import SOURCE_TS
from tallyhouse.plans.silver import BRONZE_TS, valid

# Load times of the rows that gave a fact its keys: they travel instead of the hashes.
CUSTOMER_TS, STORE_TS, PRODUCT_TS, HEADER_TS = "__customer_load_ts", "__store_load_ts", "__product_load_ts", "__header_load_ts"


def derived_keys(table: str) -> dict[str, Column]:
    """Keys that follow from stored columns of a fact's row: they are made on reading."""
    return {
        "fact_sales_header": lambda: {"fact_sales_header_key": versioned_key(SOURCE_TS, "transaction_id")},
        "fact_sales_item": lambda: {"fact_sales_item_key": versioned_key(SOURCE_TS, "transaction_line_id")},
    }.get(table, dict)()


def _packed(df: DataFrame, *keys: str) -> DataFrame:
    """Hash keys as bytes, while joins shuffle the rows."""
    return df.withColumns({k: packed(k) for k in keys})


def _dimension(df: DataFrame, key: str, code: str, load_ts: str) -> DataFrame:
    """What a fact takes of a dimension: code, load time and what its key holds beside them."""
    return df.select(code, F.col(SOURCE_TS).alias(load_ts), beyond(key, versioned_key(SOURCE_TS, code)).alias(key))


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def stores_with_country(dim_store: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Keys of each current store and of the country it stands in."""
    return _stores_with_country(dim_store, dim_country).drop(SOURCE_TS)


def _stores_with_country(dim_store: DataFrame, dim_country: DataFrame) -> DataFrame:
    countries = current(dim_country).select("country_code", "country_dim_key")
    stores = current(dim_store).select(F.col("store_code").alias("store_id"), "store_dim_key", "country_code", SOURCE_TS)
    return lookup(stores, countries, "country_code").select("store_id", "store_dim_key", "country_dim_key", SOURCE_TS)


def fact_sales_header(
    sales_header: DataFrame,
    dim_customer: DataFrame,
    dim_store: DataFrame,
    dim_country: DataFrame,
    dim_date: DataFrame | None = None,
) -> DataFrame:
    """One row per valid transaction whose customer, store, country and day are known.

    The country is the store's, not the customer's. Store and country are joined first,
    so the sales meet one small table instead of two. ``dim_date`` holds exactly the
    days of the valid sales; where it is not given its key is computed from the day.
    """
    return finished_header(header_rows(sales_header, dim_customer, dim_store, dim_country, dim_date))


def header_rows(
    sales_header: DataFrame,
    dim_customer: DataFrame,
    dim_store: DataFrame,
    dim_country: DataFrame,
    dim_date: DataFrame | None = None,
) -> DataFrame:
    """Rows of the header fact with what their keys are made of."""
    sales = valid(sales_header).withColumn("date_key", F.col("transaction_timestamp").cast("date"))
    if dim_date is None:
        sales = sales.filter("date_key is not null").withColumn("date_dim_key", F.lit(None).cast("binary"))
    else:
        days = dim_date.select("date_key", beyond("date_dim_key", date_key("date_key")).alias("date_dim_key"))
        sales = lookup(sales, days, "date_key")
    places = _stores_with_country(dim_store, dim_country)
    stores = places.select(
        "store_id", F.col(SOURCE_TS).alias(STORE_TS), packed("country_dim_key").alias("country_dim_key"),
        beyond("store_dim_key", versioned_key(SOURCE_TS, "store_id")).alias("store_dim_key"))
    sales = lookup(sales, stores, "store_id")
    sales = lookup(sales, _dimension(current(dim_customer), "customer_dim_key", "customer_id", CUSTOMER_TS), "customer_id")
    return sales.select(
        "customer_id", CUSTOMER_TS, "customer_dim_key", "store_id", STORE_TS, "store_dim_key", "country_dim_key", "date_dim_key",
        "transaction_id", "transaction_number", F.col("date_key").alias("transaction_timestamp"), "channel_id",
        "payment_method", "currency", "gross_amount", "total_discount", "total_tax", "net_total",
        F.col(BRONZE_TS).alias(SOURCE_TS))


def finished_header(rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """The header fact from :func:`header_rows`, and ``more`` columns of theirs."""
    return rows.select(
        versioned_key(SOURCE_TS, "transaction_id").alias("fact_sales_header_key"),
        restored("customer_dim_key", versioned_key(CUSTOMER_TS, "customer_id")).alias("customer_dim_key"),
        restored("store_dim_key", versioned_key(STORE_TS, "store_id")).alias("store_dim_key"),
        unpacked("country_dim_key").alias("country_dim_key"),
        restored("date_dim_key", date_key("transaction_timestamp")).alias("date_dim_key"), "transaction_id", "transaction_number",
        "transaction_timestamp", "channel_id", "payment_method", "currency", "gross_amount",
        "total_discount", "total_tax", "net_total", F.lit(1).alias("transaction_count"), SOURCE_TS, *more)


INHERITED_KEYS = ["customer_dim_key", "store_dim_key", "country_dim_key"]
INHERITED = [*INHERITED_KEYS, "transaction_number", "transaction_timestamp", "channel_id", "currency"]


def fact_sales_item(sales_item: DataFrame, header: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row per valid line whose transaction is in the header fact and whose article is known."""
    return finished_item(item_rows(sales_item, header, dim_product))


def item_rows(sales_item: DataFrame, header: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Rows of the line fact with what their keys are made of."""
    articles = _dimension(current(dim_product), "product_dim_key", "sku_code", PRODUCT_TS)
    lines = lookup(valid(sales_item), articles, "sku_code")
    sales = _packed(header.select(
        "transaction_id", *INHERITED, F.col(SOURCE_TS).alias(HEADER_TS),
        beyond("fact_sales_header_key", versioned_key(SOURCE_TS, "transaction_id")).alias("fact_sales_header_key"),
        beyond("date_dim_key", date_key("transaction_timestamp")).alias("date_dim_key")), *INHERITED_KEYS)
    lines = lookup(lines, sales, "transaction_id")
    return lines.select(
        "transaction_id", HEADER_TS, "fact_sales_header_key", "sku_code", PRODUCT_TS, "product_dim_key", "date_dim_key", *INHERITED,
        "transaction_line_id", "quantity", "unit_price", "discount_amount", "tax_amount", "line_total",
        F.col(BRONZE_TS).alias(SOURCE_TS))


def finished_item(rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """The line fact from :func:`item_rows`, and ``more`` columns of theirs."""
    return rows.select(
        versioned_key(SOURCE_TS, "transaction_line_id").alias("fact_sales_item_key"),
        restored("fact_sales_header_key", versioned_key(HEADER_TS, "transaction_id")).alias("fact_sales_header_key"),
        unpacked("customer_dim_key").alias("customer_dim_key"),
        restored("product_dim_key", versioned_key(PRODUCT_TS, "sku_code")).alias("product_dim_key"),
        unpacked("store_dim_key").alias("store_dim_key"), unpacked("country_dim_key").alias("country_dim_key"),
        restored("date_dim_key", date_key("transaction_timestamp")).alias("date_dim_key"),
        "transaction_line_id", "transaction_id", "transaction_number", "transaction_timestamp", "channel_id",
        "currency", "quantity", "unit_price", "discount_amount", "tax_amount", "line_total",
        F.lit(1).alias("line_count"), SOURCE_TS, *more)


# Facts that are shuffled once more when they are stored: their rows before that, and what makes the keys behind it.
TRAVELLING = {"fact_sales_header": (header_rows, finished_header), "fact_sales_item": (item_rows, finished_item)}
