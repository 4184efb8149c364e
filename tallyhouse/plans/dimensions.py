"""Gold dimensions and the product-country bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import calendar
from tallyhouse.functions.keys import date_key, versioned_key
from tallyhouse.operators.history import only_version
from tallyhouse.operators.lookup import lookup
from tallyhouse.plans.silver import BRONZE_TS, valid

SOURCE_TS = "__source_load_ts"


def _tail() -> list:
    return [*only_version(BRONZE_TS), F.col(BRONZE_TS).alias(SOURCE_TS)]


def dim_country(country: DataFrame, region: DataFrame, currency: DataFrame, tax: DataFrame) -> DataFrame:
    """Country with its region, currency and tax; a missing or invalid master leaves NULLs.

    The masters are filtered before the outer joins, so an invalid master never removes
    a country. Their codes are taken from the master, not from the country.
    """

    def master(df: DataFrame, code: str, *columns: str) -> DataFrame:
        return valid(df).select(F.col(code).alias(f"{code}_ref"), code, *columns)

    masters = [
        (region, "region_code", ["region_name"]),
        (currency, "currency_code", ["currency_name", "currency_symbol"]),
        (tax, "tax_code", ["tax_type", "tax_rate", "tax_inclusive_flag"]),
    ]
    out = valid(country)
    for df, code, columns in masters:
        out = lookup(out.withColumnRenamed(code, f"{code}_ref"), master(df, code, *columns), f"{code}_ref", "left")
    return out.select(
        versioned_key(BRONZE_TS, "country_code").alias("country_dim_key"),
        "country_code", "country_name", "primary_language", "timezone", "market_tier", "ecommerce_supported",
        "retail_store_supported", "region_code", "region_name", "currency_code", "currency_name", "currency_symbol",
        "tax_code", "tax_type", "tax_rate", "tax_inclusive_flag", *_tail())


def dim_product(sku: DataFrame, model: DataFrame, family: DataFrame, category: DataFrame) -> DataFrame:
    """Article with model, family and category; an article without a full chain is left out."""
    categories = valid(category).select("category_code", "category_name", "reporting_segment")
    families = valid(family).select(
        "family_code", "family_name", F.col("launch_year").alias("family_launch_year"), "category_code")
    models = valid(model).select(
        "model_code", "model_name", F.col("launch_date").alias("model_launch_date"),
        F.col("discontinue_date").alias("model_discontinue_date"), "lifecycle_status", "family_code")
    articles = valid(sku).select(
        versioned_key(BRONZE_TS, "sku_code").alias("product_dim_key"), "sku_code", "variant", "price_tier",
        F.col("global_launch_date").alias("sku_launch_date"), F.col("is_active").alias("sku_is_active"),
        "model_code", BRONZE_TS)
    chain = lookup(models, lookup(families, categories, "category_code"), "family_code")
    return lookup(articles, chain, "model_code").select(
        "product_dim_key", "sku_code", "variant", "price_tier", "sku_launch_date", "sku_is_active", "model_code",
        "model_name", "model_launch_date", "model_discontinue_date", "lifecycle_status", "family_code", "family_name",
        "family_launch_year", "category_code", "category_name", "reporting_segment", *_tail())


def bridge_product_country(availability: DataFrame, sku: DataFrame, country: DataFrame) -> DataFrame:
    """Article and country pairs; both dimension keys are recomputed, not looked up.

    The product key needs a valid article only, so it can name an article that the
    product dimension leaves out.
    """
    articles = valid(sku).select("sku_code", versioned_key(BRONZE_TS, "sku_code").alias("product_dim_key"))
    countries = valid(country).select("country_code", versioned_key(BRONZE_TS, "country_code").alias("country_dim_key"))
    pairs = valid(availability).select(
        versioned_key(BRONZE_TS, "sku_code", "country_code").alias("bridge_key"), "sku_code", "country_code",
        "local_launch_date", "local_discontinue_date", "is_available", F.col(BRONZE_TS).alias(SOURCE_TS))
    return lookup(lookup(pairs, countries, "country_code"), articles, "sku_code").select(
        "bridge_key", "product_dim_key", "country_dim_key", "sku_code", "country_code", "local_launch_date",
        "local_discontinue_date", "is_available", SOURCE_TS)


def dim_store(store: DataFrame) -> DataFrame:
    return valid(store).select(
        versioned_key(BRONZE_TS, "store_code").alias("store_dim_key"), "store_code", "store_name", "format_code",
        "lifecycle_status", "country_code", "region_code", "state_code", "city", "postal_code", "address_line1",
        "latitude", "longitude", "tax_jurisdiction_code", "floor_area_sqft", "annual_rent_usd", "store_open_date",
        "store_close_date", "is_active", *_tail())


def dim_customer(customer: DataFrame) -> DataFrame:
    return valid(customer).select(
        versioned_key(BRONZE_TS, "customer_id").alias("customer_dim_key"), "customer_id", "customer_number",
        "first_name", "last_name", "full_name", "gender", "date_of_birth", "email", "phone_number", "street_address",
        "city", "state_province", "postal_code", "country_code", "country_name", "region", "preferred_language",
        "customer_segment", "loyalty_tier", "registration_date", "is_active", "source_system", "record_source",
        *_tail())


def dim_date(sales_header: DataFrame) -> DataFrame:
    """Days with valid sales. The days are made distinct first; all columns follow from them."""
    days = valid(sales_header).select(F.col("transaction_timestamp").cast("date").alias("date_key")).distinct()
    return days.select(date_key("date_key").alias("date_dim_key"), "date_key",
                       *[c.alias(n) for n, c in calendar("date_key").items()])
