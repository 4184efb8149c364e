"""Dimensions with all their versions, built from every load instead of the newest one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.keys import versioned_key
from tallyhouse.operators.history import CURRENT, END, START, as_of, history, intersected, merged
from tallyhouse.operators.quality import FLAG, is_valid, rules_for
from tallyhouse.schemas import LOAD_TS, RAW_TABLES

# Raw table -> name of the key its versions are found by.
VERSION_KEYS = {"store_master": "store_dim_key", "customer_master": "customer_dim_key",
                "product_sku_master": "product_dim_key", "country_master": "country_dim_key"}


def versions(raw: DataFrame, table: str, skew_bytes: int | None = None) -> DataFrame:
    """One row per version of a master: reloads without a change do not count.

    Invalid versions stay in the line, flagged, so that a valid version still ends where
    an invalid one replaced it.
    """
    spec = RAW_TABLES[table]
    tracked = [c for c in spec.columns if c not in spec.keys]
    dated = history(raw, spec.keys, tracked, skew_bytes=skew_bytes)
    return dated.select(
        versioned_key(LOAD_TS, *spec.keys).alias(VERSION_KEYS[table]), *spec.columns,
        is_valid(rules_for(table)).alias(FLAG), START, END, CURRENT)


def _line(raw: DataFrame, table: str, columns: list[str], skew_bytes: int | None) -> DataFrame:
    """Valid versions of a master by the columns that a dimension takes from it."""
    spec = RAW_TABLES[table]
    judged = raw.withColumn(FLAG, is_valid(rules_for(table)))
    wanted = [c for c in columns if c not in spec.keys]
    dated = history(judged, spec.keys, [*wanted, FLAG], skew_bytes=skew_bytes).filter(FLAG)
    return dated.select(*spec.keys, *wanted, START, END)


def country_versions(
    country: DataFrame, region: DataFrame, currency: DataFrame, tax: DataFrame, skew_bytes: int | None = None
) -> DataFrame:
    """All versions of the country dimension: a change of its region, currency or tax starts a new one too.

    As in the dimension, a missing or invalid master leaves NULLs, and a time in which the
    country itself is invalid has no version. Versions without a change in the dimension's
    columns are one.
    """
    masters = [
        (region, "region_master", "region_code", ["region_name"]),
        (currency, "currency_master", "currency_code", ["currency_name", "currency_symbol"]),
        (tax, "tax_master", "tax_code", ["tax_type", "tax_rate", "tax_inclusive_flag"]),
    ]
    own = ["country_name", "primary_language", "timezone", "market_tier", "ecommerce_supported", "retail_store_supported"]
    out = _line(country, "country_master", ["country_code", *own, *[m[2] for m in masters]], skew_bytes)
    tracked = list(own)
    for raw, table, code, columns in masters:
        held = _line(raw, table, [code, *columns], skew_bytes).withColumnRenamed(code, f"{code}_ref").withColumn(code, F.col(f"{code}_ref"))
        out = intersected(out.withColumnRenamed(code, f"{code}_ref"), held, f"{code}_ref", [code, *columns], "left", skew_bytes).drop(f"{code}_ref")
        tracked += [code, *columns]
    dated = merged(out, ["country_code"], tracked, skew_bytes)
    return dated.select(versioned_key(START, "country_code").alias("country_dim_key"), "country_code", *tracked, START, END, CURRENT)


def product_versions(
    sku: DataFrame, model: DataFrame, family: DataFrame, category: DataFrame, skew_bytes: int | None = None
) -> DataFrame:
    """All versions of the product dimension: a change anywhere in the chain of an article starts a new one.

    An article has a version only while it and all of its model, family and category are valid.
    """
    categories = _line(category, "product_category_master", ["category_code", "category_name", "reporting_segment"], skew_bytes)
    families = _line(family, "product_family_master", ["family_code", "family_name", "launch_year", "category_code"], skew_bytes)
    models = _line(model, "product_model_master", ["model_code", "model_name", "launch_date", "discontinue_date", "lifecycle_status", "family_code"], skew_bytes)
    articles = _line(sku, "product_sku_master", ["sku_code", "variant", "price_tier", "global_launch_date", "is_active", "model_code"], skew_bytes)
    families = families.withColumnRenamed("launch_year", "family_launch_year")
    models = models.withColumnsRenamed({"launch_date": "model_launch_date", "discontinue_date": "model_discontinue_date"})
    articles = articles.withColumnsRenamed({"global_launch_date": "sku_launch_date", "is_active": "sku_is_active"})
    chain = ["category_code", "category_name", "reporting_segment"]
    families = intersected(families, categories, "category_code", chain[1:], "inner", skew_bytes)
    chain = ["family_name", "family_launch_year", *chain]
    models = intersected(models, families, "family_code", chain, "inner", skew_bytes)
    chain = ["model_name", "model_launch_date", "model_discontinue_date", "lifecycle_status", "family_code", *chain]
    articles = intersected(articles, models, "model_code", chain, "inner", skew_bytes)
    tracked = ["variant", "price_tier", "sku_launch_date", "sku_is_active", "model_code", *chain]
    dated = merged(articles, ["sku_code"], tracked, skew_bytes)
    return dated.select(versioned_key(START, "sku_code").alias("product_dim_key"), "sku_code", *tracked, START, END, CURRENT)


def sales_as_of(sales: DataFrame, dated: DataFrame, table: str, key: str, how: str = "inner") -> DataFrame:
    """Sales with the key of the version of a master that held at the end of the day of sale.

    ``key`` is the column of ``sales`` that holds the business key of the master.
    """
    spec, found = RAW_TABLES[table], VERSION_KEYS[table]
    held = dated.filter(FLAG).select(F.col(spec.keys[0]).alias(key), found, START, END)
    last_moment = F.expr("cast(date_add(transaction_timestamp, 1) as timestamp_ntz) - interval 1 microsecond")
    timed = sales.withColumn("__at", last_moment)
    return as_of(timed, held, key, "__at", [found], how).drop("__at")
