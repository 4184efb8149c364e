"""Masters that are loaded several times with changes, and the versions of joined dimensions in SQL.

The SQL shares nothing with the library: it joins the masters as they stood at each moment of
a load, one snapshot a moment, and puts equal neighbouring snapshots together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.oracle import FLAWS, KEYS, columns, key, sql
from tallyhouse.schemas import LOAD_TS

# Table -> later loads: the moment, which rows, and their new values. The expressions mean the same to both engines.
EDITS: dict[str, list[tuple[str, str, dict[str, str]]]] = {
    "product_category_master": [
        ("2024-02-01 00:00:00", "ascii(right(category_code, 1)) % 2 = 0", {"category_name": "concat(category_name, ' new')"}),
        ("2024-04-01 00:00:00", "ascii(right(category_code, 1)) % 3 = 0", {"is_active": "'X'"}),
        ("2024-05-01 00:00:00", "ascii(right(category_code, 1)) % 3 = 0", {"is_active": "'Y'"})],
    "product_family_master": [
        ("2024-02-01 00:00:00", "true", {"is_active": "'N'"}),
        ("2024-03-01 00:00:00", "ascii(right(family_code, 1)) % 2 = 1", {"launch_year": "launch_year + 1"})],
    "product_model_master": [
        ("2024-02-15 00:00:00", "ascii(right(model_code, 1)) % 2 = 0", {"lifecycle_status": "concat(lifecycle_status, '!')"}),
        ("2024-03-01 00:00:00", "ascii(right(model_code, 1)) % 5 = 0", {"model_name": "''"}),
        ("2024-03-20 00:00:00", "ascii(right(model_code, 1)) % 5 = 0", {"model_name": "concat(model_name, '#')"})],
    "product_sku_master": [
        ("2024-01-20 00:00:00", "ascii(right(sku_code, 1)) % 2 = 0", {"price_tier": "concat(price_tier, '+')"}),
        ("2024-03-01 00:00:00", "ascii(right(sku_code, 1)) % 7 = 1", {"variant": "' '"}),
        ("2024-04-01 00:00:00", "ascii(right(sku_code, 1)) % 7 = 1", {"variant": "'back'"})],
    "country_master": [
        ("2024-02-10 00:00:00", "ascii(right(country_code, 1)) % 2 = 0", {"timezone": "concat(timezone, 'x')"}),
        ("2024-03-01 00:00:00", "ascii(right(country_code, 1)) % 4 = 0", {"country_name": "''"}),
        ("2024-03-15 00:00:00", "ascii(right(country_code, 1)) % 4 = 0", {"market_tier": "'T9'"})],
    "region_master": [
        ("2024-02-10 00:00:00", "ascii(right(region_code, 1)) % 2 = 1", {"region_name": "concat(region_name, ' II')"}),
        ("2024-02-20 00:00:00", "ascii(right(region_code, 1)) % 3 = 0", {"is_active": "'X'"})],
    "currency_master": [
        ("2024-02-20 00:00:00", "true", {"minor_unit": "minor_unit + 1"}),
        ("2024-05-05 00:00:00", "true", {"currency_symbol": "'*'"})],
    "tax_master": [("2024-01-15 00:00:00", "true", {"tax_type": "'SALES'"})],
}


def loaded(first: DataFrame, name: str) -> DataFrame:
    """A master with its first load and all later ones."""
    kinds = {f.name: f.dataType for f in first.schema.fields}
    out = first
    for day, where, values in EDITS[name]:
        changed = {c: F.expr(e).cast(kinds[c]) for c, e in values.items()}
        out = out.unionByName(first.filter(where).withColumns(changed | {LOAD_TS: F.lit(day).cast("timestamp_ntz")}))
    return out


def _loads(name: str) -> str:
    later = [f"SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in values.items())}, TIMESTAMP '{day}' AS __load_ts) FROM b_{name} WHERE {where}"
             for day, where, values in EDITS[name]]
    return " UNION ALL ".join([f"SELECT * FROM b_{name}", *later])


def _snapshots(name: str) -> str:
    bad = " OR ".join(f"coalesce({condition}, false)" for condition, _ in FLAWS[name])
    return f"""{name} AS (SELECT * FROM (
        SELECT times.k, l.*, row_number() OVER (PARTITION BY times.k, {KEYS[name]} ORDER BY __load_ts DESC, __row_number DESC) AS newest
        FROM times JOIN ({_loads(name)}) l ON l.__load_ts <= times.t) WHERE newest = 1 AND NOT ({bad}))"""


def _versions(names: list[str], business_key: str, dim_key: str, state: str, joined: str, shown: str) -> str:
    moments = " UNION ".join(f"SELECT __load_ts FROM ({_loads(n)})" for n in names)
    cells = [item.partition(" AS ")[2] or item.rpartition(".")[2] for item in state.split(", ")]
    return sql(f"""SELECT {columns(shown)} FROM (
        WITH times AS (SELECT __load_ts AS t, row_number() OVER (ORDER BY __load_ts) AS k FROM ({moments})),
        {", ".join(_snapshots(n) for n in names)},
        seen AS (SELECT {names[0]}.{business_key}, {state}, {names[0]}.k FROM {joined}),
        marked AS (SELECT *, lag(k) OVER w IS NOT DISTINCT FROM k - 1 AND lag(row({", ".join(cells)})) OVER w IS NOT DISTINCT FROM row({", ".join(cells)}) AS same
                   FROM seen WINDOW w AS (PARTITION BY {business_key} ORDER BY k)),
        runs AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY {business_key} ORDER BY k) AS run FROM marked),
        spans AS (SELECT {business_key}, {", ".join(f"first({c} ORDER BY k) AS {c}" for c in cells)}, min(k) AS a, max(k) AS z FROM runs GROUP BY {business_key}, run),
        dated AS (SELECT spans.*, s.t AS effective_start_ts, coalesce(e.t, TIMESTAMP '9999-12-31 23:59:59') AS effective_end_ts
                  FROM spans JOIN times s ON s.k = a LEFT JOIN times e ON e.k = z + 1)
        SELECT *, effective_end_ts = TIMESTAMP '9999-12-31 23:59:59' AS is_current, {key(business_key, ts='effective_start_ts')} AS {dim_key} FROM dated)""")


PRODUCT_COLUMNS = ("product_dim_key sku_code variant price_tier sku_launch_date:d sku_is_active model_code model_name model_launch_date:d "
                   "model_discontinue_date:d lifecycle_status family_code family_name family_launch_year:i category_code category_name "
                   "reporting_segment effective_start_ts:t effective_end_ts:t is_current")
PRODUCT_VERSIONS = _versions(
    ["product_sku_master", "product_model_master", "product_family_master", "product_category_master"], "sku_code", "product_dim_key",
    "product_sku_master.variant, product_sku_master.price_tier, product_sku_master.global_launch_date AS sku_launch_date, product_sku_master.is_active AS sku_is_active, "
    "product_sku_master.model_code, product_model_master.model_name, product_model_master.launch_date AS model_launch_date, "
    "product_model_master.discontinue_date AS model_discontinue_date, product_model_master.lifecycle_status, product_model_master.family_code, "
    "product_family_master.family_name, product_family_master.launch_year AS family_launch_year, product_family_master.category_code, "
    "product_category_master.category_name, product_category_master.reporting_segment",
    "product_sku_master JOIN product_model_master USING (k, model_code) JOIN product_family_master USING (k, family_code) "
    "JOIN product_category_master USING (k, category_code)", PRODUCT_COLUMNS)

COUNTRY_COLUMNS = ("country_dim_key country_code country_name primary_language timezone market_tier ecommerce_supported retail_store_supported region_code "
                   "region_name currency_code currency_name currency_symbol tax_code tax_type tax_rate:n tax_inclusive_flag "
                   "effective_start_ts:t effective_end_ts:t is_current")
COUNTRY_VERSIONS = _versions(
    ["country_master", "region_master", "currency_master", "tax_master"], "country_code", "country_dim_key",
    "country_master.country_name, country_master.primary_language, country_master.timezone, country_master.market_tier, "
    "country_master.ecommerce_supported, country_master.retail_store_supported, region_master.region_code, region_master.region_name, "
    "currency_master.currency_code, currency_master.currency_name, currency_master.currency_symbol, tax_master.tax_code, tax_master.tax_type, "
    "tax_master.tax_rate, tax_master.tax_inclusive_flag",
    "country_master LEFT JOIN region_master ON region_master.k = country_master.k AND region_master.region_code = country_master.region_code "
    "LEFT JOIN currency_master ON currency_master.k = country_master.k AND currency_master.currency_code = country_master.currency_code "
    "LEFT JOIN tax_master ON tax_master.k = country_master.k AND tax_master.tax_code = country_master.tax_code", COUNTRY_COLUMNS)
