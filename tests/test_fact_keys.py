"""Keys of facts travel and are stored as what they are made of, and come back as they were."""

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.functions.keys import beyond, restored, versioned_key
from tallyhouse.plans import facts
from tallyhouse.sources.versions import VersionedTable

AT = dt.datetime(2024, 1, 1)


def test_any_key_comes_back(spark):
    rows = spark.createDataFrame(
        [(1, "c", AT, None), (2, "c", AT, "0a" * 32), (3, "c", AT, "made elsewhere"), (4, "c", AT, ""), (5, None, None, "0A" * 32)],
        "n int, code string, at timestamp_ntz, key string")
    made = versioned_key("at", "code")
    rows = rows.unionByName(rows.select(F.col("n") + 10, "code", "at", made.alias("key")).toDF("n", "code", "at", "key"))
    got = rows.withColumn("left", beyond("key", made)).withColumn("back", restored("left", made)).collect()
    assert all(r.back == r.key for r in got)
    assert {r.n for r in got if r.left is None} == {11, 12, 13, 14, 15}  # made keys leave nothing to send


def test_keys_of_the_own_row_are_made_on_reading(spark, tmp_path):
    """Two versions of one table: files hold no key, readers find it in its place and in changed parts too."""
    table = VersionedTable(spark, str(tmp_path / "t"), 2, {"id_key": versioned_key("at", "id")})
    rows = spark.createDataFrame([("a", AT, "2024-01"), ("b", AT, "2024-02"), (None, None, None)], "id string, at timestamp_ntz, month string")
    rows = rows.select("id", versioned_key("at", "id").alias("id_key"), "at", "month")
    first = table.write(rows, split="month")
    assert first.columns == rows.columns and sorted(first.collect(), key=str) == sorted(rows.collect(), key=str)
    assert "id_key" not in spark.read.parquet(str(tmp_path / "t" / "parts")).columns
    fresh = rows.filter("id = 'b'").withColumn("id", F.lit("c")).withColumn("id_key", versioned_key("at", "id"))
    second = table.write_parts(fresh, ["2024-02"])
    assert {r.id for r in second.collect()} == {"a", "c", None}
    assert second.filter(second.id_key.eqNullSafe(versioned_key("at", "id"))).count() == 3


def test_versions_that_hold_their_keys_stay_readable(spark, tmp_path):
    rows = spark.createDataFrame([("a", "a key of its own", "2024-01")], "id string, id_key string, month string")
    VersionedTable(spark, str(tmp_path / "t")).write(rows, split="month")
    again = VersionedTable(spark, str(tmp_path / "t"), 2, {"id_key": F.sha2("id", 256)})
    assert again.read().collect() == rows.collect()


def test_facts_take_keys_of_dimensions_as_they_are(spark):
    """Whether a key follows from code and load time or not, and also where it is missing."""
    at = F.lit(AT).cast("timestamp_ntz")
    header = spark.createDataFrame([("T1", "h" * 64, "c", None, "0A" * 32)], "transaction_id string, fact_sales_header_key string, customer_dim_key string, store_dim_key string, country_dim_key string")
    header = header.withColumns({"date_dim_key": F.lit("20240101"), "transaction_number": F.lit("N"), "transaction_timestamp": F.lit(AT.date()), "channel_id": F.lit("POS"), "currency": F.lit("EUR"), "__source_load_ts": at})
    product = spark.createDataFrame([("P1", "odd"), ("P2", None)], "sku_code string, product_dim_key string").withColumns({"is_current": F.lit(True), "__source_load_ts": at})
    product = product.unionByName(product.limit(1).withColumn("sku_code", F.lit("P3")).withColumn("product_dim_key", versioned_key("__source_load_ts", "sku_code")))
    lines = spark.createDataFrame([(f"L{n}", "T1", f"P{n}") for n in (1, 2, 3, 4)], "transaction_line_id string, transaction_id string, sku_code string")
    lines = lines.withColumns({c: F.lit(1) for c in ("quantity", "unit_price", "discount_amount", "tax_amount", "line_total")})
    lines = lines.withColumns({"is_valid_record": F.lit(True), "__bronze_load_ts": at})
    got = {r.transaction_line_id: r for r in facts.fact_sales_item(lines, header, product).collect()}
    want = product.filter("sku_code = 'P3'").first().product_dim_key
    assert {k: r.product_dim_key for k, r in got.items()} == {"L1": "odd", "L2": None, "L3": want}
    for r in got.values():
        assert (r.fact_sales_header_key, r.customer_dim_key, r.store_dim_key, r.country_dim_key, r.date_dim_key) == ("h" * 64, "c", None, "0A" * 32, "20240101")
