"""The plans that should stay the way they are."""

import pytest
from pyspark.sql import functions as F

from checks import spark_queries
from checks.spark_queries import Data
from tallyhouse.operators import integrity
from tallyhouse.plans import facts, summaries

SF = "/root/testdata/sf0.001"
LAZY = [n for n in spark_queries.QUERIES if n[:3] in ("prj", "flt", "dq_", "agg", "win", "srt", "fn_", "slv", "key", "scd",
                                                      "brg") or n.startswith("dim_")]
STORED = ("flt_11", "agg_07", "agg_08")


@pytest.mark.parametrize("name", [n for n in LAZY if not n.startswith(STORED)])
def test_no_python_and_no_products(spark, plan, name):
    text = plan(spark_queries.QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoop", "EvalPython", "MapInPandas", "FlatMapGroups", "RDDScan"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark, plan):
    orders = Data(spark, SF).source("orders").filter("o_totalprice > 400000").select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,400000.0)]" in plan(orders)
    text = plan(Data(spark, SF).raw("sales_header").groupBy("channel_id").agg(F.sum("gross_amount")))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text


def test_header_fact_shuffles_the_sales_only_to_keep_the_newest(spark, plan):
    text = plan(spark_queries.QUERIES["fct_01_sales_header"](spark, SF))
    assert text.count("Exchange hashpartitioning(transaction_id") == 1
    assert "Exchange hashpartitioning(customer_id#" not in text.split("BroadcastExchange")[0]


def test_daily_summary_joins_after_grouping(house, plan):
    t = house.tables("fact_sales_header", "dim_date", "dim_store", "dim_country")
    text = plan(summaries.fact_sales_daily(*t.values()))
    assert text.index("BroadcastHashJoin") < text.index("HashAggregate")  # printed top down: joins on top of the groups
    scan = next(line for line in text.splitlines() if "FileScan" in line and "net_total" in line)
    assert "transaction_number" not in scan and "payment_method" not in scan


def test_longer_summaries_repeat_no_row_for_distinct_counts(house, plan):
    t = house.tables("fact_sales_header", "dim_date", "dim_country")
    for build in (summaries.fact_sales_weekly, summaries.fact_sales_monthly):
        text = plan(build(*t.values()))
        assert "Expand" not in text and "distinct" not in text


def test_facts_without_broadcasts(spark, house, monkeypatch):
    want = {n: house.table(n).drop("sales_month") for n in ("fact_sales_header", "fact_sales_item")}
    needs = house.tables("silver_sales_header", "dim_customer", "dim_store", "dim_country", "silver_sales_item", "dim_product")
    monkeypatch.setattr("tallyhouse.runtime.BROADCAST_BYTES", 0)
    header = facts.fact_sales_header(*list(needs.values())[:4])
    assert sorted(header.collect()) == sorted(want["fact_sales_header"].collect())
    item = facts.fact_sales_item(needs["silver_sales_item"], want["fact_sales_header"], needs["dim_product"])
    assert sorted(item.collect()) == sorted(want["fact_sales_item"].collect())


def test_current_versions_are_filtered_before_the_join(spark, plan):
    df = facts.current(spark.createDataFrame([("a", True)], "k string, is_current boolean"))
    assert "Filter" in plan(df)


def test_checks_of_keys_send_bytes_not_text(spark, plan):
    """Hash keys cross the shuffles of key checks as 32 bytes; other text in such a column stays what it was."""
    texts = ["0a" * 32, "0A" * 32, "zz", "", None, "0a" * 32]
    child = spark.createDataFrame([(t,) for t in texts], "a_key string")
    parent = spark.createDataFrame([("zz",), (None,)], "a_key string")
    lost, broken = integrity.orphans(child, parent, "a_key", "a_key"), integrity.key_violations(child, ["a_key"])
    assert {tuple(r) for r in lost.collect()} == {("0a" * 32, 2), ("0A" * 32, 1), ("", 1)}
    assert tuple(broken.first()) == (1, 1, 1)
    assert "unhex" in plan(lost) and "unhex" in plan(broken)
