"""Times the headline queries on the test tables and prints one JSON line.

``build_gold`` is the whole batch job, raw tables to gold tables on disk. The questions,
metrics and reports then read those tables, as they do in use. Every result is computed
in full and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "win_01_keep_latest", "win_01_keep_latest_event", "slv_12_sales_header", "slv_13_sales_item",
    "dim_02_product", "dim_04_customer", "dim_05_date", "brg_01_product_country", "fct_01_sales_header",
    "fct_02_sales_item", "jn_13_item_header", "agf_01_daily", "agf_02_weekly", "agf_03_monthly",
    "vq_01_total_sales_by_region", "vq_02_top_10_products", "vq_03_monthly_sales_trend", "vq_04_sales_by_loyalty_tier",
    "vq_05_top_stores", "vq_06_sales_by_category", "vq_07_sales_by_channel", "vq_08_quarterly_sales",
    "sem_10_two_facts", "cst_04_report", "ext_01_history", "ext_02_point_in_time", "ext_03_month_over_month",
    "ext_04_dropped_rows", "load_12_sales_header", "inc_01_keep_latest_stream",
]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from checks.spark_queries import QUERIES, Data
    from tallyhouse.plans.warehouse import GOLD
    from tallyhouse.runtime import session

    spark = session("bench", cpus=CPUS, partitions=int(CPUS) if CPUS.isdigit() else None)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{SF_DIR}/region.parquet").count()  # start-up is not measured

    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    house = Data(spark, SF_DIR).warehouse
    timed("build_gold", lambda: house.build(*GOLD))
    for name in HEADLINE:
        timed(name, lambda name=name: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf") or 0),
    }))


if __name__ == "__main__":
    main()
