from datetime import datetime

from pyspark.sql import functions as F

from tallyhouse.operators.latest import keep_latest
from tallyhouse.plans.silver import silver, valid
from tallyhouse.schemas import LOAD_TS, ROW_NUMBER

D1, D2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def region(code, name="North", load=D1, row=1, **more):
    return {"region_code": code, "region_name": name, "is_active": "Y", "effective_start_date": datetime(2000, 1, 1).date(),
            "__load_ts": load, "__row_number": row, "__file_name": "f", **more}


def test_newest_load_then_highest_row_number(raw):
    df = raw("region_master", region("A", "old"), region("A", "new", D2), region("B", "one", row=1),
             region("B", "two", row=2))
    got = {r.region_code: r.region_name for r in keep_latest(df, ["region_code"]).collect()}
    assert got == {"A": "new", "B": "two"}


def test_missing_load_time_counts_as_newest_and_null_keys_form_a_group(raw):
    df = raw("region_master", region("A", "dated", D2), region("A", "undated", None), region(None, "x"),
             region(None, "y", D2))
    got = {r.region_code: r.region_name for r in keep_latest(df, ["region_code"]).collect()}
    assert got == {"A": "undated", None: "y"}


def test_invalid_newest_row_hides_a_valid_older_one(raw):
    df = silver(raw("region_master", region("A"), region("A", "  ", D2)), "region_master")
    assert [r.is_valid_record for r in df.collect()] == [False]
    assert valid(df).count() == 0


def test_composite_key(raw):
    def row(sku, country, number):
        return {"sku_code": sku, "country_code": country, "is_available": "Y", "__load_ts": D1, "__row_number": number}

    df = silver(raw("product_country_availability", row("s", "US", 1), row("s", "JP", 2), row("s", "US", 3)),
                "product_country_availability")
    assert sorted((r.country_code, r["__source_row_number"]) for r in df.collect()) == [("JP", 2), ("US", 3)]


def test_keeping_twice_changes_nothing(raw):
    df = raw("region_master", *[region(f"R{i % 3}", f"n{i}", D1, i) for i in range(20)])
    once = keep_latest(df, ["region_code"])
    assert sorted(once.collect()) == sorted(keep_latest(once, ["region_code"]).collect())


def test_map_side_limit_comes_before_the_shuffle(spark, plan):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("__load_ts"), F.col("id").alias("__row_number"))
    text = plan(keep_latest(df, ["k"], [LOAD_TS, ROW_NUMBER]))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_equal_numbers_of_two_files_are_settled_by_the_file_name(raw):
    rows = [region("A", name, __file_name=file) for name, file in (("x", "a.csv"), ("z", "c.csv"), ("y", "b.csv"))]
    for turned in (rows, rows[::-1]):
        assert [r.region_name for r in keep_latest(raw("region_master", *turned), ["region_code"]).collect()] == ["z"]
