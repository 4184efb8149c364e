import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import calendar as cal
from tallyhouse.functions.keys import date_key, grouped, micros_text, packed, unpacked, versioned_key


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_versioned_key(spark, local):
    rows = [("A", "BC", datetime(2024, 1, 2, 3, 4, 5)), ("AB", "C", datetime(2024, 1, 2, 3, 4, 5)),
            ("A", None, datetime(2024, 1, 2, 3, 4, 5, 250000)), (None, None, None)]
    df = local(rows, "a string, b string, ts timestamp_ntz")
    got = [r[0] for r in df.select(versioned_key("ts", "a", "b")).collect()]
    assert got == [sha("ABC2024-01-02 03:04:05.000000"), sha("ABC2024-01-02 03:04:05.000000"),
                   sha("A2024-01-02 03:04:05.250000"), sha("")]


def test_keys_travel_as_half_their_bytes_and_come_back(local):
    texts = [sha("a"), sha("b").upper(), "", None, "p1", "é", sha("a")[:-1] + "\n", "0" * 63, "g" * 64, "\0" * 32, "x" * 32, "1" * 128]
    df = local([(i, t) for i, t in enumerate(texts)], "i long, a_key string")
    back = df.select("i", packed("a_key").alias("p")).select("i", F.length("p").alias("n"), unpacked("p").alias("t")).collect()
    assert [r.t for r in sorted(back)] == texts
    assert [r.i for r in back if r.n == 32] == [0]
    rows = grouped(df.unionByName(df), ["a_key"], F.count(F.lit(1)).alias("n")).collect()
    assert {(r.a_key, r.n) for r in rows} == {(t, 2) for t in texts}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_text_ignores_the_session_zone(spark, local, zone):
    # 02:30 does not exist in New York on that night
    df = local([(datetime(2024, 3, 10, 2, 30, 0, 1),)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert df.select(micros_text("ts")).first()[0] == "2024-03-10 02:30:00.000001"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar(spark, local):
    days = [date(2024, 3, 31), date(2024, 4, 1), date(2024, 12, 30), date(2025, 1, 1), date(2024, 6, 1), date(2024, 5, 31)]
    df = local([(d,) for d in days], "d date")
    columns = cal.calendar("d")
    got = {r.d: r for r in df.select("d", *[c.alias(n) for n, c in columns.items()], date_key("d").alias("k"),
                                     cal.iso_year(F.col("d")).alias("iso")).collect()}
    march, april, december, january, saturday, may = [got[d] for d in days]
    assert (march.fiscal_year, march.fiscal_quarter, march.day_of_week, march.is_weekend) == (2023, 4, 0, True)
    assert (april.fiscal_year, april.fiscal_quarter, april.quarter_name) == (2024, 1, "Q2")
    assert (december.year_number, december.week_number, december.iso) == (2024, 1, 2025)
    assert (january.fiscal_year, january.fiscal_quarter, january.week_number, january.iso) == (2024, 4, 1, 2025)
    assert (saturday.day_of_week, saturday.is_weekend, saturday.day_name, saturday.month_name) == (6, True, "Sat", "June")
    assert (may.fiscal_year, may.fiscal_quarter, may.month_short_name, may.year_quarter) == (2024, 1, "May", "2024-Q2")
    assert march.k == sha("20240331") and march.is_holiday is False
    assert (march.year_name, march.year_month, march.day_of_year, march.day_of_month) == ("2024", "2024-03", 91, 31)
