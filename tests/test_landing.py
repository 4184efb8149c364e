from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.schemas import COUNTRY, CUSTOMER, FILE_NAME, LOAD_TS, REGION, ROW_NUMBER, SALES_HEADER
from tallyhouse.sources import landing, tables

NOW = datetime(2024, 5, 6, 7, 8, 9)
HEADER = "a,b,c,d,e,f,g\n"  # names in the file do not matter, positions do


def rows_at(spark, spec, path):
    return tables.read(spark, path, spec.schema)


def test_quotes_empty_fields_and_audit_columns(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "one.csv").write_text(
        HEADER + 'R1,"North, ""far""",Y,2011-03-07,9998-10-30,2019-08-14 03:04:05.060708,TEST\n'
        "R2,,N,2011-03-07,,2019-08-14 03:04:05,TEST\n", encoding="utf-8")
    (folder / "two.csv").write_text(HEADER + "R3,Süd,Y,2000-01-01,,,MDM\n", encoding="utf-8")
    target = str(tmp_path / "raw")
    landing.load(spark, REGION, str(folder), target, NOW, root=str(tmp_path))
    got = rows_at(spark, REGION, target).orderBy("region_code").collect()
    assert [r.region_name for r in got] == ['North, "far"', None, "Süd"]
    assert got[0].created_at == datetime(2019, 8, 14, 3, 4, 5, 60708) and got[2].created_at is None
    assert got[1].effective_start_date == date(2011, 3, 7) and got[1].effective_end_date is None
    assert [(r[FILE_NAME], r[ROW_NUMBER], r[LOAD_TS]) for r in got] == [
        ("landing/one.csv", 1, NOW), ("landing/one.csv", 2, NOW), ("landing/two.csv", 1, NOW)]


def test_trailing_columns_are_skipped(spark, tmp_path):
    line = "Q7,Quill Islands,SOUTH,QLD,Q7_ZERO,Quillish,Pacific/Quill,N,Y,Tier9"
    (tmp_path / "c.csv").write_text("h\n" + line + ",31,4001,N,2011-03-07,9998-10-30,2019-08-14 03:04:05,TEST\n")
    got = landing.read_by_position(spark, COUNTRY, str(tmp_path / "c.csv")).first()
    assert [got[c] for c in COUNTRY.columns] == line.split(",")


def test_a_bad_value_stops_the_load(spark, tmp_path):
    (tmp_path / "r.csv").write_text(HEADER + "R1,North,Y,no date,,,MDM\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        landing.read_by_position(spark, REGION, str(tmp_path / "r.csv")).collect()


def test_day_with_time_and_spelled_out_booleans(spark, tmp_path):
    line = ["C1"] + [""] * 24
    for word, n in (("TRUE", 1), ("0", 2), ("y", 3)):
        line[0], line[20], line[23] = f"C{n}", word, "2024-01-02"
        with open(tmp_path / "c.csv", "a") as out:
            out.write(("h\n" if n == 1 else "") + ",".join(line) + "\n")
    got = landing.read_by_position(spark, CUSTOMER, str(tmp_path / "c.csv")).orderBy("customer_id").collect()
    assert [r.is_active for r in got] == [True, False, True]
    sale = "T1,1,2024-03-04 10:11:12,C1,S1,POS,CARD,USD,10.50,0,1.05,11.55,2024-03-04"
    (tmp_path / "s.csv").write_text("h\n" + sale + "\n")
    assert landing.read_by_position(spark, SALES_HEADER, str(tmp_path / "s.csv")).first().transaction_timestamp == date(2024, 3, 4)


def test_row_numbers_across_splits_of_one_file(spark, tmp_path):
    lines = [f"R{i:05d},Name {i},Y,2000-01-01,,,MDM" for i in range(20_000)]
    (tmp_path / "big.csv").write_text(HEADER + "\n".join(lines) + "\n")
    (tmp_path / "small.csv").write_text(HEADER + "S,Name,Y,2000-01-01,,,MDM\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows = landing.read_by_position(spark, REGION, str(tmp_path))
        assert rows.select(landing.BLOCK).distinct().count() > 5
        got = landing.number_rows(rows, REGION, NOW)
        wrong = got.filter(F.col(FILE_NAME).endswith("big.csv")).filter(
            F.substring("region_code", 2, 5).cast("long") + 1 != F.col(ROW_NUMBER))
        assert got.count() == 20_001 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("name", ["a b", "50%", "x+y", "Süd %20"])
def test_file_names_are_kept_as_they_are(spark, tmp_path, name):
    root = tmp_path / f"land {name}"
    (root / name).mkdir(parents=True)
    (root / name / f"{name}.csv").write_text(HEADER + "R1,North,Y,2011-03-07,,,TEST\n")
    target = str(tmp_path / "raw")
    landing.load(spark, REGION, f"{root}/*/*.csv", target, root=str(root))
    assert rows_at(spark, REGION, target).first()[FILE_NAME] == f"{name}/{name}.csv"


def test_a_load_needs_no_scratch(spark, tmp_path, monkeypatch):
    (tmp_path / "r.csv").write_text(HEADER + "R1,North,Y,2011-03-07,,,TEST\n")
    monkeypatch.setattr("tallyhouse.runtime.scratch_dir", lambda spark: pytest.fail("scratch was used"))
    landing.load(spark, REGION, str(tmp_path / "r.csv"), str(tmp_path / "raw"))
    assert rows_at(spark, REGION, str(tmp_path / "raw")).count() == 1


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "r.csv").write_text(HEADER + 'R1,"two\nlines",Y,2000-01-01,,,MDM\n')
    assert landing.read_by_position(spark, REGION, str(tmp_path / "r.csv"), multiline=True).first().region_name == "two\nlines"


def test_listing_and_cleaned_names(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.csv").write_text("Customer No., Name (full),Größe\n1,a,2.5\n")
    (tmp_path / "sub" / "x.txt").write_text("no")
    found = landing.list_files(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in found] == [("x.csv", (tmp_path / "sub" / "x.csv").stat().st_size)]
    df = landing.read_inferred(spark, str(tmp_path / "sub" / "x.csv"))
    assert df.columns == ["customer_no", "name_full", "gr_e"] and dict(df.dtypes)["gr_e"] == "double"


def test_metadata_travels_with_the_columns(spark, tmp_path):
    (tmp_path / "r.csv").write_text(HEADER + "R1,North,Y,2000-01-01,,,MDM\n")
    target = str(tmp_path / "raw")
    landing.load(spark, REGION, str(tmp_path / "r.csv"), target)
    field = spark.read.parquet(target).schema["region_code"]
    assert field.metadata == {"comment": "region code", "max_length": 10}
