"""From landed files to gold, as one batch and in two incremental runs."""

import shutil
from datetime import datetime

import pytest

from tallyhouse.plans import batch
from tallyhouse.schemas import RAW_TABLES
from tallyhouse.sources import tables
from tallyhouse.sources.samples import SOURCES
from tallyhouse.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """One CSV file per raw table under its usual path, quoted where needed."""
    root = tmp_path_factory.mktemp("landing")
    for name, spec in RAW_TABLES.items():
        columns = spec.columns
        pdf = SOURCES[name](spark, SF).selectExpr(*[f"cast({c} as string) as {c}" for c in columns]).toPandas()
        for i in range(spec.trailing):
            pdf[f"more_{i}"] = "x"
        (root / spec.folder).mkdir(exist_ok=True)
        pdf.to_csv(root / spec.file, index=False)
    return root


def test_batch_and_sql(spark, landing, tmp_path):
    batch.load_all(spark, str(landing), str(tmp_path), "qa", datetime(2024, 1, 1))
    house = batch.warehouse(spark, str(tmp_path), "qa")
    house.build()
    house.views("fact_sales_item", "dim_product")
    lines = spark.sql("select price_tier, count(*) as lines, max(quantity) as most from fact_sales_item "
                      "join dim_product using (product_dim_key) group by price_tier").collect()
    assert sum(r.lines for r in lines) == house.open("fact_sales_item").count() > 0
    assert (tmp_path / "qa" / "gold" / "fact_sales_header" / "1").is_dir()
    schema = house.open("dim_country").schema
    assert all("comment" in f.metadata for f in schema)
    names = {r[0] for r in house.table("silver_region_master").select("__file_name").collect()}
    assert names == {"country-master/region_master.csv"}


def test_two_runs_equal_one_load(spark, landing, tmp_path):
    files = tmp_path / "in"
    for name, spec in RAW_TABLES.items():
        (files / spec.folder / name).mkdir(parents=True)
        shutil.copy(landing / spec.file, files / spec.folder / name / "1.csv")
    once = batch.refresh(spark, str(files), str(tmp_path / "house"))
    before = once.table("dim_store").count()
    # the second delivery moves one store to another country and brings nothing else
    store = RAW_TABLES["store_master"]
    header, first, *_ = (landing / store.file).read_text().splitlines()
    cells = first.split(",")
    (files / store.folder / store.name / "2.csv").write_text("\n".join([header, ",".join([*cells[:2], "N24", *cells[3:]])]) + "\n")
    twice = batch.refresh(spark, str(files), str(tmp_path / "house"))
    moved = twice.table("dim_store")
    assert moved.count() == before
    assert moved.filter(f"store_code = '{cells[0]}'").select("country_code").first()[0] == "N24"
    assert twice.table("silver_store_master").filter("__file_name like '%/2.csv'").count() == 1
    # a run that finds nothing new writes no table
    stored = {p: p.stat().st_mtime_ns for kind in ("gold", "silver", "bronze", "newest") for p in (tmp_path / "house" / "dev" / kind).rglob("*")}
    batch.refresh(spark, str(files), str(tmp_path / "house"))
    assert stored == {p: p.stat().st_mtime_ns for kind in ("gold", "silver", "bronze", "newest") for p in (tmp_path / "house" / "dev" / kind).rglob("*")}


def test_batch_loads_around_an_incremental_one(spark, tmp_path):
    spec, house = RAW_TABLES["region_master"], str(tmp_path / "house")
    line = "{0},Area {0},Y,2001-02-03,,,TEST\n"
    for run, codes in (("a", "AB"), ("c", "EF")):
        (tmp_path / run / spec.folder).mkdir(parents=True)
        (tmp_path / run / spec.file).write_text("h\n" + "".join(line.format(c) for c in codes))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "1.csv").write_text("h\n" + "".join(line.format(c) for c in "CD"))
    target = batch.raw_path(house, "dev", spec.name)
    batch.load_all(spark, str(tmp_path / "a"), house, only=[spec.name], load="monday")
    jobs.load_new_files(spark, spec, str(tmp_path / "b"), target, str(tmp_path / "check")).awaitTermination()
    batch.load_all(spark, str(tmp_path / "c"), house, only=[spec.name])
    batch.load_all(spark, str(tmp_path / "a"), house, only=[spec.name], load="monday")  # repeated, replaces itself
    got = tables.read(spark, target, spec.schema).select("region_code").collect()
    assert sorted(r[0] for r in got) == list("ABCDEF")
