from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.latest import keep_latest
from tallyhouse.schemas import FILE_NAME, REGION, ROW_NUMBER
from tallyhouse.sources import tables
from tallyhouse.sources.versions import VersionedTable
from tallyhouse.streaming import jobs
from tallyhouse.streaming.latest_table import LatestTable

SCHEMA = "k string, ts timestamp_ntz, n long, v string"


def batches(local, count=4, seed=3):
    r = Random(seed)
    rows = [(None if i % 17 == 0 else f"k{r.randrange(25)}", datetime(2024, 1, 1) + timedelta(hours=r.randrange(50)), i,
             f"v{i}") for i in range(240)]
    return rows, [local(rows[i::count], SCHEMA) for i in range(count)]


def table(spark, root):
    return LatestTable(spark, str(root), T._parse_datatype_string(SCHEMA), ["k"], ["ts", "n"])


def newest(local, rows):
    return sorted(keep_latest(local(rows, SCHEMA), ["k"], ["ts", "n"]).collect(), key=str)


def test_batches_replays_and_compaction(spark, local, tmp_path):
    rows, parts = batches(local)
    t = table(spark, tmp_path)
    assert t.read().count() == 0
    t.write_batch(parts[0], 0)
    t.write_batch(parts[1], 1)
    t.write_batch(parts[1], 1)  # the same batch again after a failure
    t.compact()
    assert sorted(t.read().collect(), key=str) == newest(local, rows[0::4] + rows[1::4])
    t.write_batch(parts[3], 2)  # batches may arrive in any order
    t.write_batch(parts[2], 3)
    assert sorted(t.read().collect(), key=str) == newest(local, rows)
    t.compact()
    assert sorted(t.read().collect(), key=str) == newest(local, rows)


def test_large_changes_take_the_shuffled_way(spark, local, tmp_path, monkeypatch, plan):
    rows, parts = batches(local, 2)
    t = table(spark, tmp_path)
    t.write_batch(parts[0], 0)
    t.compact()
    t.write_batch(parts[1], 1)
    assert "BroadcastHashJoin" in plan(t.read())
    monkeypatch.setattr("tallyhouse.runtime.BROADCAST_BYTES", 0)
    assert "Broadcast" not in plan(t.read())
    assert sorted(t.read().collect(), key=str) == newest(local, rows)


def test_an_unfinished_batch_is_not_read(spark, local, tmp_path):
    rows, parts = batches(local, 2)
    t = table(spark, tmp_path)
    t.write_batch(parts[0], 0)
    parts[1].write.parquet(str(tmp_path / "changes" / "1"))
    (tmp_path / "changes" / "1" / "_SUCCESS").unlink()
    assert sorted(t.read().collect(), key=str) == newest(local, rows[0::2])


def test_stream_equals_batch_and_restarts(spark, local, tmp_path):
    rows, parts = batches(local, 3)
    raw, check = str(tmp_path / "raw"), str(tmp_path / "check")
    t = table(spark, tmp_path / "t")
    for part in parts:  # every run sees only what was appended since
        tables.append(part, raw)
        q = jobs.keep_newest(jobs.read_new_rows(spark, raw, t.schema, 1), t, check)
        q.awaitTermination()
    assert sorted(t.read().collect(), key=str) == newest(local, rows)


def test_new_files_only_with_row_numbers(spark, local, tmp_path):
    landed, target, check = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "check")
    landed.mkdir()
    for day in (1, 2):
        for part in ("a", "b"):
            (landed / f"{day}{part}.csv").write_text(
                "h\n" + "".join(f"R{day}{part}{i},n,Y,2000-01-01,,,MDM\n" for i in range(3)))
        jobs.load_new_files(spark, REGION, str(landed), target, check, str(tmp_path), files_per_batch=1).awaitTermination()
        got = tables.read(spark, target, REGION.schema)
        assert got.count() == day * 6
    numbers = {(r.region_code, r[FILE_NAME], r[ROW_NUMBER]) for r in got.collect()}
    assert ("R2b2", "in/2b.csv", 3) in numbers and ("R1a0", "in/1a.csv", 1) in numbers


def test_only_touched_partitions_are_rebuilt(spark, local, tmp_path):
    fact, out = str(tmp_path / "fact"), str(tmp_path / "out")
    schema = "id long, delivery long, n long, month string"

    def build(df):
        return df.groupBy("month").agg(F.sum("n").alias("n")).select("n", "month")

    def whole():
        return keep_latest(tables.read(spark, fact, first.schema), ["id"], ["delivery"])

    def run(rows):
        tables.append(rows, fact)
        changes = spark.readStream.schema(first.schema).option("recursiveFileLookup", "true").parquet(fact)
        jobs.refresh_touched(changes, "month", ["id"], whole, build, out, str(tmp_path / "c")).awaitTermination()
        return {(r.month, r.n) for r in tables.read(spark, out, T._parse_datatype_string("n long, month string")).collect()}

    first = local([(1, 1, 10, "01"), (2, 1, 5, "01"), (3, 1, 7, "03"), (4, 1, 1, "04")], schema)
    assert run(first) == {("01", 15), ("03", 7), ("04", 1)}
    untouched = {p.name for p in (tmp_path / "out" / "month=04").iterdir()}
    # one sale moves to another month, one leaves its month empty, one is new
    second = local([(1, 2, 11, "02"), (3, 2, 7, "02"), (9, 1, 2, "05")], schema)
    assert run(second) == {("01", 5), ("02", 18), ("04", 1), ("05", 2)}
    assert {p.name for p in (tmp_path / "out" / "month=04").iterdir()} == untouched


def test_pending_batches_are_folded_and_removed(spark, local, tmp_path):
    rows, parts = batches(local)
    t = table(spark, tmp_path)
    for i, part in enumerate(parts):
        t.write_batch(part, i)
        t.compact(least=2)
    assert t.pending() == [] and t.base.versions() == [1, 2] and t.settled() == 3
    assert tables.committed(spark, f"{t.root}/changes") == [2, 3]  # what the base before contained is gone
    assert sorted(t.read().collect(), key=str) == newest(local, rows)


def test_folding_rewrites_only_the_buckets_that_were_hit(spark, local, tmp_path, monkeypatch):
    rows, parts = batches(local, 2)
    t = table(spark, tmp_path)
    t.write_batch(parts[0], 0)
    t.compact()
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "base" / "parts").rglob("*.parquet")}
    assert len({p.parent.parent for p in before}) > 4
    one = t._bucketed(t.read(), t.buckets).filter("k is not null").limit(1).collect()[0]
    news = [(one.k, datetime(2024, 9, 1), 10_000, "new")]
    t.write_batch(local(news, SCHEMA), 1)
    # a run that breaks off before the list of buckets is written changes nothing
    monkeypatch.setattr(VersionedTable, "_commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        t.compact()
    monkeypatch.undo()
    want = newest(local, rows[0::2] + news)
    assert sorted(table(spark, tmp_path).read().collect(), key=str) == want
    t = table(spark, tmp_path)
    t.compact()
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "base" / "parts").rglob("*.parquet")}
    assert {p.parent.parent.name for p in set(after) - set(before)} == {f"bucket={one.bucket}"}
    assert all(after[p] == before[p] for p in set(after) & set(before)) and set(before) <= set(after)
    assert sorted(t.read().collect(), key=str) == want and t.pending() == []


def test_a_base_that_outgrew_its_buckets_gets_more(spark, local, tmp_path, monkeypatch):
    rows, parts = batches(local, 2)
    t = table(spark, tmp_path)
    t.buckets = 1
    for n, part in enumerate(parts):
        t.write_batch(part, n)
        t.compact()
        monkeypatch.setattr("tallyhouse.streaming.latest_table.BUCKET_BYTES", 200)
    assert t.base.made_of(t.base.version())["buckets"] > 4
    assert sorted(t.read().collect(), key=str) == newest(local, rows)


def test_a_job_keeps_a_table_fresh(spark, local, tmp_path):
    raw, seen = str(tmp_path / "raw"), []
    tables.append(local([(1,)], "n long"), raw)
    rows = spark.readStream.schema("n long").option("recursiveFileLookup", "true").parquet(raw)
    jobs.keep_fresh("dim_store", rows, lambda: seen.append(1), str(tmp_path / "c")).awaitTermination()
    jobs.keep_fresh("dim_store", rows, lambda: seen.append(2), str(tmp_path / "c")).awaitTermination()
    assert seen == [1]


def test_triggers():
    assert jobs.trigger_for("fact_sales_daily") == {"processingTime": "5 minutes"}
    assert jobs.trigger_for("fact_sales_monthly") == {"processingTime": "30 days"}
    assert jobs.trigger_for("dim_store") == {"availableNow": True}
