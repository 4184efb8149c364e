from pyspark.sql import functions as F

from tallyhouse.sources import tables


def months(spark, *months_):
    return spark.createDataFrame([(m, i, f"v{i}") for i, m in enumerate(months_)], "month string, n long, v string")


def test_replace_and_replace_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = months(spark, "2024-01", "2024-01", "2024-02", "2024-03")
    assert sorted(tables.replace(df, path, ["month"]).collect()) == sorted(df.collect())
    fresh = months(spark, "2024-02").withColumn("v", F.lit("new"))
    tables.replace_partitions(fresh, path, ["month"])
    got = {(r.month, r.v) for r in tables.read(spark, path, df.schema).collect()}
    assert got == {("2024-01", "v0"), ("2024-01", "v1"), ("2024-02", "new"), ("2024-03", "v3")}


def test_partitioned_write_is_rebalanced_and_read_is_pruned(spark, tmp_path, plan):
    df = months(spark, "2024-01", "2024-02")
    assert "REBALANCE" in plan(tables.balanced(df, ["month"])).upper()
    stored = tables.replace(df, str(tmp_path / "t"), ["month"])
    assert "PartitionFilters: [isnotnull(month" in plan(stored.filter("month = '2024-02'"))


def test_append_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.append(months(spark, "2024-01"), path)
    assert spark.read.parquet(path).count() == 2


def test_bucketed_join_needs_no_shuffle(spark, tmp_path, plan):
    a = tables.save_bucketed(spark.range(500).withColumnRenamed("id", "k"), "bucket_a", str(tmp_path / "a"), ["k"], 4)
    b = tables.save_bucketed(spark.range(300).withColumnRenamed("id", "k"), "bucket_b", str(tmp_path / "b"), ["k"], 4)
    joined = a.join(b.hint("merge"), "k")
    assert "Exchange" not in plan(joined) and joined.count() == 300
    spark.sql("drop table bucket_a")
    spark.sql("drop table bucket_b")
