import pytest
from pyspark.sql import functions as F

from tallyhouse import runtime
from tallyhouse.operators.lookup import lookup
from tallyhouse.runtime import stored


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the rows has one key, some keys are NULL or unknown."""
    many = spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("key"))
    one = spark.range(600).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("value"))
    one = one.unionByName(spark.createDataFrame([("hot", -1)], "key string, value long"))
    return stored(many), stored(one)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_all_ways_agree(sides, plan, how):
    many, one = sides
    small = lookup(many, one, "key", how)
    plain = lookup(many, one, "key", how, broadcast_bytes=0)
    want = sorted(many.join(one, "key", how).collect(), key=str)
    for df in (small, plain):
        assert sorted(df.collect(), key=str) == want
    assert "BroadcastHashJoin" in plan(small)
    assert "Broadcast" not in plan(lookup(many, one.hint("merge"), "key", how, broadcast_bytes=0))


def test_size_of_sources(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100_000).selectExpr("id", "sha2(cast(id as string), 256) as h").write.parquet(path)
    df = spark.read.parquet(path)
    once, twice = runtime.source_bytes(df), runtime.source_bytes(df.unionByName(df))
    assert once > 1_000_000 and twice == 2 * once
    assert runtime.source_bytes(df.groupBy("h").count()) == once


def test_shuffles_fit_the_input_for_one_write(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100_000).write.parquet(path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with runtime.fitted_shuffles(spark, spark.read.parquet(path)) as number:
        assert number == int(before)
    with pytest.raises(KeyError), runtime.fitted_shuffles(spark, spark.read.parquet(path), piece=1024) as number:
        assert number > 100 and int(spark.conf.get("spark.sql.shuffle.partitions")) == number
        raise KeyError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_tasks_of_a_build_read_little(spark, tmp_path):
    path, names = str(tmp_path / "t"), runtime.TASK_SIZES
    spark.range(100).write.parquet(path)
    before = [spark.conf.get(n) for n in names]
    with runtime.fitted_shuffles(spark, spark.read.parquet(path)):
        assert all(int(spark.conf.get(n)) <= runtime.TASK_BYTES for n in names)
    assert [spark.conf.get(n) for n in names] == before


def test_unknown_sizes_may_be_large(spark):
    assert runtime.may_be_skewed(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "n long"))
    assert not runtime.may_be_skewed(spark.range(10))


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Far:
        conf = Conf()

        class sparkContext:
            master = "spark://somewhere"

    with pytest.raises(RuntimeError):
        runtime.scratch_dir(Far())
