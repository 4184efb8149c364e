"""Session, size checks and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MB = 1 << 20
GB = 1 << 30

# A lookup side is broadcast only when the files it is read from are at most
# this large. Lookup sides hold at most one row per row of their base table, so
# the compressed size of those files bounds what is sent to each executor.
BROADCAST_BYTES = 16 * MB

# What a task of a build reads from files or a shuffle; sorted rows take many times that.
TASK_BYTES = 16 * MB
TASK_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")

# Below this input size one key cannot overload a task, so skew is not looked for.
SKEW_BYTES = 8 * GB

# Spark gives sources without statistics about the largest long as their size.
UNKNOWN_BYTES = 1 << 60


def session(app: str = "tallyhouse", cpus: str = "*", partitions: int | None = None) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder of the session.

    Only a local master may fall back to a temporary folder of the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="tallyhouse-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def source_bytes(df: DataFrame) -> int:
    """Size of all files and local rows that the optimised plan of ``df`` reads.

    Sources without statistics count as huge: nothing is broadcast on their account.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def may_be_skewed(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the sources of ``df`` are large enough for one key to overload a task; unknown sizes may be."""
    return (SKEW_BYTES if limit is None else limit) <= source_bytes(df)


def pieces(df: DataFrame, size: int = 128 * MB) -> int:
    """Number of pieces of ``size`` bytes in the sources of ``df``, 1 where their size is unknown."""
    total = source_bytes(df)
    return -(-total // size) if total < UNKNOWN_BYTES else 1


@contextmanager
def fitted_shuffles(spark: SparkSession, *inputs: DataFrame, piece: int = TASK_BYTES) -> Iterator[int]:
    """For one write, let tasks read ``TASK_BYTES`` at most and shuffles start with one partition per ``piece`` of the inputs.

    Rows take ten to thirty times the bytes of their files when a task sorts them, so what a
    task sorts fits into its memory at any size of the input. Adaptive execution merges small
    partitions but never splits those of an aggregate or a window, so the starting number has
    to suit the largest input; it is never less than set. The caller's settings are put back.
    """
    name = "spark.sql.shuffle.partitions"
    before = {n: spark.conf.get(n) for n in (name, *TASK_SIZES)}
    number = max([int(before[name]), *(pieces(df, piece) for df in inputs)])
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(name, str(number))
    for n in TASK_SIZES:
        spark.conf.set(n, str(min(as_bytes(before[n]), TASK_BYTES)))
    try:
        yield number
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written once and read back: cuts the lineage and survives lost executors."""
    path = path or scratch_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
