"""Streaming jobs: landed files to raw tables, raw tables to newest rows, facts to summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.schemas import RawTable
from tallyhouse.sources.landing import CSV, file_schema, number_rows, with_origin
from tallyhouse.sources.tables import LOAD, exists, remove, replace_partitions
from tallyhouse.streaming.latest_table import LatestTable

# How old the result may be (fixed values). Tables without an entry are refreshed when
# a table that needs them is.
MONTH = "sales_month"
FRESHNESS = {"fact_sales_daily": "5 minutes", "fact_sales_weekly": "7 days", "fact_sales_monthly": "30 days"}


def trigger_for(table: str) -> dict[str, object]:
    """Trigger of the streaming job that refreshes ``table``."""
    lag = FRESHNESS.get(table)
    return {"processingTime": lag} if lag else {"availableNow": True}


def load_new_files(
    spark: SparkSession,
    spec: RawTable,
    folder: str,
    target: str,
    checkpoint: str,
    root: str = "",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append files that have not been loaded yet; each batch keeps its own folder in ``target``.

    A file is always whole within one batch, so its rows can be numbered there.
    """
    files = spark.readStream.schema(file_schema(spec)).options(**CSV)
    if files_per_batch:
        files = files.option("maxFilesPerTrigger", files_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        number_rows(batch, spec).write.mode("overwrite").parquet(f"{target}/{LOAD}=batch-{batch_id}")

    rows = with_origin(files.csv(folder), spec, root)
    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_new_rows(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the rows appended to a raw table."""
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        rows = rows.option("maxFilesPerTrigger", files_per_batch)
    return rows.parquet(path)


def keep_newest(
    rows: DataFrame, table: LatestTable, checkpoint: str, trigger: dict[str, object] | None = None
) -> StreamingQuery:
    """Fold a stream of raw rows into the newest row per key."""
    return (rows.writeStream.foreachBatch(table.write_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def refresh_touched(
    changes: DataFrame,
    partition: str,
    keys: Sequence[str],
    whole: Callable[[], DataFrame],
    build: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Rebuild the partitions of a derived table that a stream of changes touches.

    ``whole()`` is the current input and ``build`` the full definition of the table, both
    with the column ``partition``, which is a month or as coarse. ``keys`` identify a row of
    the input. Where each key lies is kept beside the table; a row that moved to another
    partition touches the one it left as well, and a partition that lost its last row goes.
    """
    spark, placed = changes.sparkSession, f"{path.rstrip('/')}__placed"

    def write(batch: DataFrame, _: int) -> None:
        touched = batch.select(partition).distinct()
        known = exists(spark, placed)
        if known:
            moved = batch.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
            same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
            places = spark.read.schema(whole().select(*keys, partition).schema).parquet(placed)
            touched = touched.union(places.join(moved, same, "left_semi").select(partition)).distinct()
        found = [row[0] for row in touched.collect()]  # one row a partition of the table
        if not found:
            return
        now = whole() if not known else whole().filter(F.col(partition).isin(found))
        replace_partitions(build(now), path, [partition])
        replace_partitions(now.select(*keys, partition), placed, [partition])
        left = {row[0] for row in now.select(partition).distinct().collect()}
        remove(spark, *[f"{at}/{partition}={value}" for value in found if value not in left for at in (path, placed)])

    return (changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def keep_fresh(
    table: str, changes: DataFrame, refresh: Callable[[], object], checkpoint: str, trigger: dict[str, object] | None = None
) -> StreamingQuery:
    """Run ``refresh`` for every batch of ``changes``, as often as ``table`` has to be fresh."""
    def write(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            refresh()

    return (changes.writeStream.queryName(f"fresh_{table}").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or trigger_for(table))).start())


def month_of(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")
