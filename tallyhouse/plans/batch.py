"""The batch job: landed files to gold tables.

    spark-submit tallyhouse/plans/batch.py <landing folder> <warehouse folder> [environment]
"""

from __future__ import annotations

import sys
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.silver import flagged
from tallyhouse.plans.warehouse import GOLD, SALES, Warehouse
from tallyhouse.schemas import RAW_TABLES
from tallyhouse.sources import landing, tables
from tallyhouse.streaming import jobs
from tallyhouse.streaming.latest_table import LatestTable


def load_all(
    spark: SparkSession,
    folder: str,
    root: str,
    env: str = "dev",
    load_ts: datetime | None = None,
    only: Iterable[str] = RAW_TABLES,
    load: str | None = None,
) -> None:
    """Append the landed file of every raw table, found under ``folder`` by its usual path.

    A run that names its ``load`` and is repeated replaces what it loaded before.
    """
    for name in only:
        spec = RAW_TABLES[name]
        landing.load(spark, spec, f"{folder}/{spec.file}", raw_path(root, env, name), load_ts, root=folder, load=load)


def raw_path(root: str, env: str, name: str) -> str:
    return f"{root.rstrip('/')}/{env}/bronze/{name}"


def warehouse(spark: SparkSession, root: str, env: str = "dev") -> Warehouse:
    """Silver and gold over the raw tables stored under ``root``; ``build`` makes them, ``open`` reads them."""
    return Warehouse(spark, root, lambda n: tables.read(spark, raw_path(root, env, n), RAW_TABLES[n].schema), env)


COMPACT_AFTER = 8  # pending batches of a table that are folded into its base


def refresh(spark: SparkSession, folder: str, root: str, env: str = "dev") -> Warehouse:
    """One incremental run: load new files, fold them into the newest rows, bring gold up to date.

    Files are taken from the folder of each table, ``<group>/<table>/*.csv``. Silver is
    kept by stream checkpoints and is not computed again from all of the raw rows; the silver
    sales are a view of those newest rows. Facts and summaries are changed where sales came,
    went or moved (see ``increments``), or made anew where that cannot be told.

    Every stored table knows which batches it was made of, and what lags behind is built: a run
    that fails anywhere is made up for by the next one, even if no new file arrives. A run
    that finds nothing new writes no table.
    """
    base = f"{root.rstrip('/')}/{env}"
    newest: dict[str, LatestTable] = {}
    for name, spec in RAW_TABLES.items():
        jobs.load_new_files(spark, spec, f"{folder}/{spec.folder}/{name}", raw_path(root, env, name),
                            f"{base}/checkpoints/load/{name}", root=folder).awaitTermination()
        newest[name] = LatestTable(spark, f"{base}/newest/{name}", spec.schema, spec.keys)
        jobs.keep_newest(jobs.read_new_rows(spark, raw_path(root, env, name), spec.schema), newest[name],
                         f"{base}/checkpoints/newest/{name}").awaitTermination()
        newest[name].compact(COMPACT_AFTER)

    def silver(_: DataFrame, name: str) -> DataFrame:
        return flagged(newest[name].read(), name)

    marks = {name: table.mark() for name, table in newest.items()}
    house = Warehouse(spark, root, lambda n: newest[n].read(), env, silver, marks.__getitem__, lambda n, mark: newest[n].since(mark))
    house.build(*[f"silver_{n}" for n in RAW_TABLES if f"silver_{n}" not in SALES], *GOLD, stale=True)
    return house


if __name__ == "__main__":
    session = SparkSession.builder.appName("tallyhouse").getOrCreate()
    source, target, *rest = sys.argv[1:]
    load_all(session, source, target, *rest[:1])
    warehouse(session, target, *rest[:1]).build()
