"""A table that keeps the newest row per key while batches keep coming in.

Each batch is appended as its own folder and the newest row is picked on reading. A
batch that is written again after a failure replaces its own folder, and picking the
newest row gives the same answer in any order, so restarts neither lose nor repeat
anything. ``compact`` folds the batches into one base from time to time and removes them.

The base is split into buckets by a hash of the key. Folding writes only the buckets that
got a row; the others stay the files they are, and the list of all buckets changes in one step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.latest import keep_latest
from tallyhouse.operators.lookup import small
from tallyhouse.runtime import MB, pieces
from tallyhouse.schemas import FILE_NAME, LOAD_TS, ROW_NUMBER
from tallyhouse.sources.tables import committed, remove
from tallyhouse.sources.versions import VersionedTable

BUCKET = "bucket"
BUCKET_BYTES = 256 * MB


@dataclass
class LatestTable:
    spark: SparkSession
    root: str
    schema: T.StructType
    keys: Sequence[str]
    newest: Sequence[str] = (LOAD_TS, ROW_NUMBER, FILE_NAME)
    buckets: int = 16  # of a new base; a base that has outgrown its buckets gets more of them

    def __post_init__(self) -> None:
        self.base = VersionedTable(self.spark, f"{self.root}/base")

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Sink for ``foreachBatch``."""
        newest = keep_latest(df.select(*self.schema.names), self.keys, self.newest)
        newest.write.mode("overwrite").parquet(f"{self.root}/changes/{batch_id}")

    def read(self) -> DataFrame:
        """The newest row of every key.

        The base already holds one row per key. While the changes are small enough to
        broadcast, only their keys are compared and the rest of the base is not shuffled.
        """
        version, changes = self.base.version(), self._folders(self.pending())
        if not version or not changes:
            return self.base.read(version) if version else keep_latest(self._rows(changes), self.keys, self.newest)
        settled, news = self.base.read(version), self._rows(changes)
        if not small(news):
            return keep_latest(settled.unionByName(news), self.keys, self.newest)
        keys = F.broadcast(news.select(*[F.col(k).alias(f"__{k}") for k in self.keys]).distinct())
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys])
        contested = settled.join(keys, same, "left_semi").unionByName(news)
        return settled.join(keys, same, "left_anti").unionByName(keep_latest(contested, self.keys, self.newest))

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def settled(self) -> int:
        """Number of the newest batch in the base, -1 if there is none."""
        return self.base.made_of(self.base.version()).get("batch", -1)

    def pending(self) -> list[int]:
        """Numbers of the batches that the base does not contain."""
        settled = self.settled()
        return [n for n in committed(self.spark, f"{self.root}/changes") if n > settled]

    def mark(self) -> int:
        """Number of the newest batch the table holds, -1 if it holds none."""
        return max([self.settled(), *committed(self.spark, f"{self.root}/changes")])

    def since(self, mark: int) -> DataFrame | None:
        """Rows of the batches after ``mark``; None if one of them has been removed already."""
        wanted = list(range(mark + 1, self.mark() + 1))
        if not set(wanted) <= set(committed(self.spark, f"{self.root}/changes")):
            return None
        return self._rows(self._folders(wanted))

    def compact(self, least: int = 1) -> None:
        """Fold the pending batches into the base, if there are ``least`` of them.

        What the base before this one contained is removed; those who opened the table just
        before still find their files.
        """
        pending = self.pending()
        if len(pending) < max(1, least):
            return
        version, settled, news = self.base.version(), self.settled(), self._rows(self._folders(pending))
        buckets = self.base.made_of(version).get("buckets", self.buckets)
        wanted = pieces(self.base.read(version), BUCKET_BYTES) if version else 1
        made_of = {"batch": max(pending), "buckets": max(buckets, wanted)}
        if not version or wanted > 4 * buckets:
            self.base.write(self._bucketed(self.read(), made_of["buckets"]), made_of, BUCKET, hidden=True)
        else:
            made_of["buckets"] = buckets
            hit = [r[0] for r in self._bucketed(news, buckets).select(BUCKET).distinct().collect()]
            rows = keep_latest(self.base.read_parts(hit, version).unionByName(news), self.keys, self.newest)
            self.base.write_parts(self._bucketed(rows, buckets), hit, made_of)
        remove(self.spark, *self._folders([n for n in committed(self.spark, f"{self.root}/changes") if n <= settled]))

    def _bucketed(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("string"))

    def _folders(self, batches: Sequence[int]) -> list[str]:
        return [f"{self.root}/changes/{n}" for n in batches]
