"""Tables that are stored in numbered versions, whole or part by part.

A version is a folder with a note: its schema, what it was made of and, for a table that is
split by a column, which version wrote each part. The note is written last and in one step,
so a version counts once it is complete and a write that broke off is as if it never began.
Reading takes the schema from the note and opens no data file for it.

    <folder>/<n>/_table.json            the note of version n, and the rows of a table in one piece
    <folder>/parts/<column>=<value>/version=<n>/    a part as version n wrote it
    <folder>/changes/<n>                rows that version n took away (sign -1) and added (sign 1)
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.keys import packed, unpacked
from tallyhouse.sources.tables import balanced, matching, read_text, remove, write_text

NOTE, SIGN, VERSION = "_table.json", "sign", "version"
CODEC = "zstd"  # hash keys are text of 16 letters: it halves them, the usual codec does not
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # how a missing value of a split column is spelt in a path


class VersionedTable:
    """One stored table; ``kept`` versions stay readable.

    ``derived`` columns follow from others of the same row: they are not stored but made on
    reading, where a reader asks for them. Versions that hold them are read as they are.

    Objects remember what they opened: a version never changes, so asking for the same one
    again costs one listing of the folder, without files of the version.
    """

    def __init__(self, spark: SparkSession, folder: str, kept: int = 2, derived: Mapping[str, Column] | None = None):
        self.spark, self.folder, self.kept, self.derived = spark, folder.rstrip("/"), kept, dict(derived or {})
        self._notes: dict[int, dict] = {}
        self._opened: dict[int, DataFrame] = {}

    def versions(self) -> list[int]:
        return sorted(int(p.getParent().getName()) for p in matching(self.spark, f"{self.folder}/*/{NOTE}"))

    def version(self) -> int:
        """The newest version, 0 if there is none."""
        return max(self.versions(), default=0)

    def note(self, version: int) -> dict:
        if version not in self._notes:
            self._notes[version] = json.loads(read_text(self.spark, f"{self.folder}/{version}/{NOTE}"))
        return self._notes[version]

    def made_of(self, version: int) -> dict:
        return self.note(version)["made_of"] if version else {}

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if version not in self._opened:
            note = self.note(version)
            if note["split"]:
                self._opened[version] = self.read_parts(note["parts"], version)
            else:
                rows = self.spark.read.schema(self._held(version)).parquet(f"{self.folder}/{version}")
                self._opened[version] = self._complete(rows, version)
        return self._opened[version]

    def read_parts(self, values: Iterable[str], version: int) -> DataFrame:
        """Only the named parts of a version; the files of others are not even listed."""
        note, schema = self.note(version), self._schema(version)
        paths = [f"{self._part(note['split'], v)}/{VERSION}={note['parts'][v]}" for v in sorted(set(values)) if v in note["parts"]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self._complete(self.spark.read.schema(self._held(version)).option("basePath", f"{self.folder}/parts").parquet(*paths), version)

    def write(
        self, df: DataFrame, made_of: Mapping | None = None, split: str | None = None, hidden: bool = False,
        finished: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """A new version of all rows, split by a text column if one is named; readers do not see a hidden one.

        ``finished`` makes the table's rows, one from each row of ``df``; in a split write it
        comes behind the shuffle.
        """
        version = self._next()
        finished = finished or (lambda rows: rows)
        if split:
            self._write_parts(df, split, version, finished)
            parts = {v: version for v in self._written(split, version)}
        else:
            finished(df).drop(*self.derived).write.mode("overwrite").option("compression", CODEC).parquet(f"{self.folder}/{version}")
            parts = {}
        return self._commit(version, finished(df).schema, made_of, split, hidden, parts)

    def write_parts(
        self, df: DataFrame, touched: Sequence[str], made_of: Mapping | None = None, changes: DataFrame | None = None
    ) -> DataFrame:
        """A new version in which ``df`` takes the place of the touched parts; the others stay as they are.

        ``changes`` are kept beside it: the rows that go, with sign -1, and those that come.
        """
        before, version = self.version(), self._next()
        note = self.note(before)
        schema, split = self._schema(before), note["split"]
        kinds = {f.name: f.dataType for f in schema.fields}
        rows = df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in dict.fromkeys([*schema.names, split])])
        self._write_parts(rows, split, version, lambda rows: rows)
        written = set(self._written(split, version))
        if changes is not None:
            changes.write.mode("overwrite").parquet(f"{self.folder}/changes/{version}")
        parts = {v: n for v, n in note["parts"].items() if v not in touched} | {v: version for v in written}
        shape = changes.schema.jsonValue() if changes is not None else None
        return self._commit(version, schema, made_of, split, split not in schema.names, parts, shape)

    def changes(self, since: int) -> DataFrame | None:
        """All rows that went and came after version ``since``; None if that is not kept."""
        out, now = None, self.version()
        if since > now or not since:
            return None
        for n in range(since + 1, now + 1):
            if n not in self.versions() or not self.note(n).get("changes"):
                return None
            rows = self.spark.read.schema(T.StructType.fromJson(self.note(n)["changes"])).parquet(f"{self.folder}/changes/{n}")
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            schema = self._schema(now)
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(SIGN, T.IntegerType())]))
        return out

    def changed_parts(self, since: int) -> set[str] | None:
        """Parts that differ between version ``since`` and now; None if that version is gone."""
        if since not in self.versions():
            return None
        before, now = (set(self.note(n)["parts"].items()) for n in (since, self.version()))
        return {value for value, _ in before ^ now}

    def _schema(self, version: int) -> T.StructType:
        return T.StructType.fromJson(self.note(version)["schema"])

    def _held(self, version: int) -> T.StructType:
        """The columns in the files of a version."""
        derived = self.note(version).get("derived", [])
        return T.StructType([f for f in self._schema(version).fields if f.name not in derived])

    def _complete(self, rows: DataFrame, version: int) -> DataFrame:
        """All columns of a version in their order, from what is in its files."""
        derived = self.note(version).get("derived", [])
        return rows.select(*[
            self.derived[f.name].alias(f.name, metadata=f.metadata) if f.name in derived else F.col(f.name)
            for f in self._schema(version).fields])

    def _next(self) -> int:
        version = self.version() + 1
        self._notes.pop(version, None)
        self._opened.pop(version, None)
        return version

    def _part(self, split: str, value: str) -> str:
        return f"{self.folder}/parts/{split}={value}"

    def _write_parts(self, df: DataFrame, split: str, version: int, finished: Callable[[DataFrame], DataFrame]) -> None:
        remove(self.spark, *[str(p) for p in matching(self.spark, f"{self.folder}/parts/*/{VERSION}={version}")])  # of a write that broke off
        narrow = df.drop(*self.derived)
        keys = [f.name for f in narrow.schema.fields if f.name.endswith("_key") and isinstance(f.dataType, T.StringType)]
        moved = balanced(narrow.withColumns({k: packed(k) for k in keys}), [split])
        rows = finished(moved.withColumns({k: unpacked(k) for k in keys})).drop(*self.derived).withColumn(VERSION, F.lit(version))
        rows.write.mode("append").option("compression", CODEC).partitionBy(split, VERSION).parquet(f"{self.folder}/parts")

    def _written(self, split: str, version: int) -> list[str]:
        found = matching(self.spark, f"{self.folder}/parts/*/{VERSION}={version}")
        return [p.getParent().getName().removeprefix(f"{split}=") for p in found]

    def _commit(self, version: int, schema: T.StructType, made_of: Mapping | None, split: str | None, hidden: bool, parts: dict, changes: dict | None = None) -> DataFrame:
        fields = [f for f in schema.fields if f.name != split] + [f for f in schema.fields if f.name == split and not hidden]
        note = {"schema": T.StructType(fields).jsonValue(), "made_of": dict(made_of or {}), "split": split, "parts": parts, "changes": changes,
                "derived": [n for n in schema.names if n in self.derived]}
        write_text(self.spark, f"{self.folder}/{version}/{NOTE}", json.dumps(note))
        self._clean()
        return self.read(version)

    def _clean(self) -> None:
        """Remove versions before the kept ones, and parts that none of those uses."""
        versions = self.versions()
        old, stay = versions[: -self.kept], versions[-self.kept :]
        if not old:
            return
        used = {(v, n) for k in stay for v, n in self.note(k)["parts"].items()}
        for k in old:
            note = self.note(k)
            remove(self.spark, *[f"{self._part(note['split'], v)}/{VERSION}={n}" for v, n in note["parts"].items() if (v, n) not in used])
            if note.get("changes"):
                remove(self.spark, f"{self.folder}/changes/{k}")
            remove(self.spark, f"{self.folder}/{k}")
            self._notes.pop(k, None)
            self._opened.pop(k, None)
