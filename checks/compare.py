"""Run registered queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name part ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from checks.spark_queries import ORACLES, QUERIES
from tallyhouse.runtime import session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        if isinstance(v, float) and v.is_integer():
            return int(v) if math.isfinite(v) else v
        return v

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r)))


def compare(spark, db, name: str, sf_dir: str) -> str | None:
    """What differs, or None."""
    df = QUERIES[name](spark, sf_dir)
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return None
    cursor = db.execute(ORACLES[name])
    want_names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = rows_of(got_names, got), rows_of(want_names, want)
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{x} != {y}"
    return None if a else "no rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = session("compare", partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = connect(sf_dir), 0
    for name in QUERIES:
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            problem = compare(spark, db, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
