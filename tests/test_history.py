from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.history import CURRENT, END, START, as_of, history
from tallyhouse.operators.integrity import key_violations
from tallyhouse.operators.ordered import CHUNK, chunked, neighbours

T0, OPEN = datetime(2024, 1, 1), datetime(9999, 12, 31, 23, 59, 59)


def versions_of(rows):
    """Brute force: rows are (key, number, ts, state)."""
    out, by_key = set(), {}
    last_of = {(r[0], r[2]): r for r in sorted(rows, key=lambda r: r[1])}  # one row counts for a key and a time
    for row in sorted(last_of.values(), key=lambda r: r[2]):
        kept = by_key.setdefault(row[0], [])
        if not kept or kept[-1][3] != row[3]:
            kept.append(row)
    for kept in by_key.values():
        for i, (key, number, ts, state) in enumerate(kept):
            last = i + 1 == len(kept)
            out.add((key, number, state, ts, OPEN if last else kept[i + 1][2], last))
    return out


@pytest.fixture(scope="module")
def loads():
    """A third of the rows belongs to one key; NULL states and repeated times occur."""
    r = Random(5)
    return [("hot" if i % 3 == 0 else f"k{r.randrange(40)}", i, T0 + timedelta(minutes=r.randrange(400)),
             r.choice(["a", "b", None])) for i in range(1500)]


@pytest.mark.parametrize("skew_bytes", [None, 0])
def test_history_equals_brute_force(local, loads, skew_bytes):
    df = local(loads, "key string, number long, ts timestamp_ntz, state string")
    got = history(df, ["key"], ["state"], ["ts", "number"], skew_bytes).select("key", "number", "state", START, END, CURRENT)
    assert {tuple(r) for r in got.collect()} == versions_of(loads)


def test_a_hot_key_spans_chunks(local, loads):
    df = local(loads, "key string, number long, ts timestamp_ntz, state string")
    cut = chunked(df, ["key"], ["ts", "number"], skew_bytes=0)
    per_chunk = cut.groupBy(CHUNK).count().collect()
    assert len(per_chunk) > 1 and max(r["count"] for r in per_chunk) < len(loads) / 2
    assert cut.filter("key = 'hot'").select(CHUNK).distinct().count() > 1


def test_unchanged_reload_is_no_version(local):
    rows = [("k", 1, T0, "x"), ("k", 2, T0 + timedelta(1), "x"), ("k", 3, T0 + timedelta(2), "y")]
    df = local(rows, "key string, number long, ts timestamp_ntz, state string")
    got = history(df, ["key"], ["state"], ["ts", "number"]).orderBy(START).select("number", END, CURRENT).collect()
    assert [tuple(r) for r in got] == [(1, T0 + timedelta(2), False), (3, OPEN, True)]


@pytest.mark.parametrize("skew_bytes", [None, 0])
def test_copies_are_no_versions(local, loads, skew_bytes):
    rows = loads[:300] + [loads[0]] * 400
    df = local(rows, "key string, number long, ts timestamp_ntz, state string")
    got = history(df, ["key"], ["state"], ["ts", "number"], skew_bytes).select("key", "number", "state", START, END, CURRENT)
    assert sorted(map(str, got.collect())) == sorted(map(str, history(
        df.distinct(), ["key"], ["state"], ["ts", "number"]).select(*got.columns).collect()))
    assert {tuple(r) for r in got.collect()} == versions_of(loads[:300])


@pytest.mark.parametrize("skew_bytes", [None, 0])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_as_of_equals_brute_force(local, loads, skew_bytes, how):
    df = local(loads, "key string, number long, ts timestamp_ntz, state string")
    dated = history(df, ["key"], ["state"], ["ts", "number"])
    versions = dated.select("key", START, F.col("number").alias("version"), END)
    assert key_violations(versions, ["key", START]).first()["repeated_keys"] == 0
    r = Random(9)
    facts = [("hot" if i % 2 else f"k{r.randrange(45)}", i, T0 + timedelta(minutes=r.randrange(-30, 430))) for i in range(900)]
    got = as_of(local(facts, "key string, fact long, at timestamp_ntz"), versions, "key", "at",
                ["version"], how, skew_bytes)
    held = [tuple(v) for v in versions.select("key", START, END, "version").collect()]
    want = set()
    for key, fact, at in facts:
        match = [v[3] for v in held if v[0] == key and v[1] <= at < v[2]]
        assert len(match) < 2
        if match or how == "left":
            want.add((key, fact, at, match[0] if match else None))
    assert {tuple(x) for x in got.collect()} == want and got.count() == len(want)


@pytest.mark.parametrize("skew_bytes", [None, 0])
def test_neighbours_with_null_values(local, skew_bytes):
    rows = [("a" if i % 4 else "b", i, None if i % 3 else i) for i in range(400)]
    df = local(rows, "key string, n long, v long")
    got = neighbours(chunked(df, ["key"], ["n"], skew_bytes), ["key"], ["n"], {
        "before": ("previous", F.col("v")), "after": ("next", F.col("v")), "held": ("carried", F.col("v"))})
    want = set()
    for key in ("a", "b"):
        series = [r for r in rows if r[0] == key]
        held = None
        for i, (_, n, v) in enumerate(series):
            held = v if v is not None else held
            want.add((key, n, v, series[i - 1][2] if i else None,
                      series[i + 1][2] if i + 1 < len(series) else None, held))
    assert {tuple(r) for r in got.select("key", "n", "v", "before", "after", "held").collect()} == want


@pytest.mark.parametrize("turned", [False, True])
def test_two_rows_of_one_load(local, turned):
    rows = [("k", 1, T0, "x"), ("k", 2, T0, "y")]
    df = local(rows[::-1] if turned else rows, "key string, number long, ts timestamp_ntz, state string")
    dated = history(df, ["key"], ["state"], ["ts", "number"])
    assert [(r.number, r[START], r[END]) for r in dated.collect()] == [(2, T0, OPEN)]
    # versions from elsewhere may start together: the one that ends last holds
    given = local([("k", T0, T0, 1), ("k", T0, OPEN, 2)][:: -1 if turned else 1], f"key string, {START} timestamp_ntz, {END} timestamp_ntz, version long")
    facts = local([("k", T0 + timedelta(1))], "key string, at timestamp_ntz")
    assert [r.version for r in as_of(facts, given, "key", "at", ["version"]).collect()] == [2]
