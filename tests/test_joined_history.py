"""Versions of joined dimensions, interval joins, best rows of groups, levels and bitmaps against brute force."""

from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from checks import spark_queries
from checks.spark_queries import Data
from tallyhouse.operators import bitmaps
from tallyhouse.operators.history import CURRENT, END, START, intersected, merged
from tallyhouse.operators.intervals import interval_join
from tallyhouse.operators.ranking import best_of_each, on_levels
from tallyhouse.plans import customers

SF = "/root/testdata/sf0.001"
T0, OPEN, FIRST = datetime(2024, 1, 1), datetime(9999, 12, 31, 23, 59, 59), datetime(1, 1, 1)


def line(r, key, most=5, holes=True):
    """Versions of one key: in order, some with a gap to the next, the last sometimes open."""
    times = sorted(r.sample(range(40), r.randrange(1, most + 1) + 1))
    out = []
    for i, (a, z) in enumerate(zip(times, times[1:])):
        if holes and r.random() < 0.2:
            continue
        last = i + 2 == len(times)
        out.append((key, T0 + timedelta(days=a), OPEN if last and r.random() < 0.7 else T0 + timedelta(days=z)))
    return out


def sides(seed):
    r = Random(seed)
    right = [(*v, r.choice("xyz")) for k in ("hot", "b", "c", "d") for v in line(r, k)]
    left = [(f"k{i}", "hot" if i % 2 else r.choice(["b", "c", "d", "lost", None]), a, z) for i in range(40) for _, a, z in line(r, "", 4)]
    return left, right


def at_each_moment(left, right, how):
    """Brute force: the state of every key on each day."""
    out = {}
    for day in [FIRST, *[T0 + timedelta(days=d) for d in range(60)]]:
        for key, ref, a, z in left:
            if a <= day < z:
                held = [v for k, s, e, v in right if k == ref and s <= day < e]
                if held or how == "left":
                    out[key, day] = (ref, held[0] if held else None)
    return out


@pytest.mark.parametrize("skew_bytes", [None, 0])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_intersections_and_merging(local, how, skew_bytes):
    left, right = sides(4)
    a = local(left, f"key string, ref string, {START} timestamp_ntz, {END} timestamp_ntz")
    b = local(right, f"ref string, {START} timestamp_ntz, {END} timestamp_ntz, v string")
    cut = intersected(a, b, "ref", ["v"], how, skew_bytes)
    want = at_each_moment(left, right, how)
    for pieces in (cut, merged(cut, ["key"], ["ref", "v"], skew_bytes)):
        rows = pieces.collect()
        got = {}
        for row in rows:
            assert row[START] < row[END]
            for day in [FIRST, *[T0 + timedelta(days=d) for d in range(60)]]:
                if row[START] <= day < row[END]:
                    assert (row.key, day) not in got  # no overlaps
                    got[row.key, day] = (row.ref, row.v)
        assert got == want  # and no gaps
    by_key = defaultdict(list)
    for row in rows:
        by_key[row.key].append((row[START], row[END], row.ref, row.v, row[CURRENT]))
    for found in by_key.values():
        found.sort()
        assert all(x[1] < y[0] or x[2:4] != y[2:4] for x, y in zip(found, found[1:]))  # neighbours differ
        assert all(x[4] == (x[1] == OPEN) for x in found)


def test_intersections_of_nothing(local):
    left, right = sides(1)
    a = local(left, f"key string, ref string, {START} timestamp_ntz, {END} timestamp_ntz")
    b = local(right, f"ref string, {START} timestamp_ntz, {END} timestamp_ntz, v string").limit(0)
    assert intersected(a, b, "ref", ["v"]).collect() == []
    kept = intersected(a, b, "ref", ["v"], "left")
    assert kept.count() == len(left) and kept.filter("v is not null").count() == 0
    assert intersected(a.limit(0), b, "ref", ["v"], "left").collect() == []


# -- points in intervals ------------------------------------------------------------------

def held(points, intervals, keyed):
    return sorted(((p, i) for p, k, t in points for i, j, a, z in intervals
                   if t is not None and a is not None and a <= t and (z is None or t < z) and (not keyed or k == j)))


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("kind", ["long", "date", "timestamp_ntz"])
def test_interval_join(local, keyed, kind):
    r = Random(8)
    make = {"long": lambda d: d * 7 - 900, "date": lambda d: date(2020, 1, 1) + timedelta(days=d), "timestamp_ntz": lambda d: T0 + timedelta(minutes=17 * d)}[kind]
    points = [(i, r.choice("ab"), make(r.randrange(400)) if i % 19 else None) for i in range(300)]
    spans = [(r.randrange(400), r.choice([1, 2, 5, 30, 0])) for _ in range(80)] + [(0, 399), (3, 200)]
    intervals = [(i, "hot" if i == 0 else r.choice("ab"), make(a), make(a + n)) for i, (a, n) in enumerate(spans)]
    intervals += [(900, "a", make(-5000), None), (901, "b", None, make(10)), (902, "a", make(350), None)]
    a, b = local(points, f"p long, k string, t {kind}"), local(intervals, f"i long, k string, s {kind}, e {kind}")
    if keyed:
        got = interval_join(a, b, "t", "s", "e", ["k"])
    else:
        got = interval_join(a, b.withColumnRenamed("k", "other"), "t", "s", "e")
    assert sorted((x.p, x.i) for x in got.collect()) == held(points, intervals, keyed)
    assert interval_join(a, b.limit(0), "t", "s", "e", ["k"]).collect() == []


def test_interval_join_has_no_nested_loop_and_repeats_points_by_levels_only(spark, plan):
    days = spark.range(1000).withColumnRenamed("id", "t")
    spans = spark.range(500).select(F.col("id").alias("i"), (F.col("id") * 2).alias("s"), (F.col("id") * 2 + 3).alias("e"))
    spans = spans.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("i"), F.lit(0).cast("long").alias("s"), F.lit(10**12).alias("e")))
    joined = interval_join(days, spans, "t", "s", "e")
    text = plan(joined)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert joined.filter("i = -1").count() == 1000 and joined.count() == 1000 + sum(1 for t in range(1000) for i in range(500) if 2 * i <= t < 2 * i + 3)
    text = plan(spark_queries.QUERIES["jn_19_interval_without_key"](spark, SF))
    assert "NestedLoop" not in text


# -- groups -------------------------------------------------------------------------------

def test_best_of_each_with_ties_and_shares(local, plan):
    r = Random(3)
    rows = [("hot" if i % 2 else r.choice([None, "a"]), i, r.choice([1, 2, 3, 5, None])) for i in range(200)]
    df = local(rows, "g string, i long, n long")
    got = best_of_each(df, ["g"], "n", 4, "share")
    want = set()
    for g in {x[0] for x in rows}:
        own = [x for x in rows if x[0] == g]
        total = sum(x[2] or 0 for x in own)
        order = sorted(own, key=lambda x: -(x[2] or 0))
        for x in own:
            rank = 1 + sum((y[2] or 0) > (x[2] or 0) for y in own)
            if rank <= 4:
                want.add((g, x[1], rank, 1 + len({y[2] for y in own if (y[2] or 0) > (x[2] or 0)}), None if x[2] is None else x[2] / total))
        assert order
    assert {(x.g, x.i, x["rank"], x.dense_rank, x.share) for x in got.collect()} == want
    text = plan(best_of_each(df, ["g"], "n", 4))
    assert text.count("WindowGroupLimit") == 2  # in map tasks and after the shuffle


def test_levels_in_one_pass(local, house, plan, spark):
    rows = [("r1", "c1", "x", 1), ("r1", "c1", "x", 2), ("r1", "c2", "x", 3), ("r2", None, "y", 4), ("r2", None, None, 5)]
    df = local(rows, "region string, country string, who string, n long")
    got = on_levels(df, {"country": ["region", "country"], "region": ["region"], "all": []}, {"n": F.sum("n")}, {"people": "who"})
    assert Counter(map(tuple, got.select("level", "region", "country", "n", "people").collect())) == Counter([
        ("country", "r1", "c1", 3, 1), ("country", "r1", "c2", 3, 1), ("country", "r2", None, 9, 1),
        ("region", "r1", None, 6, 1), ("region", "r2", None, 9, 1), ("all", None, None, 15, 2)])
    text = plan(spark_queries.QUERIES["agg_11_levels"](spark, SF))
    assert sum("FileScan" in x and "net_total" in x for x in text.splitlines()) == 1


def test_numbers_stay_and_bitmaps_merge(local):
    first = bitmaps.numbers(local([("a",), ("b",), ("b",), (None,)], "k string"), "k")
    assert sorted(r.number for r in first.collect()) == [1, 2]
    grown = bitmaps.numbers(local([("c",), ("a",), ("d",)], "k string"), "k", first)
    assert sorted(r.number for r in grown.collect()) == [1, 2, 3, 4] and set(first.collect()) <= set(grown.collect())
    r = Random(1)
    rows = [(r.choice("xy"), r.randrange(5), r.randrange(1, 100_000)) for _ in range(3000)]
    days = bitmaps.bitmaps(local(rows, "g string, day long, number long"), ["g", "day"])
    got = {x.g: x.n for x in bitmaps.distinct_of(days.filter("day < 3"), ["g"], "n").collect()}
    assert got == {g: len({n for h, d, n in rows if h == g and d < 3}) for g in "xy"}


def test_bitmaps_of_few_keys_are_small_and_not_sorted(local, plan):
    rows = [("x", 1), ("x", 64), ("x", 63), ("x", 5_000_000), ("y", 63), ("y", 63)]
    pieces = bitmaps.bitmaps(local(rows, "g string, number long"), ["g"])
    assert sorted((r.g, r.piece) for r in pieces.collect()) == [("x", 0), ("x", 1), ("x", 78125), ("y", 0)]
    assert all(isinstance(r.bits, int) for r in pieces.collect())
    got = bitmaps.distinct_of(pieces, ["g"], "n")
    assert {r.g: r.n for r in got.collect()} == {"x": 4, "y": 1}
    assert "SortAggregate" not in plan(got) and "ObjectHashAggregate" not in plan(got)


def test_distinct_counts_read_no_fact(spark, plan):
    d = Data(spark, SF)
    text = plan(customers.unique_customers(d.gold("customer_days"), d.gold("dim_date"), ["channel_id"], F.col("year_number") == 1996))
    assert "bits" in text and "customer_dim_key" not in text and "net_total" not in text and "sales_month" in text.partition("PartitionFilters: [")[2].partition("]")[0]
