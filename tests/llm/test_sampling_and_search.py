"""SimHash groups, resampling and hard negatives against brute force, on hot groups and on messy tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from tallyhouse.llm import hard_negatives, importance_sampling, simhash_dedup
from tallyhouse.llm.queries import ORACLES

SF = "/root/testdata/sf0.001"


def _answer(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return sorted(con.execute(ORACLES[name]).fetchall())


# -- 11 SimHash ---------------------------------------------------------------------------

def _fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    found = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def _groups(bits):
    """For each fingerprint the first one that can be reached."""
    bits, group = np.array(bits, np.uint64), list(range(len(bits)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(bits)):
        for b in (np.flatnonzero(np.bitwise_count(bits[a + 1 :] ^ bits[a]) <= 3) + a + 1).tolist():
            x, y = root(a), root(b)
            group[max(x, y)] = min(x, y)
    return [root(k) for k in range(len(bits))]


def test_fingerprints_and_components_equal_brute_force(docs, texts):
    got = {r.doc_id: r for r in simhash_dedup.near_duplicates(docs).collect()}
    ids = sorted(texts)
    bits = [_fingerprint(texts[i]) for i in ids]
    assert [got[i].fingerprint for i in ids] == [f"{b:016x}" for b in bits]
    assert [got[i].component_id for i in ids] == [ids[k] for k in _groups(bits)]


def test_a_fingerprint_does_not_depend_on_how_a_text_is_cut(monkeypatch, texts):
    some = [t.encode() for t in list(texts.values())[:20]] + [b"a", b"a b", b"", b" \t", b"x" * 500]
    whole = [simhash_dedup.fingerprint(t) for t in some]
    monkeypatch.setattr(simhash_dedup, "PART_BYTES", 40)
    assert [simhash_dedup.fingerprint(t) for t in some] == whole


def _chains(rng, far, near):
    """Far apart fingerprints, and a crowd around one of them that is closed over several steps."""
    crowd = [int(rng.integers(1 << 63))]
    while len(crowd) < near:
        x = crowd[int(rng.integers(len(crowd)))]
        for b in rng.integers(0, 64, int(rng.integers(1, 5))).tolist():
            x ^= 1 << b
        crowd.append(x)
    return list({*crowd, *(int(x) for x in rng.integers(0, 1 << 63, far)), 0})


@pytest.mark.parametrize("classes", [((1 << 24, 4, 1),), ((1 << 24, 5, 2),), ((1 << 24, 6, 3),)])
def test_links_join_what_brute_force_joins(spark, monkeypatch, classes):
    """Every way of cutting keys, with blocks so small that buckets fall into many."""
    monkeypatch.setattr(simhash_dedup, "CLASSES", classes)
    monkeypatch.setattr(simhash_dedup, "BLOCK", 16)
    bits = sorted(_chains(np.random.default_rng(classes[0][1]), 300, 300))
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    links = simhash_dedup.close_links(spark.createDataFrame([(b,) for b in signed], "bits long")).collect()
    at, group = {b: k for k, b in enumerate(signed)}, list(range(len(bits)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for r in links:
        x, y = root(at[r.a]), root(at[r.b])
        group[max(x, y)] = min(x, y)
    assert [root(k) for k in range(len(bits))] == _groups(bits)
    assert len(links) < 20 * len(bits)  # links that join, not all pairs


def test_pivots_discard_what_is_far():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 1 << 63, 4000).astype(np.uint64) for _ in range(2))
    b[:2000] = a[:2000] ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64))
    apart = np.abs(simhash_dedup.pivot_table(a) - simhash_dedup.pivot_table(b)).astype(int)
    distance = np.bitwise_count(a ^ b).astype(int)
    assert (apart.max(axis=0) <= distance).all() and ((apart**2).sum(axis=0) == 64 * distance).all()


def test_simhash_messy(messy, empty):
    rows = simhash_dedup.near_duplicates(messy).collect()
    assert len(rows) == messy.count() and simhash_dedup.near_duplicates(empty).collect() == []
    wordless = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in wordless} >= {None, 1, 2, 3} and {r.component_id for r in wordless} == {1}
    assert {r.component_id for r in rows if r.doc_id in (6, 7, 13)} == {6}


# -- 12 resampling ------------------------------------------------------------------------

def _features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def _resampled(docs, target):
    found = [(i, *_features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in _features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for i, n, f in found:
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in f]
        weight = sum(gains) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: 25 * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_resampling_equals_brute_force(spark, docs, texts):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = sorted((tuple(r) for r in importance_sampling.resample(docs, target).collect()), key=str)
    assert rows == _resampled(list(texts.items()), [r.text for r in target.collect()])
    assert sorted(rows) == _answer("op12_head_tail_resampling")


def test_every_head_gives_the_same_buckets(monkeypatch, texts):
    """No head, a small one and a full one; long texts in parts."""
    some = [t.encode() for t in texts.values()][:30] + ["É naïve 中文 x1".encode(), b"", b"one"]
    words = Counter(w for t in some for w in importance_sampling.words_of(t))
    top = [w for w, _ in words.most_common()]
    want = [sorted(_features(t.decode())[1]) for t in some]
    for n in (0, 7, len(top)):
        head = importance_sampling.Head(top[:n], [(a, b) for a in range(min(n, 40)) for b in range(min(n, 40))])
        for size in (1 << 21, 64):
            monkeypatch.setattr(importance_sampling, "HELD_BYTES", size)
            got = [sorted(b for ws, doc, old in importance_sampling._word_lists([t]) for b in head.features(ws, doc, old)[0].tolist()) for t in some]
            assert got == want


def test_resampling_messy(spark, messy, empty):
    target = spark.createDataFrame([(1, "one two three"), (2, None)], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in messy.collect()]
    rows = sorted((tuple(r) for r in importance_sampling.resample(messy, target).collect()), key=str)
    assert [r[:4] for r in rows] == [r[:4] for r in _resampled(docs, ["one two three", None])]
    assert sorted(r[4] for r in rows if r[4]) == [1] and importance_sampling.resample(empty, target).collect() == []
    assert importance_sampling.resample(messy, target.limit(0)).count() == len(docs)


# -- 13 hard negatives --------------------------------------------------------------------

def _mined(rows):
    rows = [(i, (k + 1) % 10 if i % 7 == 0 else k, [math.floor(256 * x) for x in v]) for i, k, v in rows]
    out = []
    for i, k, v in rows:
        if i % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows if j != i]
            for ps, p, _ in sorted(s for s in scores if s[2] == k)[:5]:
                fit = [(j, -s) for s, j, other in sorted(scores) if other != k and 50 * -ps <= 100 * -s <= 95 * -ps][:3]
                out += [(i, p, n + 1, j, -ps, s) for n, (j, s) in enumerate(fit)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = sorted(tuple(r) for r in hard_negatives.hard_negatives(vectors).collect())
    assert rows == _mined([(r.vec_id, r.label, r.embedding) for r in vectors.collect()]) == _answer("op13_segment_hard_negatives") and rows


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(2)
    a, b = np.floor(rng.normal(20, 60, (40, 30))), np.floor(rng.normal(-5, 60, (50, 30)))
    exact, width = a @ b.T, np.inf
    for segments in hard_negatives.LEVELS:
        least, greatest = hard_negatives.bounds(hard_negatives.summaries(a, segments), hard_negatives.summaries(b, segments))
        assert (least <= exact).all() and (exact <= greatest).all() and (greatest - least).mean() < width
        width = (greatest - least).mean()


def test_hard_negatives_with_a_hot_label_and_ties(spark, monkeypatch):
    """Two thirds of the rows in one label, equal vectors, scores below zero, many blocks on both sides."""
    monkeypatch.setattr(hard_negatives, "ROWS", 50)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    rng = np.random.default_rng(5)
    base = rng.normal(0, 0.2, (30, 8))
    rows = [(i * 10, 1 if i % 3 else int(rng.integers(10)), [float(x) for x in np.float32(base[rng.integers(30)])]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives(df).collect()) == _mined(rows)


def test_hard_negatives_messy(spark):
    good = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.9, 1.0]), (3, 2, [0.5, 0.5, 9.0]), (50, 4, [1.0])]
    bad = [(None, 1, [1.0, 2.0]), (4, None, [1.0, 2.0]), (5, 1, None), (6, 1, [1.0, None]), (8, 1, [float("nan"), 2.0]), (9, 1, [float("inf"), 1.0])]
    df = spark.createDataFrame([(*r, "x", 3) for r in good + bad], "vec_id long, label int, embedding array<double>, anchor string, rank int")
    want = _mined([(i, k, v + [0.0] * (3 - len(v))) for i, k, v in good])
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives(df).collect()) == want and want
    assert hard_negatives.hard_negatives(df.limit(0)).collect() == []
    huge = spark.createDataFrame([(0, 1, [1e30]), (1, 1, [1e30]), (2, 2, [7e29]), (50, 5, [])], "vec_id long, label int, embedding array<double>")
    assert [r.positive_score for r in hard_negatives.hard_negatives(huge).collect()] in ([], [1 << 56])
