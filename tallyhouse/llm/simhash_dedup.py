"""Near-duplicate groups by SimHash, with pivot distance tables for the search of close pairs.

A fingerprint has 64 bits: a bit is 1 where more than half of the hashed shingles have it. Two
fingerprints are linked at ``DISTANCE`` or fewer differing bits.

Reference fingerprints (pivots) are the 64 rows of the Walsh-Hadamard matrix. The table of a
fingerprint holds its Hamming distances to all of them. Distances to one pivot differ by no
more than the fingerprints do, so a pair whose tables differ by more than ``DISTANCE`` anywhere
is discarded. The squares of the differences to these 64 pivots add up to 64 times the distance
of the pair, so what survives all of them differs in at most DISTANCE ** 2 bits; it is verified
on the bits themselves.

1. Equal fingerprints are one class from the start, however many documents share them.
2. Of 4, 5 or 6 pieces of the bits, 1, 2 or 3 must be equal in a linked pair: each choice of
   such pieces gives buckets. More classes take longer keys, with the same links.
3. Each bucket's members are compared with its hub, the smallest of them, one comparison each.
   This joins nearly all of a large group of near copies; the components so far are labels.
4. Buckets with several labels go on: members outside the most frequent label are compared with
   all members through the tables, sorted by the distance to the first pivot so that only a
   window of the others is looked at. A bucket is cut into blocks on both sides, so a task
   holds a bounded number of rows; it returns links that join labels, no pairs.

Defined results: texts that are null, empty or without words have fingerprint zero and are
linked like any other; texts of fewer than three words have one shingle; long texts are taken
in parts. Rows that repeat an id are all returned, a null id names no component unless all
members lack ids; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept_table, shards_for, text_parts, text_ranges
from tallyhouse.llm.components import components

SHINGLE, SEED = 3, 42
DISTANCE = 3
PART_BYTES = 1 << 20  # bytes of a text whose words are held at a time
HELD_BYTES = 1 << 22  # bytes of texts held as objects at a time
BLOCK = 2048  # members of one side of a block
SHARD_ROWS = 1 << 16  # rows of a task
MEETINGS = 1 << 20  # pairs that one numpy step looks at
CLASSES = ((1 << 24, 4, 1), (1 << 33, 5, 2), (1 << 63, 6, 3))  # up to so many classes: pieces, and how many of them are equal

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PLACES = np.arange(64, dtype=np.uint64)
PIVOTS = np.array([sum(1 << i for i in range(64) if (k & i).bit_count() & 1) for k in range(64)], np.uint64)


def _hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, repeats included, part by part."""
    last: list[bytes] = []
    count = 0
    for part in text_parts(text, PART_BYTES):
        words = last + part.translate(_LOWER).split()
        count += len(words) - len(last)
        if len(words) >= SHINGLE:
            shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
            yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - SHINGLE + 1)
        last = words[max(0, len(words) - SHINGLE + 1) :]
    if 0 < count < SHINGLE:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(last), SEED)], np.uint64)


def fingerprint(text: bytes) -> int:
    """The 64-bit SimHash of a text."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in _hashes(text):
        total += len(hashes)
        for a in range(0, len(hashes), 1 << 14):
            bits = np.unpackbits(hashes[a : a + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
    return int(((2 * ones > total).astype(np.uint64) << _PLACES).sum()) if total else 0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in text_ranges(batch.column("text"), HELD_BYTES):
            found = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), pa.array(found)], names=["doc_id", "bits"])


def masks(pieces: int, equal: int) -> list[int]:
    """For each choice of ``equal`` of ``pieces`` pieces of the 64 bits, a signed number with those bits set."""
    edges = [64 * k // pieces for k in range(pieces + 1)]
    piece = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [(sum(chosen) ^ (1 << 63)) - (1 << 63) for chosen in combinations(piece, equal)]


def pivot_table(bits: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints to the pivots, one row a pivot."""
    return np.stack([np.bitwise_count(bits ^ p) for p in PIVOTS]).astype(np.int8)


def close_labels(group: np.ndarray, bits: np.ndarray, labels: np.ndarray, asks: np.ndarray, member: np.ndarray) -> list[tuple[int, int]]:
    """Links that join labels: rows that ask against members of the same group, ``DISTANCE`` bits apart or fewer."""
    _, of = np.unique(group, return_inverse=True)
    table = pivot_table(bits)
    key = of * 128 + table[0]  # distances are 64 at most, so groups stay apart
    order = np.argsort(key, kind="stable")
    bits, labels, asks, member, key, table = bits[order], labels[order], asks[order], member[order], key[order], table[:, order]
    left, right = np.flatnonzero(asks), np.flatnonzero(member)
    lo = np.searchsorted(key[right], key[left] - DISTANCE)
    count = np.searchsorted(key[right], key[left] + DISTANCE, side="right") - lo
    steps = np.cumsum(count)
    joined: dict[int, int] = {}

    def root(x):
        while x in joined:
            x = joined[x]
        return x
    links, first = [], 0
    while first < len(left):
        last = max(first + 1, int(np.searchsorted(steps, (steps[first - 1] if first else 0) + MEETINGS, side="right")))
        n = count[first:last]
        i = np.repeat(left[first:last], n)
        j = right[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[first:last], n)]
        once = (labels[i] != labels[j]) & ((i < j) | ~(asks[j] & member[i]))
        i, j = i[once], j[once]
        for distances in table[1:]:
            if not len(i):
                break
            near = np.abs(distances[i] - distances[j]) <= DISTANCE
            i, j = i[near], j[near]
        near = np.bitwise_count(bits[i] ^ bits[j]) <= DISTANCE
        pairs = np.unique(np.stack([labels[i[near]], labels[j[near]]], 1), axis=0)
        for x, y in pairs.tolist():
            a, b = root(x), root(y)
            if a != b:
                joined[max(a, b)] = min(a, b)
                links.append((x, y))
        first = last
    return links


def _compared(key, table):
    group, bits, label, asks, member = (table.column(c).to_numpy() for c in ("group", "bits", "label", "asks", "member"))
    links = close_labels(group, bits.view(np.uint64), label, asks, member)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def close_links(classes: DataFrame) -> DataFrame:
    """Links (a, b) that join all of the distinct fingerprints ``bits`` with others close to them."""
    pieces, equal = next((p, e) for most, p, e in CLASSES if classes.count() <= most)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("bits").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks(pieces, equal))]))
    keyed = classes.select("bits", keys.alias("_k")).select("bits", "_k.choice", "_k.part")
    buckets = keyed.groupBy("choice", "part").agg(F.count(F.lit(1)).alias("_n"), F.min("bits").alias("hub")).where("_n > 1")
    members = kept_table(keyed.join(buckets, ["choice", "part"]))
    apart = F.bit_count(F.col("bits").bitwiseXOR(F.col("hub")))
    stars = kept_table(members.where((F.col("bits") != F.col("hub")) & (apart <= DISTANCE)).select(F.col("hub").alias("a"), F.col("bits").alias("b")).distinct())

    labels = components(stars).select(F.col("id").alias("bits"), F.col("root").alias("label"))
    labelled = kept_table(members.join(labels, "bits", "left").select("choice", "part", "bits", F.coalesce("label", "bits").alias("label")))
    counts = labelled.groupBy("choice", "part", "label").agg(F.count(F.lit(1)).alias("_n"))
    top = F.max(F.struct("_n", "label"))
    open_ = counts.groupBy("choice", "part").agg(F.count(F.lit(1)).alias("_labels"), F.sum("_n").alias("_n"), top["label"].alias("_top"), top["_n"].alias("_most")).where("_labels > 1")
    sides = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    rows = labelled.join(open_, ["choice", "part"]).select(
        "choice", "part", "bits", "label", (F.col("label") != F.col("_top")).alias("_minor"), sides(F.col("_n")).alias("_i"), sides(F.col("_n") - F.col("_most")).alias("_j"))
    spot = lambda n: F.pmod(F.xxhash64("bits"), n).cast("int")
    each = lambda n: F.sequence(F.lit(0), n - 1)
    block = lambda i, j, asks, member: F.struct(i.alias("i"), j.alias("j"), F.lit(asks).alias("asks"), F.lit(member).alias("member"))
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("_minor").alias("asks"), F.lit(True).alias("member")))
    asking = F.when(F.col("_minor"), F.transform(each(F.col("_i")), lambda i: block(i, spot(F.col("_j")), True, False))).otherwise(F.array())
    asked = F.transform(each(F.col("_j")), lambda j: block(spot(F.col("_i")), j, False, True))
    spread = rows.select("*", F.explode(F.when((F.col("_i") == 1) & (F.col("_j") == 1), one).otherwise(F.concat(asked, asking))).alias("_b"))
    spread = spread.select(F.xxhash64("choice", "part", "_b.i", "_b.j").alias("group"), "bits", "label", "_b.asks", "_b.member")
    shards = shards_for(open_.agg(F.sum("_n")).first()[0] or 0, SHARD_ROWS)
    links = spread.groupBy(F.pmod(F.col("group"), F.lit(shards)).alias("_shard")).applyInArrow(_compared, "a long, b long")
    return stars.union(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, ``class_size`` of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = kept_table(docs.mapInArrow(_fingerprints, "doc_id long, bits long"))
    classes = kept_table(prints.groupBy("bits").agg(F.min("doc_id").alias("_id"), F.count(F.lit(1)).alias("class_size")))
    roots = components(close_links(classes.select("bits"))).withColumnRenamed("id", "bits")
    named = classes.join(roots, "bits", "left").select("bits", "_id", "class_size", F.coalesce("root", "bits").alias("_root"))
    least = named.groupBy("_root").agg(F.min("_id").alias("component_id"))
    named = named.join(least, "_root").select("bits", "component_id", "class_size")
    return prints.join(named, "bits").select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id", "class_size")
