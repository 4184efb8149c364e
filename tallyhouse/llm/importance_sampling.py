"""Resampling towards a target distribution, by hashed word and word-pair features.

Every run of one or two consecutive words of a text is a feature; the CRC-32 of its bytes names
one of ``BUCKETS`` buckets. A bucket's gain is the logarithm of how much more often the target
texts have it than the corpus, a document's weight the mean gain of its features, and documents
are drawn without replacement by adding Gumbel noise taken from a hash of the id.

The vocabulary has a head and a tail. Frequent words are broadcast with the CRC state after the
word, from which the CRC of a pair goes on without reading the first word again, and frequent
pairs of them with their bucket. What is not in the head takes its CRC directly. Both ways give
the same bucket, so the totals are exact whichever words are in the head, and the head's sizes,
``HEAD_WORDS`` and ``HEAD_PAIRS``, bound what is broadcast.

1. Words are counted over all texts; then pairs of frequent words, each task leaving out those
   it met once, since which pairs are in the head decides on time only.
2. One pass over the texts writes every document's buckets with their counts, and each task's
   bucket totals.
3. Totals become gains, gains become weights, and the documents with the highest scores are
   drawn; ranks are counted through a sort by ranges, not in one task.

Defined results: null, empty and wordless texts have no features and weight 0; long texts are
read in parts, with the pairs across them. The noise of a null id is that of empty text. Rows that repeat an id are all
returned, ties go to the smaller id, null first. An empty table gives an empty result, an
empty target only makes gains equal to the corpus's own. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept_table, text_parts, text_ranges

BUCKETS = 10_000
HEAD_WORDS = 1 << 15
HEAD_PAIRS = 1 << 17
FLUSH = 1 << 18  # distinct words or pairs that a task counts before it passes them on
HELD_BYTES = 1 << 21  # bytes of texts held as words at a time
LEAST_WORDS = 20
PERCENT = 25
SEED = 7

_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters (A-Z lower-cased) and all beyond ASCII."""
    return text.translate(_WORD_BYTES).split()


class Head:
    """Numbers and CRC states of frequent words, and buckets of frequent pairs of them."""

    def __init__(self, words: list[bytes], pairs: list[tuple[int, int]]):
        self.number = {w: k for k, w in enumerate(words)}
        self.size = len(words)
        self.states = np.array([zlib.crc32(w + b" ") for w in words], np.uint32)
        self.buckets = np.array([zlib.crc32(w) % BUCKETS for w in words], np.int64)
        found = sorted((a * self.size + b, zlib.crc32(words[b], int(self.states[a])) % BUCKETS) for a, b in pairs)
        self.pairs = np.array([k for k, _ in found], np.int64)
        self.pair_buckets = np.array([b for _, b in found], np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words, -1 for those of the tail."""
        return np.fromiter(map(self.number.get, words, (-1 for _ in words)), np.int64, len(words))

    def features(self, words: list[bytes], doc: np.ndarray, old: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all features of some documents' words, and the document of each.

        The first ``old`` words only begin pairs.
        """
        at = self.numbers(words)
        single = np.empty(len(words), np.int64)
        head = at >= 0
        single[head] = self.buckets[at[head]]
        for k in np.flatnonzero(~head).tolist():
            single[k] = zlib.crc32(words[k]) % BUCKETS
        first = np.flatnonzero(doc[1:] == doc[:-1])
        a, b = at[first], at[first + 1]
        both = (a >= 0) & (b >= 0)
        key = np.where(both, a * self.size + b, -1)
        place = np.minimum(np.searchsorted(self.pairs, key), max(0, len(self.pairs) - 1))
        known = both & (self.pairs[place] == key) if len(self.pairs) else np.zeros(len(first), bool)
        double = np.empty(len(first), np.int64)
        double[known] = self.pair_buckets[place[known]]
        rest = np.flatnonzero(~known)
        states, crc = self.states, zlib.crc32
        double[rest] = [crc(words[k + 1], int(states[n])) if n >= 0 else crc(words[k] + b" " + words[k + 1]) for k, n in zip(first[rest].tolist(), a[rest].tolist())]
        double[rest] %= BUCKETS
        return np.concatenate([single[old:], double]), np.concatenate([doc[old:], doc[first]])


def _word_lists(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
    """Words of some texts in order, the text of each, and how many of them the part before ended with.

    A long text comes in parts, each of which begins with the last word of the one before.
    """
    if len(texts) > 1 or not texts or len(texts[0]) <= HELD_BYTES:
        lists = [words_of(t) for t in texts]
        yield [w for ws in lists for w in ws], np.repeat(np.arange(len(texts)), [len(ws) for ws in lists]), 0
        return
    last: list[bytes] = []
    for part in text_parts(texts[0], HELD_BYTES):
        words = last + words_of(part)
        yield words, np.zeros(len(words), np.int64), len(last)
        last = words[-1:]


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
    for batch in batches:
        for _, texts in text_ranges(batch.column("text"), HELD_BYTES):
            for words, _, old in _word_lists(texts):
                counts.update(words[old:])
                if len(counts) >= FLUSH:
                    yield out()
                    counts.clear()
    yield out()


def _counted_pairs(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        counts: Counter = Counter()

        def out():
            found = {p: n for p, n in counts.items() if n > 1}
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())], names=["pair", "n"])
        for batch in batches:
            for _, texts in text_ranges(batch.column("text"), HELD_BYTES):
                for words, doc, _ in _word_lists(texts):
                    at = head.numbers(words)
                    a, b = at[:-1], at[1:]
                    both = (a >= 0) & (b >= 0) & (doc[1:] == doc[:-1])
                    pairs, n = np.unique(a[both] * head.size + b[both], return_counts=True)
                    for p, k in zip(pairs.tolist(), n.tolist()):
                        counts[p] += k
                    if len(counts) >= FLUSH:
                        yield out()
                        counts.clear()
        yield out()
    return count


def _most_frequent(counts: DataFrame, name: str, limit: int) -> list:
    """At most ``limit`` values of ``name`` with the highest counts, in order of the value.

    Counts fall into steps of an eighth of a power of two; whole steps are taken from the top,
    so that one small histogram decides and no task sorts or passes on more than is taken.
    """
    counts = kept_table(counts)
    step = F.floor(8 * F.log2("n")).alias("step")
    taken, least = 0, None
    for r in sorted(counts.groupBy(step).agg(F.count(F.lit(1)).alias("rows")).collect(), reverse=True):  # some hundred rows
        if taken + r["rows"] > limit:
            break
        taken, least = taken + r["rows"], r["step"]
    return [] if least is None else sorted(r[0] for r in counts.where(step >= least).select(name).collect())


def frequent(docs: DataFrame, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS) -> Head:
    """The head of the vocabulary: at most ``words`` words and ``pairs`` pairs of them, by their counts."""
    spark = docs.sparkSession
    counts = docs.select("text").mapInArrow(_counted_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    head = Head([bytes(w) for w in _most_frequent(counts, "word", words)], [])
    if not head.size:
        return head
    shared = spark.sparkContext.broadcast(head)
    counts = docs.select("text").mapInArrow(_counted_pairs(shared), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    top = _most_frequent(counts, "pair", pairs)
    shared.unpersist()
    return Head(list(head.number), [divmod(p, head.size) for p in top])


def _bucketed(shared):
    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document, and one with the task's totals."""
        head, totals = shared.value, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for first, texts in text_ranges(batch.column("text"), HELD_BYTES):
                n, n_words, key, times = len(texts), 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
                for words, doc, old in _word_lists(texts):
                    buckets, of = head.features(words, doc, old)
                    totals += np.bincount(buckets, minlength=BUCKETS)
                    n_words = n_words + np.bincount(doc[old:], minlength=n)
                    found, count = np.unique(of * BUCKETS + buckets, return_counts=True)
                    key, at = np.unique(np.concatenate([key, found]), return_inverse=True)
                    times = np.bincount(at, np.concatenate([times, count]), len(key)).astype(np.int64)
                ends = np.searchsorted(key, np.arange(1, n + 1) * BUCKETS)
                spans = list(zip([0, *ends[:-1].tolist()], ends.tolist()))
                names, counts, of = (key % BUCKETS).astype("<u2"), times.astype("<u4"), key // BUCKETS
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, n), pa.array(n_words, pa.int64()), pa.array(np.bincount(of, times, n).astype(np.int64)),
                    pa.array([names[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()), pa.nulls(n, pa.list_(pa.int64()))], names=_BUCKETED_NAMES)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())), pa.array([totals], pa.list_(pa.int64()))], names=_BUCKETED_NAMES)
    return bucket


_BUCKETED = "doc_id long, n_words long, n_features long, buckets binary, times binary, totals array<long>"
_BUCKETED_NAMES = [f.split()[0] for f in _BUCKETED.split(", ")]


def bucketed(texts: DataFrame, shared) -> tuple[DataFrame, np.ndarray]:
    """Documents with their buckets, as a written table, and the totals of all buckets."""
    found = kept_table(texts.mapInArrow(_bucketed(shared), _BUCKETED))
    totals = np.zeros(BUCKETS, np.int64)
    sums = found.where("totals is not null").select(F.posexplode("totals").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.where("n > 0").collect():  # one row a bucket at most
        totals[r["bucket"]] = r["n"]
    return found.where("totals is null").drop("totals"), totals


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """How much more often the target has a bucket, in thousandths of a natural logarithm, rounded down."""
    s_all, t_all = int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS)))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weighed(shared):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            sums = [int((gain[np.frombuffer(b.as_buffer(), "<u2")] * np.frombuffer(t.as_buffer(), "<u4").astype(np.int64)).sum()) for b, t in zip(batch.column("buckets"), batch.column("times"))]
            weights = [s // n if n else 0 for s, n in zip(sums, batch.column("n_features").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), batch.column("n_features"), pa.array(weights, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])
    return weigh


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``place``, 1 for the highest score; sorted by ranges, each range numbered from where the others before it end."""
    ordered = rows.orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    kept = kept_table(ordered.select("*", F.monotonically_increasing_id().alias("_at")))
    part, inner = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r["part"], r["n"]) for r in kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # one row a range
    before, starts = 0, []
    for p, n in counts:
        starts.append((p, before))
        before += n
    starts = rows.sparkSession.createDataFrame(starts, "_part long, _before long")
    return kept.withColumn("_part", part).join(F.broadcast(starts), "_part").select(*rows.columns, (F.col("_before") + inner + 1).alias("place"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` of every row of ``docs``.

    ``rank`` counts the drawn documents, ``percent`` of those with ``LEAST_WORDS`` words or
    more, from the highest score; it is null for the others.
    """
    spark = docs.sparkSession
    texts = lambda df, name: df.select(name.alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs, target = texts(docs, F.col("doc_id").cast("long")), texts(target, F.lit(None).cast("long"))
    shared = spark.sparkContext.broadcast(frequent(docs))
    found, corpus_totals = bucketed(docs, shared)
    _, target_totals = bucketed(target, shared)
    gain = spark.sparkContext.broadcast(gains(corpus_totals, target_totals))
    weighed = found.mapInArrow(_weighed(gain), "doc_id long, n_words long, n_features long, weight long")
    number = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((number + 0.5) / 4294967296.0)))
    scored = kept_table(weighed.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score")))
    enough = F.col("n_words") >= LEAST_WORDS
    ranked = _ranked(scored.where(enough))
    drawn = percent * scored.where(enough).count() // 100
    ranked = ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))
    rest = scored.where(~enough).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.union(rest)
