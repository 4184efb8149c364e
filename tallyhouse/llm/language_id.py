"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its subwords: byte n-grams of two to four letters,
word borders included, and whole words, all hashed into a fixed number of buckets. Embeddings
and softmax are trained by stochastic gradient descent in numpy on a bounded sample of
labelled documents. A part of the sample is kept back to fit a temperature and the score
below which a prediction counts as rejected.

The sample is the only thing fitted on less than all rows; its bound is ``PER_LANGUAGE``.
Prediction reads every whole text, partition by partition, with a model of fixed size.

Defined results: null text, and text without a letter, is ``und`` with score 0. Without any
labelled row that has a letter nothing is learned and every text is ``und``; a language with
no such row is not learned. Null ids count as empty text for
the fold. Equal rows get equal results. An empty table gives an empty result; other columns
of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import binary_texts, crc_of_id, mix, passes, prefix_hashes, span_hashes

BUCKETS = 1 << 16
DIMENSIONS = 16
PER_LANGUAGE = 800  # training documents of a language, those with the smallest hashed ids
AMPLE = 4  # a language sends so many times its sample to be ranked
BROADCAST_LANGUAGES = 1000  # up to so many languages the ids of the sample are broadcast
EPOCHS, LEAST_STEPS, RATE = 6, 8000, 2.0
CROP = 40  # subwords of the shortest crop that training sees
KEPT_BACK = 5  # one in so many sampled documents calibrates
PRECISION = 0.995  # of the accepted predictions on those

_LETTER = np.full(256, 32, np.uint8)  # bytes that are no letters become word borders
_LETTER[128:] = np.arange(128, 256)
_LETTER[97:123] = _LETTER[65:91] = np.arange(97, 123)
_SALT = mix(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)


def subwords(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of documents: first, last, and the document and bucket of every subword."""
    for first, last in passes(texts):
        sizes = [len(t) + 1 for t in texts[first:last]]
        data = _LETTER[np.frombuffer(b" " + b" ".join(texts[first:last]) + b" ", np.uint8)]
        owner = np.repeat(np.arange(last - first, dtype=np.int32), sizes)
        owner = np.append(owner, owner[-1:])
        space = data == 32
        gram = data.astype(np.uint64)
        docs, buckets = [], []
        inner = np.zeros(len(data), np.int32)  # spaces strictly inside the gram that starts here
        letters = (~space).astype(np.int32)
        for n in (2, 3, 4):
            count = len(data) - n + 1
            if count <= 0:
                break
            gram = gram[:count] | data[n - 1 :].astype(np.uint64) << np.uint64(8 * (n - 1))
            letters = letters[:count] + ~space[n - 1 :]
            if n > 2:
                inner = inner[:count] + space[n - 2 : len(data) - 1]
            else:
                inner = inner[:count]
            real = np.flatnonzero((inner == 0) & (letters > 0))
            docs.append(owner[real])
            buckets.append((gram[real] * _SALT[n] >> np.uint64(48)).astype(np.int32))
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = edge[::2], edge[1::2]
        if len(starts):
            docs.append(owner[starts])
            buckets.append((span_hashes(prefix_hashes(data), starts, ends) >> np.uint64(48)).astype(np.int32))
        yield first, last, np.concatenate(docs) if docs else np.zeros(0, np.int32), np.concatenate(buckets) if buckets else np.zeros(0, np.int32)


@dataclass
class Model:
    """Contribution of every bucket to every language's score, and the calibration."""

    languages: list[str]
    table: np.ndarray  # languages x buckets
    bias: np.ndarray
    temperature: float = 1.0
    least_score: float = 0.0

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        logits = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)


def fold(column: str = "doc_id") -> Column:
    return F.pmod(crc_of_id(column), F.lit(4))


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets and their counts: at most ``BUCKETS`` numbers a document."""
    for batch in batches:
        for first, last, docs, buckets in subwords(binary_texts(batch.column("text"))):
            pairs, counts = np.unique(docs.astype(np.int64) * BUCKETS + buckets, return_counts=True)
            borders = np.searchsorted(pairs, np.arange(last - first + 1) * BUCKETS)
            spans = list(zip(borders, borders[1:]))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(first, last - first), batch.column("lang").slice(first, last - first),
                pa.array([(pairs[a:b] % BUCKETS).astype(np.uint16).tobytes() for a, b in spans], pa.binary()),
                pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in spans], pa.binary())], names=["doc_id", "lang", "buckets", "counts"])


def sampled(docs: DataFrame) -> DataFrame:
    """Labelled documents of the training fold, at most ``PER_LANGUAGE`` of each language."""
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text", "cast(lang as string) lang")
    train = docs.where((fold() != 2) & F.col("lang").isNotNull())
    few = train.agg(F.count_distinct("lang")).first()[0] <= BROADCAST_LANGUAGES
    small = F.broadcast if few else lambda df: df
    # the first rows by hash all lie below this bound but for odds of nothing, so a frequent language sends few rows to its window
    counts = train.groupBy("lang").agg((F.count(F.lit(1)) / F.lit(AMPLE * PER_LANGUAGE)).alias("_times"))
    share = (F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5) * F.col("_times")
    near = train.select("doc_id", "lang").join(small(counts), "lang").where((F.col("_times") <= 1) | (share <= 1)).select("doc_id", "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = near.withColumn("_rank", rank).where(F.col("_rank") <= PER_LANGUAGE).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
    return train.join(small(ids), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")


def train(docs: DataFrame, seed: int = 7) -> Model:
    """A model from a bounded sample of ``docs``; the driver sees bucket counts, not texts."""
    rows = sampled(docs).mapInArrow(_profiles, "doc_id long, lang string, buckets binary, counts binary").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], -1 if r["doc_id"] is None else r["doc_id"], r["buckets"]))
    rows = [r for r in rows if r["buckets"]]  # the others have no letter to learn from
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    examples = [(languages.index(r["lang"]), np.frombuffer(r["buckets"], np.uint16), np.frombuffer(r["counts"], np.uint32)) for r in rows]
    held = [e for i, e in enumerate(examples) if i % KEPT_BACK == 0]
    shown = [e for i, e in enumerate(examples) if i % KEPT_BACK] or held
    rng = np.random.default_rng(seed)
    embeddings = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    weights, bias = np.zeros((len(languages), DIMENSIONS)), np.zeros(len(languages))
    epochs = max(EPOCHS, -(-LEAST_STEPS // len(shown)))  # a small sample is gone through more often
    steps, step = epochs * len(shown), 0
    for _ in range(epochs):
        for k in rng.permutation(len(shown)):
            label, buckets, counts = shown[k]
            buckets, counts = cropped(buckets, counts, rng)
            rate = RATE * (1 - step / steps)
            share = counts / counts.sum()
            mean = share @ embeddings[buckets]
            logits = weights @ mean + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            pull = error @ weights
            weights -= rate * np.outer(error, mean)
            bias -= 0.1 * rate * error
            embeddings[buckets] -= rate * np.outer(share, pull)
            step += 1
    model = Model(languages, (weights @ embeddings.T).astype(np.float32), bias)
    if held:
        calibrate(model, [(label, *cropped(b, c, rng)) for label, b, c in held for _ in range(3)])
    return model


def cropped(buckets: np.ndarray, counts: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """All of a text's subwords or a random number of them, so that short texts are learned too."""
    total = int(counts.sum())
    if total <= CROP or rng.random() < 0.3:
        return buckets, counts
    size = int(np.exp(rng.uniform(np.log(CROP), np.log(min(total, 5000)))))
    some = rng.multinomial(size, counts / total)
    return buckets[some > 0], some[some > 0]


def calibrate(model: Model, examples: list) -> None:
    """Temperature of the least log loss, then the least score at which the accepted are precise enough."""
    labels = np.array([e[0] for e in examples])
    sums = np.array([model.table[:, b] @ c for _, b, c in examples])
    counts = np.array([c.sum() for *_, c in examples])

    def loss(t):
        model.temperature = t
        return -np.log(np.maximum(model.probabilities(sums, counts)[np.arange(len(labels)), labels], 1e-12)).mean()
    model.temperature = min(np.geomspace(0.05, 20, 61), key=loss)
    p = model.probabilities(sums, counts)
    best, right = p.max(axis=1), p.argmax(axis=1) == labels
    order = np.argsort(-best, kind="stable")
    precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= PRECISION
    model.least_score = float(best[order][np.flatnonzero(precise)[-1]]) if precise.any() else 1.0


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def _predictor(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_texts(batch.column("text"))
            labels, scores = [None] * len(texts), [0.0] * len(texts)
            for first, last, docs, buckets in subwords(texts) if model.languages else ():
                size = last - first
                counts = np.bincount(docs, minlength=size)
                sums = np.stack([np.bincount(docs, row[buckets], size) for row in model.table], axis=1)
                p = model.probabilities(sums, counts)
                best = p.argmax(axis=1)
                for k in np.flatnonzero(counts):
                    labels[first + k], scores[first + k] = model.languages[best[k]], float(p[k, best[k]])
            for k, text in enumerate(texts):
                if labels[k] is None or (text.isascii() is False and not _has_letter(text)):
                    labels[k], scores[k] = "und", 0.0
            rejected = [x == "und" or s < model.least_score for x, s in zip(labels, scores)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(labels, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])
    return predict


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Predicted language of every row: the likeliest learned one, its probability, and whether it is rejected."""
    model = train(docs) if model is None else model
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").withColumn("held_out", fold() == 2)
    return rows.mapInArrow(_predictor(model), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
