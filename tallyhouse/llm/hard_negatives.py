"""Hard negatives of anchor vectors, found with segment summaries.

A vector is cut into segments, and each keeps its mean and its deviation (the length of what
is left without the mean). For two vectors the products of a segment's means plus or minus the
product of its deviations bound what the segment adds to their inner product. Pairs that the
bounds over few long segments do not decide are bounded again over more and shorter ones, and
what is then still open is scored exactly.

1. Anchors meet the rows of their own label: per block of rows the best are kept, then the
   best of all blocks. These are the positives.
2. Anchors with their positives' scores meet the rows of other labels: a pair matters only if
   its score can lie between the shares ``LEAST`` and ``MOST`` percent of one of those scores
   and among the best seen in the block so far.

Anchors are a stated query set. They meet the rows block by block: a task holds one block of
rows and one of anchors, each of bounded size, and gives at most a few rows an anchor, so a
label with a third of all rows is just more blocks.

Components become floor(256 * x); scores are sums of their products and exact as long as they
fit a double's 53 bits, beyond which they are added up as whole numbers of any size and held within
``LARGEST``, so that shares of them are longs.

Defined results: rows with a null id, label, vector or component, or a component that is not
finite, take no part. Vectors of other lengths are filled up with zeros. Rows that repeat an
id are rows of their own, but none is positive or negative of an anchor with its id, and such
anchors give their pairs once for each distinct vector and label. An anchor without positives
or without negatives gives no rows, nor does an empty table. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept_table, shards_for

POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95  # percent of the positive's score
EVERY = 50  # ids divisible by it are anchors
LEVELS = (1, 4, 16)  # segments of a vector, level by level
ROWS = 1 << 17  # rows of a block
ANCHORS = 1 << 12  # anchors of a block
SPREAD = 16  # blocks of rows at least
STEP, PART = 256, 4096  # anchors and rows of one numpy step
EXACT = 2.0**53
LARGEST = 1 << 56
NOTHING, UNASKED = -(1 << 62), -(1 << 56)  # below every score; the place of a positive that an anchor lacks


def _usable() -> Column:
    """Whether all components are numbers."""
    return F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers, filled up with zeros."""
    flat = column.combine_chunks()
    sizes = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(256.0 * flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(sizes), max(width, 1)))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means, scaled by the root of the segment's length, and deviations of every segment."""
    n, width = vectors.shape
    edges = np.arange(segments) * width // segments
    edges = np.unique(edges)
    sizes = np.diff(np.append(edges, width))
    mean = np.add.reduceat(vectors, edges, axis=1) / sizes
    rest = vectors - np.repeat(mean, sizes, axis=1)
    return mean * np.sqrt(sizes), np.sqrt(np.add.reduceat(rest * rest, edges, axis=1))


def bounds(anchors: tuple[np.ndarray, np.ndarray], rows: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible inner products of all anchors with all rows, a little widened for rounding."""
    middle, reach = anchors[0] @ rows[0].T, anchors[1] @ rows[1].T
    reach += 1e-9 * (np.abs(middle) + reach) + 1e-6
    return middle - reach, middle + reach


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    top = (np.abs(anchors).max(initial=0) + 1) * (np.abs(rows).max(initial=0) + 1) * anchors.shape[1]
    if top < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(anchors).dot(whole(rows).T), -LARGEST, LARGEST).astype(np.int64)


def _survivors(anchors: list, rows: list, open_: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors and rows with open pairs, and which pairs are open, after all levels of bounds.

    ``low`` and ``high`` are the scores that matter to each anchor; a pair whose bounds lie
    outside is closed. Anchors and rows without an open pair are left out of the next level.
    """
    a, r = np.arange(open_.shape[0]), np.arange(open_.shape[1])
    for of_anchors, of_rows in zip(anchors, rows):
        least, greatest = bounds(tuple(x[a] for x in of_anchors), tuple(x[r] for x in of_rows))
        open_ = open_ & (greatest >= low[a][:, None]) & (least <= high[a][:, None])
        keep_a, keep_r = open_.any(axis=1), open_.any(axis=0)
        a, r, open_ = a[keep_a], r[keep_r], open_[np.ix_(keep_a, keep_r)]
        if not len(a):
            break
    return a, r, open_


def _highest(scores: np.ndarray, allowed: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``limit`` highest allowed scores of each row of a matrix, of equal ones the first."""
    left = np.where(allowed, scores, NOTHING)
    line, found = np.arange(len(left)), []
    for _ in range(min(limit, left.shape[1])):
        at = left.argmax(axis=1)
        there = left[line, at] > NOTHING
        if not there.any():
            break
        found.append((line[there], at[there]))
        left[line, at] = NOTHING
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


class _Best:
    """The ``limit`` highest scores of each key seen so far, ties by smaller id."""

    def __init__(self, keys: int, limit: int):
        self.limit, self.size = limit, keys
        self.keys, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, keys: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        keys, ids, scores = (np.concatenate(x) for x in ((self.keys, keys), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, -scores, keys))
        k = keys[order]
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
        rank = np.arange(len(k)) - np.repeat(first, np.diff(np.append(first, len(k))))
        keep = order[rank < self.limit]
        self.keys, self.ids, self.scores = keys[keep], ids[keep], scores[keep]

    def lowest(self) -> np.ndarray:
        """The score that counts no more if it is beaten: the last of each key with ``limit`` of them, else minus infinity."""
        worst = np.full(self.size, np.inf)
        np.minimum.at(worst, self.keys, self.scores.astype(np.float64))
        return np.where(np.bincount(self.keys, minlength=self.size) == self.limit, worst, -np.inf)


class _Block:
    """One block of anchors and one of rows, with the summaries of both."""

    def __init__(self, table: pa.Table):
        side = table.column("is_anchor").to_numpy()
        queries, rows = (table.filter(pa.array(side == k)).sort_by([("vec_id", "ascending")]) for k in (True, False))
        width = max([0, *(t.column("embedding").combine_chunks().value_lengths().to_numpy().max(initial=0) for t in (queries, rows))])
        self.queries, self.rows = queries, rows
        self.q, self.r = _matrix(queries.column("embedding"), width), _matrix(rows.column("embedding"), width)
        self.q_ids, self.r_ids = (t.column("vec_id").to_numpy() for t in (queries, rows))
        self.q_labels, self.r_labels = (t.column("label").to_numpy() for t in (queries, rows))
        self.q_numbers = queries.column("anchor").to_numpy()

    def steps(self):
        """Ranges of rows and, for each, of anchors, numbered, with the summaries of both."""
        asked = self.anchors()
        of_anchors = [[summaries(self.q[anchors], s) for s in LEVELS] for anchors in asked]
        for r in range(0, len(self.r), PART):
            rows = slice(r, r + PART)
            of_rows = [summaries(self.r[rows], s) for s in LEVELS]
            for k, anchors in enumerate(asked):
                yield k, anchors, rows, of_anchors[k], of_rows

    def anchors(self) -> list[slice]:
        return [slice(a, a + STEP) for a in range(0, len(self.q), STEP)]


def _positives(key, table):
    """The best rows of the anchors' own label in one block."""
    block = _Block(table)
    best = [_Best(len(block.q[anchors]), POSITIVES) for anchors in block.anchors()]
    for k, anchors, rows, of_anchors, of_rows in block.steps():
        open_ = (block.q_labels[anchors][:, None] == block.r_labels[rows][None, :]) & (block.q_ids[anchors][:, None] != block.r_ids[rows][None, :])
        a, r, open_ = _survivors(of_anchors, of_rows, open_, best[k].lowest(), np.full(best[k].size, np.inf))  # equal scores stay open: the smaller id wins
        if len(a):
            scores = _scores(block.q[anchors][a], block.r[rows][r])
            i, j = _highest(scores, open_, POSITIVES)
            best[k].add(a[i], block.r_ids[rows][r[j]], scores[i, j])
    return _table(("anchor", "positive_id", "positive_score"), [(block.q_numbers[anchors][b.keys], b.ids, b.scores) for anchors, b in zip(block.anchors(), best)])


def _negatives(key, table):
    """The best rows of other labels in one block for each anchor and positive, within the shares of its score."""
    block = _Block(table)
    given = block.queries.column("positive_scores").to_pylist()
    wanted = np.full((len(given), POSITIVES), UNASKED, np.int64)
    for i, scores in enumerate(given):
        wanted[i, : len(scores)] = scores
    best = [_Best(len(block.q[anchors]) * POSITIVES, NEGATIVES) for anchors in block.anchors()]
    for k, anchors, rows, of_anchors, of_rows in block.steps():
        asked = wanted[anchors]
        real = asked >= 0  # of a score below zero no share lies between the bounds
        low = np.where(real, np.maximum(LEAST * asked / 100.0, best[k].lowest().reshape(asked.shape)), np.inf).min(axis=1)
        high = np.where(real, MOST * asked / 100.0, -np.inf).max(axis=1)
        open_ = (block.q_labels[anchors][:, None] != block.r_labels[rows][None, :]) & (block.q_ids[anchors][:, None] != block.r_ids[rows][None, :])
        a, r, open_ = _survivors(of_anchors, of_rows, open_, low - 1e-6, high + 1e-6)
        if not len(a):
            continue
        scores = _scores(block.q[anchors][a], block.r[rows][r])
        for p in range(POSITIVES):
            least, most = LEAST * asked[a, p][:, None], MOST * asked[a, p][:, None]
            i, j = _highest(scores, open_ & real[a, p][:, None] & (least <= 100 * scores) & (100 * scores <= most), NEGATIVES)
            best[k].add(a[i] * POSITIVES + p, block.r_ids[rows][r[j]], scores[i, j])
    return _table(("anchor", "place", "negative_id", "negative_score"), [
        (block.q_numbers[anchors][b.keys // POSITIVES], b.keys % POSITIVES, b.ids, b.scores) for anchors, b in zip(block.anchors(), best)])


def _table(names: tuple[str, ...], found: list[tuple]) -> pa.Table:
    columns = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(len(names))]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _in_blocks(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int, label: bool) -> DataFrame:
    """Rows and anchors side by side, each pair of blocks in one group.

    With ``label``, a group holds rows and anchors of one label only.
    """
    more = ["label"] if label else []
    numbers = F.array_repeat(F.lit(None).cast("long"), 0)
    row_part, anchor_part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(row_blocks)).cast("int"), F.pmod(F.xxhash64("anchor"), F.lit(anchor_blocks)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("vec_id", "label", "embedding", F.lit(0).cast("long").alias("anchor"), numbers.alias("positive_scores"), F.lit(False).alias("is_anchor"), row_part.alias("_r"), each(anchor_blocks).alias("_a"))
    right = anchors.select("vec_id", "label", "embedding", "anchor", "positive_scores", F.lit(True).alias("is_anchor"), each(row_blocks).alias("_r"), anchor_part.alias("_a"))
    return left.union(right).groupBy("_r", "_a", *more)


def hard_negatives(vectors: DataFrame, shifted_every: int | None = 7) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Labels of rows whose id is divisible by ``shifted_every`` move on by one, modulo 10.
    """
    label = F.col("label").cast("long")
    if shifted_every:
        label = F.when(F.col("vec_id") % shifted_every == 0, (label + 1) % 10).otherwise(label)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(_usable())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), "embedding")
    asked = rows.where(F.col("vec_id") % EVERY == 0).distinct()
    anchors = kept_table(asked.select("*", F.monotonically_increasing_id().alias("anchor"), F.array().cast("array<long>").alias("positive_scores")))
    row_blocks = max(SPREAD, shards_for(rows.count(), ROWS))
    anchor_blocks = shards_for(anchors.count(), ANCHORS)

    near = _in_blocks(rows, anchors, row_blocks, anchor_blocks, True).applyInArrow(_positives, "anchor long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    positives = kept_table(near.select("*", F.row_number().over(order).cast("long").alias("place")).where(F.col("place") <= POSITIVES))
    asking = positives.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"]).alias("positive_scores"))
    asking = anchors.drop("positive_scores").join(asking, "anchor")

    far = _in_blocks(rows, asking, row_blocks, anchor_blocks, False).applyInArrow(_negatives, "anchor long, place long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    best = far.withColumn("place", F.col("place") + 1).select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= NEGATIVES)
    out = best.join(positives, ["anchor", "place"]).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
