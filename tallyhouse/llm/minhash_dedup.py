"""Near-duplicate groups by SuperMinHash signatures, banding, exact checks and components.

Each element of a document's set (a hashed five-word shingle) offers one value to every
register: along its own random permutation it offers rank j plus a uniform fraction to the
j-th register visited. Ranks of one element are therefore all different, which lowers the
variance of the estimate against independent hashes. Registers keep minima, so elements
whose rank already exceeds every register's value need not be looked at any further; here
that stop is applied rank by rank to whole documents.

Defined results: null, empty and wordless texts have an empty set, are linked with nothing
and keep their own id. Equal sets form one class from the start. Rows that repeat a doc_id
are all returned. A null doc_id never names a component unless all of its members lack ids.
An empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import hashed_words, kept_table, keyed, mix, passes, text_ranges
from tallyhouse.llm.components import components

SHINGLE = 5
PERCENT = 85
STAGE_PERCENT = 80  # what the stage of the pipeline takes as alike
ROWS = 5  # registers of a band
REGISTERS, BANDS = 120, 24  # a pair at 0.85 is missed once in a million
STAGE_BANDS = 35  # and so is a pair at 0.80
GROUP = 256  # members compared with one hub in one group
BLOCK = 256  # members of one side of a block comparison
MEETINGS = 1 << 22  # equal elements that one vectorised step of a block comparison takes
ELEMENTS = 1 << 16  # elements of one vectorised signature step
STEP_BYTES = 1 << 19  # bytes of text of one vectorised shingle step
HELD_BYTES = 1 << 22  # bytes of text held as objects at a time

_TIMES = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For ranges of documents: the first document, sorted distinct hashes, and where each document's begin."""
    for first, last in passes(texts, STEP_BYTES):
        words, owner = hashed_words(texts[first:last])
        counts = np.bincount(owner, minlength=last - first)
        begins = np.cumsum(counts) - counts
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        hashes = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            hashes += words[k : len(words) - SHINGLE + 1 + k] * _TIMES[k]
        whole = owner[: len(hashes)] == owner[SHINGLE - 1 :] if len(hashes) else np.zeros(0, bool)
        hashes, of = mix(hashes[whole]), owner[: len(whole)][whole]
        rest = [mix(np.array([(words[begins[d] : begins[d] + counts[d]] * _TIMES[: counts[d]]).sum() + np.uint64(counts[d])])) for d in short]
        hashes, of = np.concatenate([hashes, *rest]), np.concatenate([of, short])
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        hashes, of = hashes[fresh], of[fresh]
        yield first, hashes, np.searchsorted(of, np.arange(last - first + 1))


def _sets_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """:func:`shingle_sets` over a column of texts."""
    for begin, texts in text_ranges(column, HELD_BYTES):
        for first, hashes, borders in shingle_sets(texts):
            yield begin + first, hashes, borders


def _draw(elements: np.ndarray, j: int, registers: int) -> tuple[np.ndarray, np.ndarray]:
    """The j-th step of each element: a fraction below 1 and the place to swap with, from j on."""
    bits = mix(elements + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return (bits >> np.uint64(11)).astype(np.float64) / 9007199254740992.0, (j + (bits & np.uint64(0x7FFFFFFF)) % np.uint64(registers - j)).astype(np.int64)


def signatures(hashes: np.ndarray, borders: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """SuperMinHash values, one row of registers a document; rows of empty sets are infinite."""
    docs = len(borders) - 1
    out = np.full((docs, registers), np.inf)
    first = 0
    while first < docs:  # a step takes whole documents, one at least
        last = max(first + 1, int(np.searchsorted(borders, borders[first] + ELEMENTS, side="right")) - 1)
        elements = hashes[borders[first] : borders[last]]
        owner = np.repeat(np.arange(first, last), np.diff(borders[first : last + 1]))
        order: np.ndarray | None = None
        for j in range(registers):
            if not len(elements):
                break
            fraction, at = _draw(elements, j, registers)
            if order is None:
                place, swapped = at, at
            else:
                line = np.arange(len(elements))
                place = order[line, at].astype(np.int64)
                order[line, at] = order[:, j]
            np.minimum.at(out.reshape(-1), owner * registers + place, j + fraction)
            open_ = out[first:last].max(axis=1) >= j + 1  # a later rank can still lower a register
            stay = open_[owner - first]
            if order is None:
                elements, owner, swapped = elements[stay], owner[stay], swapped[stay]
                order = np.broadcast_to(np.arange(registers, dtype=np.uint8), (len(elements), registers)).copy()
                order[np.arange(len(elements)), swapped] = 0
            else:
                elements, owner, order = elements[stay], owner[stay], order[stay]
        first = last
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row of signatures."""
    bands = values.shape[1] // ROWS
    bits = values.view(np.uint64).reshape(len(values), bands, ROWS)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(values), bands)).copy()
    for r in range(ROWS):
        keys = mix(keys * np.uint64(31) + bits[:, :, r])
    return keys.view(np.int64)


def _sketches(registers: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, borders in _sets_of(batch.column("text")):
                n = len(borders) - 1
                keys = band_keys(signatures(hashes, borders, registers))
                sizes = np.diff(borders)
                digests = [blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(borders, borders[1:])]
                bands = [k if s else None for k, s in zip(keys, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(first, n), batch.column("doc_id").slice(first, n), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["_row", "doc_id", "n_shingles", "set_digest", "bands"],
                )
    return sketch


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, hashes, borders in _sets_of(batch.column("text")):
            sets = [hashes[a:b].tobytes() for a, b in zip(borders, borders[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("_row").slice(first, len(sets)), pa.array(sets, pa.binary())], names=["_row", "elements"])


def _compare(percent: int):
    def compare(key, table):
        """Exact overlaps of one pivot's set with those of some members."""
        rows, sets, pivots = (table.column(c).to_pylist() for c in ("member", "elements", "is_pivot"))
        at = pivots.index(True)
        pivot = np.frombuffer(sets[at], np.uint64)
        found = []
        for row, data, is_pivot in zip(rows, sets, pivots):
            if not is_pivot:
                other = np.frombuffer(data, np.uint64)
                common = len(np.intersect1d(pivot, other, assume_unique=True))
                found.append((rows[at], row, 100 * common >= percent * (len(pivot) + len(other) - common)))
        return pa.table({"pivot": pa.array([f[0] for f in found], pa.int64()), "member": pa.array([f[1] for f in found], pa.int64()), "linked": pa.array([f[2] for f in found], pa.bool_())})
    return compare


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``pairs`` (pivot, member) with ``linked``: whether the full sets are alike by ``percent`` or more.

    A pivot's members are spread over groups of about ``GROUP`` rows, to each of which the
    pivot's set is sent, so a pivot of very many members fills no task.
    """
    counts = pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("_n"))
    salted = pairs.join(counts, "pivot").withColumn("_salt", F.pmod(F.xxhash64("member"), F.ceil(F.col("_n") / GROUP)))
    members = salted.join(sets, F.col("member") == F.col("_row")).select("pivot", "_salt", "member", "elements", F.lit(False).alias("is_pivot"))
    pivots = salted.select("pivot", "_salt").distinct().join(sets, F.col("pivot") == F.col("_row")).select("pivot", "_salt", F.col("pivot").alias("member"), "elements", F.lit(True).alias("is_pivot"))
    return members.union(pivots).groupBy("pivot", "_salt").applyInArrow(_compare(percent), "pivot long, member long, linked boolean")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    out = np.zeros(len(left) * len(right), np.int64)
    _, ids = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    cut = sum(map(len, left))
    a, b = ids[:cut], ids[cut:]
    of_a, of_b = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right))
    by = np.argsort(b, kind="stable")
    b, of_b = b[by], of_b[by]
    lo, hi = np.searchsorted(b, a), np.searchsorted(b, a, side="right")
    count = hi - lo
    steps = np.cumsum(count)
    first = 0
    while first < len(a):  # a bounded number of meetings at a time
        last = max(first + 1, int(np.searchsorted(steps, (steps[first - 1] if first else 0) + MEETINGS)))
        n = count[first:last]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[first:last], n)
        out += np.bincount(np.repeat(of_a[first:last], n) * len(right) + of_b[at], minlength=len(out))
        first = last
    return out.reshape(len(left), len(right))


def _block_links(percent: int):
    def links_of(key, table):
        """Exact links between the labels of two blocks, as many as join them and no more."""
        labels, sides = np.array(table.column("label").to_pylist()), np.array(table.column("side").to_pylist())
        sets = [np.frombuffer(x, np.uint64) for x in table.column("elements").to_pylist()]
        a, b = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)  # side 2: a block against itself
        found = set()
        if len(a) and len(b):
            common = overlaps([sets[i] for i in a], [sets[i] for i in b])
            sizes = np.array([len(x) for x in sets])
            alike = (100 * common >= percent * (sizes[a][:, None] + sizes[b][None, :] - common)) & (labels[a][:, None] != labels[b][None, :])
            i, j = np.nonzero(alike)
            found = {(min(x, y), max(x, y)) for x, y in zip(labels[a[i]].tolist(), labels[b[j]].tolist())}
        joined: dict[int, int] = {}

        def root(x):
            while x in joined:
                x = joined[x]
            return x
        links = []
        for x, y in sorted(found):
            rx, ry = root(x), root(y)
            if rx != ry:
                joined[max(rx, ry)] = min(rx, ry)
                links.append((x, y))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})
    return links_of


def near_duplicate_links(classes: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """Links (a, b) that join all ``classes`` (_row, n_shingles, bands) with similar sets, each checked on full sets.

    Classes that share a band are candidates, candidates of candidates form a cluster. First
    every member of a cluster is compared with its hub, the member whose buckets are fullest:
    most clusters are joined by that, at one comparison a member however large they are.
    Clusters that are not are cut into blocks of ``BLOCK`` members, and every pair of blocks
    is compared in a task of its own, so that no link between members that the hub did
    not join is left unlooked at; a task returns links that join labels, not pairs.
    """
    buckets = classes.select(F.explode("bands").alias("band"), "_row")
    shared = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_least")).where("_n > 1")
    members = kept_table(buckets.join(shared, "band").select("_row", "_n", "_least"))
    clusters = components(members.select(F.col("_row").alias("a"), F.col("_least").alias("b")))
    weights = members.groupBy("_row").agg(F.sum("_n").alias("_weight"))
    members = kept_table(weights.join(clusters, weights["_row"] == clusters["id"]).select("_row", "_weight", F.col("root").alias("cluster")))
    if members.isEmpty():
        return None
    hubs = members.groupBy("cluster").agg(F.min(F.struct(-F.col("_weight"), F.col("_row").alias("hub")))["hub"].alias("hub"))
    sets = kept_table(docs.select("_row", "text").join(members.select("_row"), "_row", "left_semi").mapInArrow(_set_rows, "_row long, elements binary"))
    pairs = kept_table(members.join(hubs, "cluster").where("_row <> hub").select(F.col("hub").alias("pivot"), F.col("_row").alias("member")))
    stars = kept_table(verified(pairs, sets, percent).where("linked").select(F.col("pivot").alias("a"), F.col("member").alias("b")))
    labels = members.join(stars.select(F.col("a").alias("_hub"), F.col("b").alias("_row")), "_row", "left").select("_row", "cluster", F.coalesce("_hub", "_row").alias("label"))
    open_ = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"), F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a <> _b")
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    rows = labels.join(open_, "cluster").select("_row", "cluster", "label", blocks.alias("_blocks"), F.pmod(F.xxhash64("_row"), blocks).cast("int").alias("_block"))
    others = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("_block")).alias("i"), F.greatest(o, F.col("_block")).alias("j"), F.when(o == F.col("_block"), 2).otherwise(F.when(F.col("_block") < o, 0).otherwise(1)).alias("side")))
    spread = rows.join(sets, "_row").select("cluster", "label", "elements", F.explode(others).alias("o")).select("cluster", "label", "elements", "o.i", "o.j", "o.side")
    links = spread.groupBy("cluster", "i", "j").applyInArrow(_block_links(percent), "a long, b long")
    return kept_table(stars.union(links))


def _grouped(docs: DataFrame, percent: int, bands: int) -> DataFrame:
    """Keyed documents with ``n_shingles``, ``class_id``, ``class_links``, ``component_id`` and ``_first``.

    ``_first`` is the row of the component that comes first: the smallest id, rows without
    one last. Wordless rows have neither class nor component.
    """
    sketches = kept_table(docs.mapInArrow(_sketches(bands * ROWS), "_row long, doc_id long, n_shingles long, set_digest binary, bands array<long>"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "_row"))
    classes = kept_table(sketches.where("n_shingles > 0").groupBy("set_digest").agg(F.min("_row").alias("_row"), F.min("doc_id").alias("_id"), first.alias("_first"), F.min("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")))
    links = near_duplicate_links(classes.select("_row", "n_shingles", "bands"), docs, percent)
    named = classes.select("set_digest", F.col("_row").alias("class_id"), "_id", "_first")
    if links is None:
        named = named.select("*", F.col("class_id").alias("_root"), F.lit(0).cast("long").alias("class_links"))
    else:
        roots = components(links)
        degree = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id"))).groupBy("id").agg(F.count(F.lit(1)).alias("class_links"))
        named = named.join(roots.withColumnRenamed("id", "class_id"), "class_id", "left").join(degree.withColumnRenamed("id", "class_id"), "class_id", "left")
        named = named.select("set_digest", "class_id", "_id", "_first", F.coalesce("root", "class_id").alias("_root"), F.coalesce("class_links", F.lit(0)).alias("class_links"))
    least = named.groupBy("_root").agg(F.min("_id").alias("component_id"), F.min("_first")["_row"].alias("_first"))
    named = named.drop("_first").join(least, "_root").select("set_digest", "class_id", "component_id", "class_links", "_first")
    return sketches.select("_row", "doc_id", "n_shingles", "set_digest").join(named, "set_digest", "left")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``class_id``, ``class_links`` of every row.

    ``class_id`` is the smallest row key with the same set, ``class_links`` the number of
    verified links of that class that joined components.
    """
    out = _grouped(keyed(docs), percent, bands)
    alone = F.col("n_shingles") == 0
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "class_id", F.coalesce("class_links", F.lit(0)).alias("class_links"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without all but one of each component at ``STAGE_PERCENT``; all columns stay.

    The row with the smallest id stays, whether or not ids are null or repeat; a row without
    an id stays only where no member has one. Of rows that repeat the smallest id the one
    with the smallest text stays. Wordless documents all stay.
    """
    rows = keyed(docs, rest=True)
    gone = _grouped(rows.drop("_rest"), STAGE_PERCENT, STAGE_BANDS).where("_row <> _first").select("_row")
    return rows.join(gone, "_row", "left_anti").select("_rest.*")
