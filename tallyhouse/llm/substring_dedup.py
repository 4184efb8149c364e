"""Removal of repeated 100-byte strings, by suffix arrays of shards.

A shard has to hold every copy of the strings it is asked about. Every 100-byte window of a
text is therefore filed under its smallest hashed k-mer (its anchor), which depends on the
window's bytes alone: equal windows have equal anchors. Neighbouring windows mostly share an
anchor, so a text falls into segments of about 140 bytes.

1. Every segment is sent to the shard of its anchor as two hashes and a place, not as text. Of
   equal segments the earliest stays, and the others are removed whole.
2. Where different segments share an anchor, their windows may be equal in part, if they agree
   in the 38 bytes on one side of it, which every window around it holds: the earliest of
   each kind is cut out of its text and sent to a suffix-array shard.
3. Each shard builds the suffix array of its segments by induced sorting and the permuted
   common prefixes. Neighbours in the array that share 100 bytes belong to one class; all of a
   class but the earliest window are removed.
4. Removed ranges return to their documents.

Equal segments of some megabytes of text are combined before the first shuffle: one record goes
on, the other places are settled on the spot, so a passage in a third of all documents sends
one record for so much text. Where the
different surroundings of one 24-byte anchor exceed the size of a suffix array, as around a passage
that many documents share, their windows are told apart one by one, by anchor and a 64-bit hash:
each batch settles what it has twice and sends the earliest of each to the shard of its hash.

Defined results: null text counts as empty; texts under 100 bytes lose nothing; documents
with equal ids are ordered by text and treated as separate documents, a null id comes first;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import binary_texts, kept_table, keyed, passes, prefix_hashes, shards_for, span_hashes, text_bytes, text_ranges
from tallyhouse.llm.suffix_array import permuted_prefixes, suffix_array

LENGTH = 100
GRAM = 24
SIDE = (LENGTH - GRAM) // 2  # a window around an anchor reaches so far on one side at least
SHARD_BYTES = 32 << 20  # bytes of text for each anchor shard
STEP_BYTES = 1 << 18  # bytes of text that one numpy pass looks at
MESSAGE_BYTES = 8 << 20  # bytes of text whose equal segments are combined before the shuffle
ARRAY_BYTES = 1 << 20  # bytes of segments for each suffix array


def segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """For ranges of documents: document, first window, windows, anchor and hash of every segment, and
    hashes of the ``SIDE`` bytes left and right of the anchor, 0 where the segment has fewer.

    A segment is a longest run of windows of one document with the same anchor place. The
    smallest hash wins, of equal ones the leftmost, so the choice lies in the window's bytes.
    A long text is taken in parts that overlap by a window less one byte; a segment at a border
    falls in two, which meet others like any different segments of one anchor.
    """
    width = LENGTH - GRAM + 1
    parts = [(i, at, t[at : at + STEP_BYTES + LENGTH - 1] if len(t) > STEP_BYTES else t) for i, t in enumerate(texts) for at in range(0, max(1, len(t) - LENGTH + 1), STEP_BYTES)]
    document, offset, pieces = (list(x) for x in zip(*parts)) if parts else ([], [], [])
    document, offset = np.array(document, np.int64), np.array(offset, np.int64)
    for first, last in passes(pieces, STEP_BYTES):
        sizes = np.array([len(t) for t in pieces[first:last]])
        data = np.frombuffer(b"".join(pieces[first:last]), np.uint8)
        if len(data) < LENGTH or not (sizes >= LENGTH).any():
            continue
        sums = prefix_hashes(data)
        at = np.arange(len(data) - GRAM + 1)
        grams = span_hashes(sums, at, at + GRAM)
        blocks = np.full(-(-len(grams) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        blocks[: len(grams)] = (grams >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
        del at
        blocks = blocks.reshape(-1, width)
        windows = len(data) - LENGTH + 1
        forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)[width - 1 : width - 1 + windows]
        backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)[:windows]
        del blocks
        place = (np.minimum(backward, forward) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        del forward, backward
        begins = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[:windows]
        inside = np.flatnonzero(np.arange(windows) + LENGTH <= (begins + sizes)[owner]).astype(np.uint32)
        if not len(inside):
            continue
        owner, place = owner[inside], place[inside]
        fresh = np.ones(len(inside), bool)
        fresh[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
        cut = np.flatnonzero(fresh)
        count = np.diff(np.append(cut, len(inside)))
        a, p, of = inside[cut].astype(np.int64), place[cut].astype(np.int64), owner[cut].astype(np.int64)
        del inside, owner, place, fresh
        z = a + count + LENGTH - 1
        left = np.where(p - a >= SIDE, span_hashes(sums, np.maximum(p - SIDE, 0), p) | np.uint64(1), np.uint64(0))
        end = np.minimum(p + GRAM + SIDE, len(data))
        right = np.where(z - p - GRAM >= SIDE, span_hashes(sums, np.minimum(p + GRAM, end), end) | np.uint64(1), np.uint64(0))
        yield document[first + of], a - begins[of] + offset[first + of], count, grams[p], span_hashes(sums, a, z), left, right


def all_segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """What :func:`segments` gives, for a whole batch."""
    parts = list(segments(texts))
    if not parts:
        return (*(np.zeros(0, np.int64) for _ in range(3)), *(np.zeros(0, np.uint64) for _ in range(4)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _by_row(rows: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Values of each row together."""
    if not len(rows):
        return
    order = np.argsort(rows, kind="stable")
    rows, values = rows[order], values[order]
    cut = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    for a, b in zip(cut, np.append(cut[1:], len(rows))):
        yield int(rows[a]), values[a:b]


def _joined(parts: list[bytes | None], kind) -> np.ndarray:
    return np.frombuffer(b"".join(p for p in parts if p), kind)


def _earliest_of_each(anchor: np.ndarray, digest: np.ndarray, row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the earliest of equal segments, and of the others."""
    order = np.lexsort((start, row, digest, anchor))
    a, d = anchor[order], digest[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
    return order[fresh], order[~fresh]


def _repeated(anchor: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Which segments share their anchor and the bytes on one side of it with another."""
    _, which, times = np.unique(anchor.astype(np.uint64) << np.uint64(32) | side, return_inverse=True, return_counts=True)
    return (times[which] > 1) & (side != 0)


_PLACES = "shard int, row long, spans binary, anchors binary, digests binary, lefts binary, rights binary, owners binary, starts binary, counts binary"


def _batch_of(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Bytes of segments as ranges."""
    return np.stack([start, start + count + LENGTH - 1], 1)


def _place_messages(shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("_row").to_pylist(), np.int64)
            for first, texts in text_ranges(batch.column("text"), MESSAGE_BYTES):
                out = _places(texts, rows[first : first + len(texts)], shards)
                for i in range(0, len(out), 1000):
                    yield _batch_of(_PLACES, out[i : i + 1000])
    return send


def _places(texts: list[bytes], rows: np.ndarray, shards: int) -> list[tuple]:
    """Messages of some documents: spans of segments that repeat among them, and one place of each other segment."""
    doc, start, count, anchor, digest, left, right = all_segments(texts)
    row = rows[doc]
    first, later = _earliest_of_each(anchor, digest, row, start)
    out = [(r % shards, r, _merged(s).tobytes(), *[None] * 7) for r, s in _by_row(row[later], _spans(start[later], count[later]))]
    shard = (anchor % np.uint64(shards)).astype(np.int64)
    first = np.sort(first)  # by place again: places of a document side by side pack better
    for s in np.unique(shard[first]):
        f = first[shard[first] == s]
        out.append((int(s), None, None, (anchor[f] >> np.uint64(32)).astype(np.uint32).tobytes(), digest[f].tobytes(), *((x[f] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for x in (left, right)), row[f].tobytes(), start[f].astype(np.uint32).tobytes(), count[f].astype(np.uint8).tobytes()))
    return out


_SETTLED = "row long, spans binary, asked binary, asked_anchors binary, asked_hot binary, asked_bytes long"


def _cells(values: np.ndarray) -> pa.Array:
    """The bytes of each row of an array."""
    values = np.ascontiguousarray(values)
    width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    offsets = np.arange(len(values) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def _settler(hot_bytes: int):
    """``hot_bytes``: an anchor with more bytes to look at is hot."""
    def settled(key, table):
        """Removed spans of a shard, and the segments whose text must be looked at."""
        columns = {c: table.column(c).to_pylist() for c in table.column_names}
        sent = [(r, s, None, None, None, 0) for r, s in zip(columns["row"], columns["spans"]) if r is not None]
        anchor, digest, left, right, row, start, count = (_joined(columns[c], k) for c, k in (("anchors", np.uint32), ("digests", np.uint64), ("lefts", np.uint32), ("rights", np.uint32), ("owners", np.int64), ("starts", np.uint32), ("counts", np.uint8)))
        start, count = start.astype(np.int64), count.astype(np.int64)
        first, later = _earliest_of_each(anchor, digest, row, start)
        mixed = _repeated(anchor[first], left[first]) | _repeated(anchor[first], right[first])
        asked = first[mixed]
        spans = _spans(start[asked], count[asked])
        sizes = spans[:, 1] - spans[:, 0]
        _, which = np.unique(anchor[asked], return_inverse=True)
        hot = (np.bincount(which, sizes) > hot_bytes)[which] if len(asked) else np.zeros(0, bool)
        # a row for each segment: put together by document, their number would grow with the shards
        none, n = lambda k: pa.nulls(k, pa.binary()), len(later)
        removed = [pa.array(row[later], pa.int64()), _cells(_spans(start[later], count[later])), none(n), none(n), none(n), pa.array(np.zeros(n, np.int64))]
        open_ = [pa.array(row[asked], pa.int64()), none(len(asked)), _cells(spans), _cells(anchor[asked]), _cells(hot), pa.array(sizes, pa.int64())]
        names = [f.split()[0] for f in _SETTLED.split(", ")]
        return pa.Table.from_batches([_batch_of(_SETTLED, sent), *(pa.RecordBatch.from_arrays(c, names=names) for c in (removed, open_))])
    return settled


_TEXTS = "shard int, bytes binary, sizes binary, owners binary, starts binary, anchors binary, hashes binary, rows binary, places binary, done_rows binary, done_places binary"


def _window_hashes(pieces: list[bytes], row: np.ndarray, start: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, hash, row and place of every window of segments."""
    out = []
    for first, last in passes(pieces, STEP_BYTES):
        sizes = np.array([len(x) for x in pieces[first:last]])
        sums = prefix_hashes(np.frombuffer(b"".join(pieces[first:last]), np.uint8))
        begins, counts = np.cumsum(sizes) - sizes, sizes - LENGTH + 1
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = inner + np.repeat(begins, counts)
        spread = [np.repeat(x[first:last], counts) for x in (anchor, row, start)]
        out.append((spread[0], span_hashes(sums, at, at + LENGTH), spread[1], spread[2] + inner))
    return tuple(np.concatenate(x) for x in zip(*out))


def _later_windows(anchor: np.ndarray, digest: np.ndarray, row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the earliest window of each kind, and of the others."""
    by = np.lexsort((place, row, digest, anchor))
    later = np.zeros(len(by), bool)
    later[1:] = (anchor[by[1:]] == anchor[by[:-1]]) & (digest[by[1:]] == digest[by[:-1]])
    return by[~later], by[later]


def _hot_messages(hot: list[tuple[bytes, int, int, int]], shards: int) -> list[tuple]:
    """Windows of segments of hot anchors: the earliest of each kind by the shard of its hash, the others as settled."""
    anchor, digest, row, place = _window_hashes([h[0] for h in hot], *(np.array(x, k) for x, k in zip(list(zip(*hot))[1:], (np.int64, np.int64, np.uint32))))
    first, later = _later_windows(anchor, digest, row, place)
    out = []
    for shard, f in _by_row((digest[first] >> np.uint64(20)).astype(np.int64) % shards, first):
        out.append((int(shard), None, None, None, None, anchor[f].tobytes(), digest[f].tobytes(), row[f].tobytes(), place[f].tobytes(), None, None))
    for shard, f in _by_row(row[later] % shards, later):
        out.append((int(shard), *[None] * 8, row[f].tobytes(), place[f].tobytes()))
    return out


def _text_messages(shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = defaultdict(lambda: ([], [], [], []))
            hot, size = [], 0
            for row, text, spans, anchors, heat in zip(batch.column("_row").to_pylist(), _unpacked(batch), *(batch.column(c).to_pylist() for c in ("asked", "asked_anchors", "asked_hot"))):
                for (a, b), h, many in zip(_joined(spans, np.int64).reshape(-1, 2).tolist(), _joined(anchors, np.uint32).tolist(), _joined(heat, np.bool_).tolist()):
                    if many:
                        hot.append((text[a:b], row, a, h))
                        size += b - a
                    else:
                        for part, x in zip(found[h % shards], (text[a:b], b - a, row, a)):
                            part.append(x)
                if size > ARRAY_BYTES:
                    yield _batch_of(_TEXTS, _hot_messages(hot, shards))
                    hot, size = [], 0
            if hot:
                yield _batch_of(_TEXTS, _hot_messages(hot, shards))
            yield _batch_of(_TEXTS, [(s, b"".join(data), np.array(sizes, np.uint32).tobytes(), np.array(rows, np.int64).tobytes(), np.array(starts, np.int64).tobytes(), *[None] * 6) for s, (data, sizes, rows, starts) in found.items()])
    return send


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for first, texts in text_ranges(batch.column("text"), MESSAGE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("_row").slice(first, len(texts)), pa.array([pack(t) for t in texts], pa.binary())], names=["_row", "packed"])


def _unpacked(batch: pa.RecordBatch) -> Iterator[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return (unpack(p.as_py()) for p in batch.column("packed"))


def repeated_windows(contents: list[bytes], rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of windows of distinct segments that also start earlier elsewhere."""
    sizes = np.array([len(c) for c in contents])
    text = np.frombuffer(b"\0".join(contents), np.uint8).astype(np.int64) + 1
    begins = np.cumsum(sizes + 1) - sizes - 1
    text[begins[1:] - 1] = 0  # what parts segments is no byte
    order = suffix_array(text)
    prefixes = permuted_prefixes(text, order, LENGTH)
    classes = np.cumsum(prefixes[order] < LENGTH)
    segment = np.repeat(np.arange(len(sizes)), np.append(np.diff(begins), sizes[-1]))[order]
    inner = order - begins[segment]
    real = inner + LENGTH <= sizes[segment]
    classes, segment, inner = classes[real], segment[real], inner[real]
    row, place = rows[segment], starts[segment] + inner
    by = np.lexsort((place, row, classes))
    classes, row, place = classes[by], row[by], place[by]
    later = np.zeros(len(by), bool)
    later[1:] = classes[1:] == classes[:-1]
    return row[later], place[later]


def _merged(spans: np.ndarray) -> np.ndarray:
    """Sorted spans without overlaps or touching ends."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.append(True, spans[1:, 0] > reach[:-1])
    cut = np.flatnonzero(first)
    return np.stack([spans[cut, 0], reach[np.append(cut[1:], len(spans)) - 1]], 1)


def _repeated_spans(key, table):
    """Removed spans of a suffix-array shard, by row."""
    columns = {c: table.column(c).to_pylist() for c in table.column_names}
    contents = []
    for data, sizes in zip(columns["bytes"], columns["sizes"]):
        if sizes is None:
            continue
        ends = np.cumsum(np.frombuffer(sizes, np.uint32)).tolist()
        contents += [data[a:b] for a, b in zip([0, *ends], ends)]
    rows, places = _joined(columns["done_rows"], np.int64), _joined(columns["done_places"], np.int64)
    windows = [_joined(columns[c], k) for c, k in (("anchors", np.uint32), ("hashes", np.uint64), ("rows", np.int64), ("places", np.int64))]
    _, later = _later_windows(*windows)
    rows, places = np.append(rows, windows[2][later]), np.append(places, windows[3][later])
    if contents:
        more = repeated_windows(contents, _joined(columns["owners"], np.int64), _joined(columns["starts"], np.int64))
        rows, places = np.append(rows, more[0]), np.append(places, more[1])
    out = [(row, _merged(np.stack([found, found + LENGTH], 1)).tobytes()) for row, found in _by_row(rows, places)] if len(rows) else []
    return pa.Table.from_batches([_batch_of("row long, spans binary", out)])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``_row`` and ``spans`` (list of packed byte ranges) of keyed documents that lose bytes."""
    shards = shards_for(text_bytes(docs), SHARD_BYTES)
    sent = docs.select("_row", "text").mapInArrow(_place_messages(shards), _PLACES)
    settled = kept_table(sent.groupBy("shard").applyInArrow(_settler(ARRAY_BYTES), _SETTLED))
    asked = settled.where("asked is not null").groupBy(F.col("row").alias("_row")).agg(F.collect_list("asked").alias("asked"), F.collect_list("asked_anchors").alias("asked_anchors"), F.collect_list("asked_hot").alias("asked_hot"))
    shards = shards_for(settled.agg(F.sum("asked_bytes")).first()[0] or 0, ARRAY_BYTES)
    packed = docs.select("_row", "text").mapInArrow(_packed, "_row long, packed binary")
    texts = packed.join(asked, "_row").mapInArrow(_text_messages(shards), _TEXTS)
    spans = texts.groupBy("shard").applyInArrow(_repeated_spans, "row long, spans binary").union(settled.where("spans is not null").select("row", "spans"))
    return spans.groupBy(F.col("row").alias("_row")).agg(F.collect_list("spans").alias("spans"))


def _remaining(parts: list[bytes] | None, data: bytes) -> tuple[np.ndarray, bytes]:
    if not parts:
        return np.zeros((0, 2), np.int64), data
    spans = _merged(_joined(parts, np.int64).reshape(-1, 2))
    edges = [0, *spans.reshape(-1).tolist(), len(data)]
    return spans, b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for data, parts in zip(binary_texts(batch.column("text")), batch.column("spans").to_pylist()):
            spans, left = _remaining(parts, data)
            out.append((len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest()))
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removal_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row."""
    docs = keyed(docs)
    out = docs.join(repeated_spans(docs), "_row", "left").select("doc_id", "text", "spans")
    return out.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _kept_text(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or s is None else _remaining(list(s), t.encode())[1].decode("utf-8", "ignore") for t, s in zip(text, spans)], dtype=object)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with repeated strings cut out of ``text``; all columns stay.

    What is left of a character that was cut through goes too. ``n_chars``, where there is
    such a column, counts the remaining text. Null texts stay null.
    """
    rows = keyed(docs, rest=True)
    kept = F.pandas_udf(_kept_text, T.StringType())
    out = rows.select("_row", "_rest").join(repeated_spans(rows), "_row", "left")
    out = out.select("_rest.*", kept(F.col("_rest.text").cast("string"), "spans").alias("_kept"))
    return out.select(*[{"text": F.col("_kept").alias("text"), "n_chars": F.length("_kept").cast(t).alias("n_chars")}.get(c, F.col(c)) for c, t in docs.dtypes])
