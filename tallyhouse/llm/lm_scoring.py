"""Scores of texts under a trigram model kept as Elias-Fano tries.

Texts become units: the words that occur in a batch of documents, and the documents as places
in that list. Shards of words add up what units counted and answer every unit with the counts
of its words in the training documents. With those, each token goes with the two before it to
the shard of the one before it. So a shard has all pairs that begin with its words and all
triples around them. It counts the pairs, makes a trie of Elias-Fano levels for each group of
its contexts, and scores their tokens with it; the sums of a document come back to its unit. Every pair and triple is counted at any size of the
corpus, no shard sees more than its share, and only totals reach the driver.

A word with more than ``HOT_TOKENS`` occurrences is dealt to many shards, by the word before it.
Pairs that begin with it are counted before that, by shards of pairs, as words are.

``RESOLUTION`` may make a smaller model: of n-grams that occur at least once in so many training
tokens, other words forming one class in which a word's share is its own smoothed count.
Nothing is left out unless it is set. Words that no training document has form the same class.
The base score is of exact counts of all words. Probabilities of a trie have eight bits.

Defined results: null and empty texts consist of the end token. Null ids count as empty text
for the fold; equal rows are scored one by one. Without training documents every count is 0.
An empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import crc_of_id, give_back, hashed_words, kept_table, mix, passes, shards_for, text_ranges
from tallyhouse.llm.elias_fano import Trie

RESOLUTION: int | None = None  # None keeps every n-gram
DISCOUNT = 0.5
UNIT_BYTES = 16 << 20  # bytes of text of a unit
SHARD_TOKENS = 1 << 21  # tokens for each shard
HOT_TOKENS = 1 << 22  # more occurrences than this are dealt to several shards
GROUP_TOKENS = 1 << 19  # tokens of a shard that get a trie and are scored at once
END = np.uint64(0x2545F4914F6CDD1D)  # hash of the end token
OTHER_HASH, START_HASH = np.uint64(0x6A09E667F3BCC908), np.uint64(0xBB67AE8584CAA73B)
OTHER, STOP, START, WORDS = 0, 1, 2, 3  # numbers of the class of rare words, the end, the start, the first word
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def training(column: str = "doc_id") -> Column:
    return F.pmod(crc_of_id(column), F.lit(10)) != 0


def tokens(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of documents: first, last, token hashes with the end tokens, and the document of each."""
    for first, last in passes(texts):
        words, owner = hashed_words(texts[first:last])
        counts = np.bincount(owner, minlength=last - first) + 1
        out = np.full(counts.sum(), END, np.uint64)
        out[np.arange(len(words)) + owner] = words
        yield first, last, out, np.repeat(np.arange(last - first), counts)


def contexts(numbers: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two tokens before each token: the start before a document's first, -1 before that."""
    one = np.full(len(numbers), START, numbers.dtype)
    two = np.full(len(numbers), -1, numbers.dtype)
    same = owner[1:] == owner[:-1]
    one[1:][same] = numbers[:-1][same]
    two[1:][same] = one[:-1][same]
    return two, one


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, those of one place in the numbers side by side."""
    arrays = [np.ascontiguousarray(x) for x in arrays]
    body = b"".join(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in arrays) + b"."  # never empty
    head = json.dumps([(x.dtype.str, len(x)) for x in arrays]).encode()
    return len(head).to_bytes(4, "little") + head + pa.Codec("zstd").compress(body, asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    size = int.from_bytes(data[:4], "little")
    shapes = [(np.dtype(kind), n) for kind, n in json.loads(data[4 : 4 + size])]
    total = sum(kind.itemsize * n for kind, n in shapes) + 1
    body, at, out = pa.Codec("zstd").decompress(data[4 + size :], total, asbytes=True), 0, []
    for kind, n in shapes:
        planes = np.frombuffer(body, np.uint8, kind.itemsize * n, at).reshape(kind.itemsize, n)
        out.append(np.array(planes.T, order="C").reshape(-1).view(kind))
        at += kind.itemsize * n
    return out


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of hashes, so what is sorted by hash is sorted by shard."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _slices(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """Shards that occur among sorted hashes, and the place of each."""
    names, first = np.unique(shard_of(hashes, shards), return_index=True)
    for name, a, b in zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(hashes)]):
        yield name, slice(a, b)


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in four bytes where they have room there."""
    return counts.astype(np.uint32) if not len(counts) or counts.max() < 1 << 32 else counts.astype(np.int64)


# -- units ---------------------------------------------------------------------------------

_UNIT = "unit long, size long, learned long, documents binary, names binary, codes binary"


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unit = TaskContext.get().partitionId() << 32
    for batch in batches:
        for first, texts in text_ranges(batch.column("text"), UNIT_BYTES):
            ids = batch.column("doc_id").slice(first, len(texts))
            held = np.array(batch.column("held_out").slice(first, len(texts)).to_pylist(), bool)
            found = list(tokens(texts))
            lengths = np.concatenate([np.bincount(owner, minlength=b - a) for a, b, _, owner in found])
            names, codes = np.unique(np.concatenate([hashes for _, _, hashes, _ in found]), return_inverse=True)
            times = np.bincount(codes[np.repeat(~held, lengths)], minlength=len(names))
            uses = np.bincount(codes, minlength=len(names))
            rank = np.empty(len(names), np.uint32)
            rank[np.argsort(-uses, kind="stable")] = np.arange(len(names))  # frequent words have small numbers, which take little room
            documents = packed(ids.fill_null(0).to_numpy(zero_copy_only=False), np.array(ids.is_null().to_pylist(), bool), held, lengths.astype(np.uint32))
            yield pa.RecordBatch.from_pylist([{
                "unit": unit, "size": len(codes), "learned": int(times.sum()), "documents": documents,
                "names": packed(names, _narrow(times), _narrow(uses)), "codes": packed(rank[codes])}], _SCHEMAS["unit"])
            unit += 1
        give_back()


_SCHEMAS = {"unit": pa.schema([("unit", pa.int64()), ("size", pa.int64()), ("learned", pa.int64()), ("documents", pa.binary()), ("names", pa.binary()), ("codes", pa.binary())])}


class Unit:
    """A unit with the counts of its words in all training documents, and their numbers everywhere."""

    def __init__(self, row: dict, least: int):
        self.unit = row["unit"]
        self.ids, self.missing, self.held, lengths = unpacked(row["documents"])
        self.names, _, uses = unpacked(row["names"])
        self.codes = np.argsort(-uses.astype(np.int64), kind="stable").astype(np.int32)[unpacked(row["codes"])[0]]
        answers = [unpacked(x["totals"]) for x in row["answers"]]
        self.totals, self.everywhere = (np.concatenate([x[k] for x in answers]).astype(np.int64) for k in (0, 1))
        self.owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths.astype(np.int64))
        # numbers within the unit: those of the classes, then the words
        self.hashes = np.concatenate([np.array([OTHER_HASH, END, START_HASH], np.uint64), self.names])
        number = np.arange(len(self.names), dtype=np.int32) + np.int32(WORDS)
        number[self.totals < least] = OTHER
        number[self.names == END] = STOP
        self.number = number
        self.third = number[self.codes]
        self.first, self.second = contexts(self.third, self.owner)

    def smooth(self, model: dict) -> np.ndarray:
        """Unigram probabilities by number."""
        counts = np.concatenate([[model["other_total"], model["stops"], 0], self.totals])
        return (counts + 0.1) / (model["total"] + 0.1 * model["size"])

    def hot_pairs(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens behind hot words; hashes of their distinct pairs, sorted; the first place and the number of the pair of each token."""
        at = np.flatnonzero(np.isin(self.hashes, hot)[self.second])
        hashes = mix(self.hashes[self.second[at]] * _GOLDEN + self.hashes[self.third[at]])
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        return at, keys, first, which


# -- counts of words, and of pairs of hot words, by shards -----------------------------------

_ASK = "unit long, shard int, asked binary"
_ANSWER = "unit long, shard int, totals binary, total long, distinct long, hot binary"


def _rows(rows: list[dict], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, kind)


_SCHEMAS["ask"] = pa.schema([("unit", pa.int64()), ("shard", pa.int32()), ("asked", pa.binary())])


def _word_asks(shards: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, data in zip(batch.column("unit").to_pylist(), batch.column("names")):
                names, times, _ = unpacked(data.as_py())
                yield _rows([{"unit": unit, "shard": s, "asked": packed(names[p], times[p])} for s, p in _slices(names, shards)], _SCHEMAS["ask"])
    return ask


def _summed(table: pa.Table) -> tuple[list[int], list[list[np.ndarray]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units and messages of a shard; its keys, the first place and total of each, and the key of every place."""
    units, messages = table.column("unit").to_pylist(), [unpacked(x.as_py()) for x in table.column("asked")]
    keys, first, which = np.unique(np.concatenate([m[0] for m in messages]), return_index=True, return_inverse=True)
    totals = np.bincount(which, np.concatenate([m[1] for m in messages]), len(keys)).astype(np.int64)
    return units, messages, keys, first, totals, which


def _word_answers(shards: int, hot_tokens: int):
    """Counts of the words a unit asked for, and numbers that are theirs alone, small ones for frequent words."""
    def answer(key, table):
        shard = key[0].as_py()
        units, messages, keys, _, totals, which = _summed(table)
        cut = np.cumsum([0, *[len(m[0]) for m in messages]])
        number = np.empty(len(keys), np.int64)
        number[np.argsort(-totals, kind="stable")] = np.arange(len(keys)) * shards + shard
        rows = [{"unit": u, "shard": shard, "totals": packed(_narrow(totals[which[a:b]]), _narrow(number[which[a:b]]))} for u, a, b in zip(units, cut, cut[1:])]
        values, words = np.unique(totals[totals > 0], return_counts=True)  # how many words occur how often
        hot = totals > hot_tokens
        rows.append({"unit": -1, "shard": shard, "totals": packed(values, words), "total": int(totals.sum()), "distinct": int((totals > 0).sum()),
                     "hot": packed(keys[hot], totals[hot], number[hot])})
        return pa.Table.from_pylist(rows, pa.schema([("unit", pa.int64()), ("shard", pa.int32()), ("totals", pa.binary()), ("total", pa.int64()), ("distinct", pa.int64()), ("hot", pa.binary())]))
    return answer


def _at_least(least: int):
    """Tokens and words of a shard that a model of n-grams with ``least`` occurrences knows."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("totals"):
                values, words = unpacked(data.as_py())
                kept = values >= least
                yield pa.RecordBatch.from_arrays([pa.array([int((values * words)[kept].sum())], pa.int64()), pa.array([int(words[kept].sum())], pa.int64())], names=["total", "distinct"])
    return keep


def _pair_asks(shards: int, model: dict):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                unit = Unit(row, model["least"])
                at, keys, first, which = unit.hot_pairs(model["hot"])
                times = np.bincount(which[~unit.held[unit.owner[at]]], minlength=len(keys))
                word = np.searchsorted(model["hot"], unit.hashes[unit.second[at[first]]])
                smooth = unit.smooth(model)[unit.third[at[first]]]
                yield _rows([{"unit": unit.unit, "shard": s, "asked": packed(keys[p], _narrow(times[p]), word[p].astype(np.uint32), smooth[p])} for s, p in _slices(keys, shards)], _SCHEMAS["ask"])
    return ask


_PAIR_ANSWER = "unit long, shard int, totals binary, share double, smooth double"


def _pair_answers(least: int):
    def answer(key, table):
        shard = key[0].as_py()
        units, messages, keys, first, totals, which = _summed(table)
        cut = np.cumsum([0, *[len(m[0]) for m in messages]])
        rows = [{"unit": u, "shard": shard, "totals": packed(_narrow(totals[which[a:b]]))} for u, a, b in zip(units, cut, cut[1:])]
        kept = totals >= least
        word, smooth = (np.concatenate([m[k] for m in messages])[first][kept] for k in (2, 3))
        some, of = np.unique(word, return_inverse=True)
        for w, share, x in zip(some.tolist(), np.bincount(of, totals[kept] - DISCOUNT).tolist(), np.bincount(of, smooth).tolist()):
            rows.append({"unit": -1 - w, "shard": shard, "share": share, "smooth": x})
        return pa.Table.from_pylist(rows, pa.schema([("unit", pa.int64()), ("shard", pa.int32()), ("totals", pa.binary()), ("share", pa.float64()), ("smooth", pa.float64())]))
    return answer


def _answered(units: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Units with the answers of all shards, in the order of the shards."""
    own = answers.where("unit >= 0").groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("shard", "totals"))).alias(name))
    return units.join(own, "unit", "left")


# -- tries by the middle word ----------------------------------------------------------------

_MESSAGE = "shard int, unit long, body binary"


def _documents_of(unit: Unit, model: dict) -> bytes:
    """What a unit knows of its documents without pairs: ids, folds, tokens, known tokens, base scores, shares within the class."""
    n, codes, owner = len(unit.ids), unit.codes, unit.owner
    base = np.log10((unit.totals + 0.1) / (model["total"] + 0.1 * (model["distinct"] + 1)))
    within = np.log10((unit.totals + 0.1) / (model["other_total"] + 0.1 * (model["other_distinct"] + 1)))
    within[unit.number != OTHER] = 0
    known = unit.totals[codes] > 0
    return packed(unit.ids, unit.missing, unit.held, np.bincount(owner, minlength=n), np.bincount(owner[known], minlength=n), np.bincount(owner, base[codes], n), np.bincount(owner, within[codes], n))


def _messages(shards: int, model: dict):
    """Tokens with the two before them, by shard of the one before; and the documents of a unit, below the shards."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                unit = Unit(row, model["least"])
                rows = [{"shard": -1 - unit.unit % shards, "unit": unit.unit, "body": _documents_of(unit, model)}]
                dealt = unit.hashes[unit.second]
                pair_totals = np.zeros(0, np.int64)
                if len(model["hot"]):
                    hot, _, _, which = unit.hot_pairs(model["hot"])
                    pair_totals = np.zeros(len(dealt), np.int64)
                    pair_totals[hot] = np.concatenate([unpacked(x["totals"])[0] for x in row["pair_answers"] or []] or [np.zeros(0, np.int64)])[which]
                    before = unit.hashes[np.where(unit.first[hot] < 0, unit.third[hot], unit.first[hot])]  # nothing is before the start
                    dealt[hot] = mix(dealt[hot] + before * _GOLDEN)
                shard = shard_of(dealt, shards).astype(np.uint16 if shards < 1 << 16 else np.uint32)  # short numbers are sorted by their digits
                order = np.argsort(shard, kind="stable")
                parts, begin = np.unique(shard[order], return_index=True)
                del dealt, shard
                # the unit's words in the order of their numbers everywhere
                by_number = np.argsort(unit.everywhere)
                totals, everywhere = (np.concatenate([np.zeros(WORDS, np.int64), x[by_number]]) for x in (unit.totals, unit.everywhere))
                rank = np.concatenate([np.arange(WORDS), np.empty(len(by_number), np.int64), [-1]]).astype(np.int32)  # the last is that of -1, nothing before
                rank[by_number + WORDS] = np.arange(len(by_number)) + WORDS
                first, second, third = (rank[x] for x in (unit.first, unit.second, unit.third))
                for s, at in zip(parts.tolist(), np.split(order, begin[1:])):
                    grams = np.concatenate([second[at], first[at], third[at]])
                    if len(at) * 8 < len(totals):
                        used, place = np.unique(grams, return_inverse=True)
                    else:
                        seen = np.zeros(len(totals) + 1, bool)
                        seen[grams + 1] = True
                        used, place = np.flatnonzero(seen) - 1, np.cumsum(seen)[grams + 1] - 1
                    names = np.where(used < WORDS, used, everywhere[used] + WORDS) + 1  # not below 0
                    owner = unit.owner[at]
                    more = [_narrow(pair_totals[at])] if len(pair_totals) else []
                    rows.append({"shard": s, "unit": unit.unit, "body": packed(
                        np.diff(names, prepend=0).astype(np.uint32 if not len(names) or names[-1] < 1 << 31 else np.int64), _narrow(totals[np.maximum(used, 0)]), *np.split(place.astype(np.uint32), 3), np.diff(owner, prepend=0).astype(np.uint32), unit.held[owner], *more)})
                del unit, rank, first, second, third, order
                give_back()
                yield _rows(rows, pa.schema([("shard", pa.int32()), ("unit", pa.int64()), ("body", pa.binary())]))
    return send


_PART = "unit long, shard int, part binary"


def _shard_scores(model: dict):
    """Scores a shard's tokens with the trie of its words: sums of the documents of every unit."""
    def score(key, table):
        shard, units = key[0].as_py(), table.column("unit").to_pylist()
        shape = pa.schema([("unit", pa.int64()), ("shard", pa.int32()), ("part", pa.binary())])
        if shard < 0:
            return pa.Table.from_arrays([table.column("unit"), table.column("shard"), table.column("body")], schema=shape)
        names, totals, grams, runs, held, pair_totals = [], [], [], [], [], []
        for body in table.column("body"):
            steps, counted, *places, owner, learned, more = [*unpacked(body.as_py()), None][:8]
            names.append(np.cumsum(steps.astype(np.int64)) - 1)  # -1 where nothing is before
            totals.append(counted), grams.append(places), runs.append(owner), held.append(learned)
            if more is not None:
                pair_totals.append(more)
        known, place = np.unique(np.concatenate([np.arange(-1, WORDS), *names]), return_index=True)
        counts = np.concatenate([[0] * (WORDS + 1), *totals])[place][1:].astype(np.float64)
        counts[OTHER], counts[STOP], counts[START] = model["other_total"], model["stops"], 0
        local = [(np.searchsorted(known, x) - 1).astype(np.int32) for x in names]
        middle, before, after = (np.concatenate([x[g[k]] for x, g in zip(local, grams)]) for k in range(3))
        del grams, names, totals, local
        give_back()
        held, groups = np.concatenate(held), -(-len(middle) // GROUP_TOKENS)
        smooth = (counts + 0.1) / (model["total"] + 0.1 * model["size"])
        of_pairs, back = _pairs(known[1:], counts, smooth, middle, after, held, np.concatenate(pair_totals) if pair_totals else None, groups, model)
        scores = np.empty(len(middle))
        for at in _groups(middle, np.where(before < 0, after, before), groups):
            part = [x[at].astype(np.int64) for x in (before, middle, after)]
            scores[at] = Trie(_trie(counts, smooth, back, *part, held[at], of_pairs[at], model)).scores(*part)
            give_back()
        rows, at = [], 0
        for u, run in zip(units, runs):
            owner = np.cumsum(run, dtype=np.int64)
            begin = np.flatnonzero(np.append(True, run[1:] > 0))
            rows.append({"unit": u, "shard": shard, "part": packed(np.diff(owner[begin], prepend=0).astype(np.uint32), np.add.reduceat(scores[at : at + len(owner)], begin))})
            at += len(owner)
        del middle, before, after, scores, held, of_pairs, runs
        give_back()
        return pa.Table.from_pylist(rows, shape)
    return score


def _groups(first: np.ndarray, second: np.ndarray, groups: int) -> list[np.ndarray]:
    """Places of a shard's tokens, those with one pair of numbers together, in groups that are worked on one by one."""
    if groups < 2:
        return [np.arange(len(first))]
    mixed = first.astype(np.uint32) * np.uint32(0x9E3779B1) + second.astype(np.uint32) * np.uint32(0x85EBCA6B)
    mixed = (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
    group = ((mixed ^ mixed >> np.uint32(13)) % np.uint32(groups)).astype(np.uint16 if groups < 1 << 16 else np.uint32)
    return np.split(np.argsort(group, kind="stable"), np.cumsum(np.bincount(group, minlength=groups))[:-1])


def _pairs(names: np.ndarray, counts: np.ndarray, smooth: np.ndarray, middle: np.ndarray, after: np.ndarray, held: np.ndarray, pair_totals: np.ndarray | None, groups: int, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Count of the pair that each token makes with the one before it, and the back-off of the words before."""
    words, shares, rest = len(counts), np.zeros(len(counts)), np.zeros(len(counts))
    out = np.empty(len(middle), np.int64 if counts.max() > 1 << 30 else np.int32)
    for at in _groups(middle, after, groups):
        keys, place = np.unique(middle[at].astype(np.int64) * words + after[at], return_inverse=True)
        found = np.bincount(place[~held[at]], minlength=len(keys))
        out[at] = found[place]
        del place
        keys, found = keys[found >= model["least"]], found[found >= model["least"]]
        shares += np.bincount(keys // words, found - DISCOUNT, words)
        rest += np.bincount(keys // words, smooth[keys % words], words)
    context = counts.copy()
    context[START] = model["stops"]  # as many starts as ends
    back = (1 - shares / np.maximum(context, 1)) / np.maximum(1 - rest, 1e-6)
    if pair_totals is not None:  # pairs of hot words are counted by shards of pairs
        at = np.minimum(np.searchsorted(names, model["hot_numbers"]), words - 1)
        here = names[at] == model["hot_numbers"]
        back[at[here]] = model["hot_back"][here]
        hot = np.zeros(words, bool)
        hot[at[here]] = True
        out[hot[middle]] = pair_totals[hot[middle]]
    return out, back


def _trie(counts: np.ndarray, smooth: np.ndarray, back: np.ndarray, before: np.ndarray, middle: np.ndarray, after: np.ndarray, held: np.ndarray, of_pairs: np.ndarray, model: dict) -> bytes:
    """Trie of the pairs that begin or end with the middle words of a group and of the triples around those."""
    words, least = len(counts), model["least"]
    inner = np.flatnonzero(before >= 0)
    (own, ends), (around, begins) = (np.unique(x, return_inverse=True) for x in (middle * words + after, before[inner] * words + middle[inner]))
    pairs = np.union1d(own, around)
    ends, begins = np.searchsorted(pairs, own)[ends], np.searchsorted(pairs, around)[begins]
    pair_counts = np.bincount(begins[~held[inner]], minlength=len(pairs))
    pair_counts[ends] = of_pairs
    kept = pair_counts >= least
    number = np.cumsum(kept) - 1
    pairs, pair_counts = pairs[kept], pair_counts[kept]
    both = ~held[inner] & kept[begins] & kept[ends[inner]]
    keys = number[begins[both]] * len(pairs) + number[ends[inner[both]]]
    del ends, begins, both, inner
    triples, triple_counts = np.unique(keys, return_counts=True)
    triples, triple_counts = triples[triple_counts >= least], triple_counts[triple_counts >= least]
    parent, child = pairs[triples // max(1, len(pairs))], pairs[triples % max(1, len(pairs))]
    context = counts.copy()
    context[START] = model["stops"]  # as many starts as ends
    return Trie.build(counts, context, np.stack([pairs // words, pairs % words], 1), pair_counts, np.stack([parent // words, parent % words, child % words], 1), triple_counts, DISCOUNT, smooth, back)


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _documents(key, table):
    """Rows of a unit's documents: what the unit knows of them and the sums of the shards."""
    rows = sorted(zip(table.column("shard").to_pylist(), table.column("part").to_pylist()))
    ids, missing, held, n_tokens, n_known, base, score = unpacked(rows[0][1])
    for _, part in rows[1:]:
        steps, sums = unpacked(part)
        score[np.cumsum(steps, dtype=np.int64)] += sums
    return pa.Table.from_arrays(
        [pa.array(ids, pa.int64(), mask=missing), *(pa.array(x) for x in (held, n_tokens, n_known, base, score))], names=[c.split()[0] for c in _SCORED.split(", ")])


def score(docs: DataFrame) -> DataFrame:
    """Base and model scores of every row, in log10."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", ~training())
    units = kept_table(texts.mapInArrow(_units, _UNIT))
    size = units.agg(F.sum("size")).first()[0] or 0
    shards = shards_for(size, SHARD_TOKENS)
    answers = kept_table(units.select("unit", "names").mapInArrow(_word_asks(shards), _ASK).groupBy("shard").applyInArrow(_word_answers(shards, HOT_TOKENS), _ANSWER))
    sums = answers.where("unit < 0")
    total, distinct = (x or 0 for x in sums.agg(F.sum("total"), F.sum("distinct")).first())
    least = max(1, -(-total // RESOLUTION)) if RESOLUTION else 1
    kept_total, kept_distinct = total, distinct
    if least > 1:
        kept_total, kept_distinct = (x or 0 for x in sums.select("totals").mapInArrow(_at_least(least), "total long, distinct long").agg(F.sum("total"), F.sum("distinct")).first())
    stops = texts.where(~F.col("held_out")).count()
    if 0 < stops < least:  # the end is no word of the class, however rare
        kept_total, kept_distinct = kept_total + stops, kept_distinct + 1
    model = {"total": total, "distinct": distinct, "least": least, "stops": stops, "other_total": total - kept_total, "other_distinct": distinct - kept_distinct,
             "size": kept_distinct - (stops > 0) + WORDS, "hot": np.zeros(0, np.uint64)}
    known = _answered(units, answers, "answers")
    model |= _hot_words(sums, model)
    if len(model["hot"]):
        known = kept_table(known)
        pairs = kept_table(known.mapInArrow(_pair_asks(shards, model), _ASK).groupBy("shard").applyInArrow(_pair_answers(least), _PAIR_ANSWER))
        shares, smooth = np.zeros(len(model["hot"])), np.zeros(len(model["hot"]))
        for row in pairs.where("unit < 0").groupBy("unit").agg(F.sum("share").alias("share"), F.sum("smooth").alias("smooth")).collect():
            shares[-1 - row["unit"]], smooth[-1 - row["unit"]] = row["share"], row["smooth"]
        model["hot_back"] = (1 - shares / model["hot_counts"]) / np.maximum(1 - smooth, 1e-6)
        known = _answered(known, pairs, "pair_answers")
    parts = known.mapInArrow(_messages(shards, model), _MESSAGE).groupBy("shard").applyInArrow(_shard_scores(model), _PART)
    scored = parts.groupBy("unit").applyInArrow(_documents, _SCORED)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def _hot_words(sums: DataFrame, model: dict) -> dict:
    """Words, the start and the class of rare words, where they come before too many tokens for one shard; sorted by hash."""
    found = [unpacked(r["hot"]) for r in sums.select("hot").collect()]
    for found_ in found:
        found_[2] += WORDS
    found += [[np.array([h], np.uint64), np.array([n]), np.array([k])] for h, n, k in ((START_HASH, model["stops"], START), (OTHER_HASH, model["other_total"], OTHER)) if n > HOT_TOKENS]
    names, counts, numbers = (np.concatenate([f[k] for f in found] or [np.zeros(0, kind)]) for k, kind in ((0, np.uint64), (1, np.int64), (2, np.int64)))
    own = np.flatnonzero(names != END)  # nothing comes behind the end
    own = own[np.argsort(names[own])]
    return {"hot": names[own], "hot_counts": counts[own].astype(np.float64), "hot_numbers": numbers[own]}
