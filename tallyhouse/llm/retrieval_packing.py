"""Packing of documents into training sequences, neighbours by lexical retrieval side by side.

Texts become token ids once, in a written table. Document frequencies and the mean length are
those of the whole corpus; they fill one table over the vocabulary. Documents go to shards by the
term that says most about them, of the terms another document has too, and are sorted by it and
the second one there, so that documents about the same things meet however far apart they came.
A frequent term is salted: it goes to as many shards as the documents that hold it fill.

A shard is read in blocks of a bounded number of tokens; a block gets a BM25 inverted index
over token ids. The first unused document seeds a window, and its best unused neighbours by all
its terms fill the rest, best first, until the window is full or no neighbour is left; only
then does the next document seed. A document that does not fit is cut, and what is left of it
seeds the next window, so windows are always full; an open window goes on into the next block.
The last window of a shard is cut into sequences whose lengths are powers of two, which need no
padding.

Defined results: null and empty texts are packed as their end token alone, which makes no
neighbours. Equal rows are
packed one by one. Null ids are carried as null. A document longer than a window fills
several. An empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import binary_texts, crc, kept_table, mix, passes, prefix_hashes, shards_for, span_hashes, text_ranges, word_spans

WINDOW = 4096
END = 2
TERMS = 1 << 16  # ids of a vocabulary
STEP_BYTES = 1 << 21  # text, or ids, that one numpy step looks at; a longer document has a step of its own
BLOCK_TOKENS = 1 << 21  # tokens in one index
FIRST_ASKED = 64  # neighbours that are put in order first; the others follow when the window still has room
K1, B = 1.2, 0.75
CACHED_WORDS = 1 << 20

# of ASCII: 1 for a lower-case letter, 2 for punctuation
_KIND = np.zeros(256, np.uint8)
_KIND[97:123] = 1
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"


class WordIds:
    """Token ids of texts, looked up word by word.

    The tokenizer lower-cases, drops white space and never merges across it, nor across the
    border of letters and punctuation, so the ids of a text are those of its words in order.
    Words are told apart by a 64-bit hash. Their ids lie in one array, found by a table of
    hashes with linear probing; they are kept up to a bound, then forgotten.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.full, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = None  # for lower-case ASCII, which normalisation leaves as it is
        vocabulary = self.full.get_vocab()
        if self.full.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        suffix = getattr(self.full.model, "end_of_word_suffix", None)
        self.last = np.zeros(1 << 16, bool)  # ids that end a word, where the vocabulary tells
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._forget(0)

    def _forget(self, words: int) -> None:
        """An empty table with room for ``words``, and for the usual bound at least."""
        self.room = max(words, CACHED_WORDS)
        slots = 1 << (2 * self.room).bit_length()
        self.names, self.entry = np.zeros(slots, np.uint64), np.zeros(slots, np.int32)
        self.begins, self.flat = np.zeros(1, np.int64), np.zeros(0, "<u2")

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(65 - len(self.names).bit_length())).astype(np.int64)

    def _entries(self, hashes: np.ndarray) -> np.ndarray:
        """Places of words in the table, -1 where a word is not known."""
        slot = self._slots(hashes)
        name = self.names[slot]
        out = np.where(name == hashes, self.entry[slot], -1)
        other = np.flatnonzero((name != hashes) & (name != 0))
        while len(other):
            slot[other] = (slot[other] + 1) % len(self.names)
            name = self.names[slot[other]]
            same = name == hashes[other]
            out[other[same]] = self.entry[slot[other[same]]]
            other = other[~same & (name != 0)]
        return out

    def _add(self, hashes: np.ndarray, words: list[str]) -> None:
        """Learn distinct words that are not known."""
        ids, sizes = self._ids(words)
        known = len(self.begins) - 1
        self.begins = np.append(self.begins, self.begins[-1] + np.cumsum(sizes))
        self.flat = np.append(self.flat, ids)
        left, slot = np.arange(len(hashes)), self._slots(hashes)
        while len(left):
            free = self.names[slot] == 0
            self.names[slot[free]] = hashes[left[free]]  # of words that want one slot, one gets it
            got = self.names[slot] == hashes[left]
            self.entry[slot[got]] = known + left[got]
            left, slot = left[~got], (slot[~got] + 1) % len(self.names)

    def _together(self, tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters only: as one text, of which each is a word to the tokenizer."""
        text = " ".join(words)
        if self.last.any():
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")
            stops = np.flatnonzero(self.last[ids]) + 1
        else:
            found = tokenizer.encode(text, add_special_tokens=False)
            ids, of = np.array(found.ids, "<u2"), np.array(found.word_ids)
            stops = np.flatnonzero(np.append(of[1:] != of[:-1], True)) + 1
        if len(stops) != len(words):  # a letter that is more than a letter in lower case
            return self._apart(words)
        return ids, np.diff(stops, prepend=0)

    def _apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.full.encode_batch_fast(words, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(found)), "<u2"), np.array([len(x) for x in found])

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has."""
        kinds = [[], [], []]  # lower-case ASCII letters, other letters, all else
        for k, word in enumerate(words):
            kinds[(0 if word.isascii() else 1) if word.isalpha() else 2].append(k)
        ids, sizes = [np.zeros(0, "<u2")], [np.zeros(0, np.int64)]
        for some, encode in zip(kinds, (lambda x: self._together(self.plain, x), lambda x: self._together(self.full, x), self._apart)):
            for k in range(0, len(some), 512):
                found, count = encode([words[i] for i in some[k : k + 512]])
                ids.append(found)
                sizes.append(count)
        ids, sizes = np.concatenate(ids), np.concatenate(sizes)
        order = np.argsort(np.concatenate(kinds).astype(np.int64))
        begins = (np.cumsum(sizes) - sizes)[order]
        return _gathered(ids, begins, sizes[order]), sizes[order]

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text with the end token."""
        for first, last in passes(texts):
            yield from self._encode_pass(texts[first:last])

    def _encode_pass(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        data, starts, ends, owner = word_spans(texts)
        starts, ends, owner = _cut_words(data, starts, ends, owner)
        hashes = np.maximum(span_hashes(prefix_hashes(data), starts, ends), np.uint64(1))  # 0 is a free slot
        which = self._entries(hashes)
        new = np.flatnonzero(which < 0)
        if len(new):
            names, at = np.unique(hashes[new], return_index=True)
            if len(self.begins) - 1 + len(names) > self.room:
                new = np.arange(len(hashes))
                names, at = np.unique(hashes, return_index=True)
                self._forget(len(names))
            at = new[at]
            block = data.tobytes()
            self._add(names, [block[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            which[new] = self._entries(hashes[new])
        count = self.begins[which + 1] - self.begins[which]
        ids = _gathered(self.flat, self.begins[which], count)
        borders = np.append(0, np.cumsum(count))[np.searchsorted(owner, np.arange(len(texts) + 1))]
        for text, a, b in zip(texts, borders, borders[1:]):
            # a special token must be seen as it was written, before any change of case
            whole = self.full.encode(text.decode(), add_special_tokens=False).ids if b"<|" in text else ids[a:b]
            yield np.append(whole, END).astype("<u2")


def _gathered(values: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Runs of ``counts`` values from ``begins`` on, one after the other."""
    stops = np.cumsum(counts)
    return values[np.arange(counts.sum()) + np.repeat(begins - stops + counts, counts)]


def _cut_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words cut where ASCII letters and punctuation meet, but not behind an apostrophe, which may belong to what follows."""
    kind = _KIND[data]
    cuts = np.flatnonzero((kind[1:] | kind[:-1] == 3) & (data[:-1] != 39)) + 1
    into = np.searchsorted(starts, cuts, side="right")
    return np.insert(starts, into, cuts), np.insert(ends, into - 1, cuts), np.insert(owner, into, owner[into - 1])


@cache
def _word_ids(path: str) -> WordIds:
    """One for each Python worker, which runs many tasks."""
    return WordIds(path)


class Corpus(NamedTuple):
    """What BM25 knows of all documents."""

    rows: int
    mean: float  # tokens of a document
    holding: np.ndarray  # documents that hold each term

    @property
    def idf(self) -> np.ndarray:
        return np.log1p((self.rows - self.holding + 0.5) / (self.holding + 0.5))

    def weights(self, times: np.ndarray, terms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """BM25 weights of terms in documents of these sizes."""
        return self.idf[terms] * times * (K1 + 1) / (times + K1 * (1 - B + B * sizes / self.mean))

    @staticmethod
    def of(documents: list[np.ndarray]) -> Corpus:
        """Counts of a list of documents."""
        sizes = np.array([len(x) for x in documents], np.int64)
        terms, _, _ = _term_counts(documents)
        return Corpus(len(documents), sizes.sum() / max(1, len(documents)), np.bincount(terms, minlength=TERMS))


def _term_counts(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each document but the end token, sorted by term: term, document, times."""
    owner = np.repeat(np.arange(len(documents), dtype=np.int64), [len(x) for x in documents])
    pairs, times = np.unique(np.concatenate(documents).astype(np.int64) << 32 | owner, return_counts=True)
    content = pairs >> 32 != END
    return pairs[content] >> 32, pairs[content] & 0xFFFFFFFF, times[content]


class Index:
    """BM25 over the token ids of one block, with the weights of the corpus."""

    def __init__(self, ids: list[np.ndarray], corpus: Corpus):
        sizes = np.array([len(x) for x in ids])
        terms, self.docs, times = _term_counts(ids)
        self.begins = np.searchsorted(terms, np.arange(TERMS + 1))
        self.holding = np.diff(self.begins)
        self.weights = corpus.weights(times, terms, sizes[self.docs]).astype(np.float32)
        # a term that an eighth of the block holds has a row of weights, which adds up faster than a list
        frequent = np.flatnonzero(self.holding > len(ids) // 8 + 1)
        self.row = np.full(TERMS, -1, np.int64)
        self.row[frequent] = np.arange(len(frequent))
        self.rows = np.zeros((len(frequent), len(ids)), np.float32)
        for k, t in enumerate(frequent):
            self.rows[k, self.docs[self.begins[t] : self.begins[t + 1]]] = self.weights[self.begins[t] : self.begins[t + 1]]
        self.ids = ids

    def scores(self, doc: int) -> np.ndarray:
        """What every document of the block gets for the terms of one."""
        terms = np.sort(self.ids[doc]).astype(np.int64)
        terms = terms[np.append(terms[1:] != terms[:-1], True)]
        terms = terms[self.holding[terms] > 1]
        row = self.row[terms]
        out = self.rows[row[row >= 0]].sum(0)
        rare = terms[row < 0]
        if len(rare):
            begin, count = self.begins[rare], self.holding[rare]
            stop = np.cumsum(count)
            places = np.arange(stop[-1]) + np.repeat(begin - stop + count, count)
            out = out + np.bincount(self.docs[places], self.weights[places], len(self.ids))
        return out

    def neighbours(self, doc: int, used: np.ndarray) -> Iterator[int]:
        """All unused documents that share a term with the seed, best first, ties in order."""
        scores = self.scores(doc)
        scores[used] = 0
        scores[doc] = 0
        found = np.flatnonzero(scores)
        if len(found) > FIRST_ASKED:
            bound = -np.partition(-scores[found], FIRST_ASKED - 1)[FIRST_ASKED - 1]
            best = found[scores[found] >= bound]
            yield from best[np.argsort(-scores[best], kind="stable")].tolist()
            found = found[scores[found] < bound]
        yield from found[np.argsort(-scores[found], kind="stable")].tolist()


class Windows:
    """Open window of a shard and the finished pieces."""

    def __init__(self, shard: int):
        self.next, self.open, self.fill, self.done = shard << 40, [], 0, []

    def put(self, doc, ids: np.ndarray, start: int) -> int:
        """Place what fits of a document from ``start`` on; returns how far it got."""
        stop = min(len(ids), start + WINDOW - self.fill)
        self.open.append((doc, ids, start, stop))
        self.fill += stop - start
        if self.fill == WINDOW:
            self.close(WINDOW)
        return stop

    def close(self, length: int) -> None:
        """Finish a sequence with the first ``length`` open tokens."""
        offset = 0
        while offset < length:
            doc, ids, start, stop = self.open.pop(0)
            if stop - start > length - offset:
                self.open.insert(0, (doc, ids, start + length - offset, stop))
                stop = start + length - offset
            self.done.append((doc, start, stop - start, crc(ids[start:stop].astype("<u4").tobytes()), len(ids), self.next, offset, length))
            offset += stop - start
        self.next += 1
        self.fill -= length

    def finish(self) -> None:
        while self.fill:
            self.close(1 << self.fill.bit_length() - 1)

    def batches(self) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PIECES.split(", ")]
        if self.done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*self.done)], names=names)
            self.done = []


def _pack_block(docs: list, ids: list[np.ndarray], corpus: Corpus, windows: Windows) -> None:
    index = Index(ids, corpus)
    used = np.zeros(len(ids), bool)
    seed, begun = None, 0
    unseen = 0
    while True:
        if seed is None:
            while unseen < len(ids) and used[unseen]:
                unseen += 1
            if unseen == len(ids):
                return
            seed, begun = unseen, 0
            used[seed] = True
        place = begun
        while place < len(ids[seed]):
            place = windows.put(docs[seed], ids[seed], place)
        left = None
        if windows.fill:
            for other in index.neighbours(seed, used):
                used[other] = True
                place = windows.put(docs[other], ids[other], 0)
                if place < len(ids[other]):
                    left = (other, place)
                if not windows.fill:
                    break
        seed, begun = left if left else (None, 0)


_TOKENS = "doc_id long, ids binary, tokens long"


def _tokenizer(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(path)
        for batch in batches:
            for first, texts in text_ranges(batch.column("text"), STEP_BYTES):
                found = [x.tobytes() for x in words.encode(texts)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), pa.array(found, pa.binary()), pa.array([len(x) // 2 for x in found], pa.int64())], names=["doc_id", "ids", "tokens"])
    return encode


def _id_lists(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in batch.column("ids").to_pylist()]


def _holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task that hold each term."""
    _word_ids.cache_clear()  # this worker may have tokenised before; its words are not needed any more
    counts = np.zeros(TERMS, np.int64)
    for batch in batches:
        for first, last in _ranges(lists := _id_lists(batch)):
            counts += np.bincount(_term_counts(lists[first:last])[0], minlength=TERMS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())], names=["term", "n"])


def _ranges(lists: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Ranges of documents with a bounded number of tokens, one document at least."""
    ends = np.cumsum([len(x) for x in lists])
    first = 0
    while first < len(lists):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + STEP_BYTES // 2, side="right")))
        yield first, last
        first = last


def corpus_counts(tokens: DataFrame) -> Corpus:
    """Frequencies of all terms over a table of token ids: one row a term, at most the vocabulary, reaches the driver."""
    rows, total = tokens.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    holding = np.zeros(TERMS, np.int64)
    for r in tokens.select("ids").mapInArrow(_holding, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        holding[r["term"]] = r["n"]
    return Corpus(rows, (total or 0) / max(1, rows), holding)


def _placer(corpus: Corpus):
    """Adds the two terms of greatest weight in each document, of those that another document has; -1 where there is none."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _word_ids.cache_clear()
        pieces = np.append(np.ceil(corpus.holding * corpus.mean / BLOCK_TOKENS).astype(np.int64), 0)  # blocks of each term; a document without one may go anywhere
        pieces[-1] = corpus.rows
        for batch in batches:
            lists = _id_lists(batch)
            best = np.full((2, len(lists)), -1, np.int32)
            for first, last in _ranges(lists):
                sizes = np.array([len(x) for x in lists[first:last]])
                terms, docs, times = _term_counts(lists[first:last])
                shared = corpus.holding[terms] > 1
                terms, docs, times = terms[shared], docs[shared], times[shared]
                order = np.lexsort((terms, -corpus.weights(times, terms, sizes[docs]), docs))
                docs, terms = docs[order], terms[order]
                begin, end = (np.searchsorted(docs, np.arange(last - first), side=x) for x in ("left", "right"))
                for k in range(2):
                    some = np.flatnonzero(end - begin > k)
                    best[k, first + some] = terms[begin[some] + k]
            salt = mix(batch.column("_at").to_numpy().astype(np.uint64)).astype(np.int64) >> 1
            yield pa.RecordBatch.from_arrays([pa.array(best[0], pa.int32()), pa.array(best[1], pa.int32()), pa.array(salt % pieces[best[0]], pa.int64()), *batch.columns], names=["_first", "_second", "_salt", *batch.schema.names])
    return place


def _packer(corpus: Corpus):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _word_ids.cache_clear()
        windows = Windows(TaskContext.get().partitionId())
        docs, ids, size = [], [], 0
        for batch in batches:
            for name, found in zip(batch.column("doc_id").to_pylist(), _id_lists(batch)):
                docs.append(name)
                ids.append(found)
                size += len(found)
                if size >= BLOCK_TOKENS:
                    _pack_block(docs, ids, corpus, windows)
                    yield from windows.batches()
                    docs, ids, size = [], [], 0
        if ids:
            _pack_block(docs, ids, corpus, windows)
        windows.finish()
        yield from windows.batches()
    return pack


def token_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian 16-bit, with the end token) and ``tokens`` of every row, written once."""
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return kept_table(docs.mapInArrow(_tokenizer(tokenizer), _TOKENS))


def by_content(tokens: DataFrame, corpus: Corpus, shards: int) -> DataFrame:
    """The rows in ``shards`` partitions by their best term and its salt, in the order of their two best terms."""
    numbered = tokens.withColumn("_at", F.monotonically_increasing_id())  # of a written table: the same whenever it is read
    placed = numbered.mapInArrow(_placer(corpus), f"_first int, _second int, _salt long, {_TOKENS}, _at long")
    return placed.repartition(shards, "_first", "_salt").sortWithinPartitions("_first", "_salt", "_second", "_at")


def pack(docs: DataFrame, tokenizer: str, shards: int | None = None) -> DataFrame:
    """Pieces of all documents: which ids of which document stand where in which sequence.

    ``tokenizer`` is the path of a vocabulary file on every worker. A shard holds about one
    block of tokens unless a number of ``shards`` is given.
    """
    tokens = token_table(docs, tokenizer)
    corpus = corpus_counts(tokens)
    shards = shards or shards_for(int(corpus.mean * corpus.rows), BLOCK_TOKENS)
    return by_content(tokens, corpus, shards).select("doc_id", "ids").mapInArrow(_packer(corpus), PIECES)
