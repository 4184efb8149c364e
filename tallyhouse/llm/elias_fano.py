"""Elias-Fano coded monotone sequences and an n-gram trie of them, mapped from one file."""

from __future__ import annotations

import json
import os
import tempfile

import numpy as np

_BLOCK = 1 << 18  # values, or bytes of bits, that are coded or read at once; a multiple of 8
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.int64)
_PLACE = np.zeros((256, 8), np.int64)  # place of the k-th set bit of a byte
for _b in range(256):
    _set = [i for i in range(8) if _b >> i & 1]
    _PLACE[_b, : len(_set)] = _set


class EliasFano:
    """A non-decreasing sequence in about 2 + log2(universe / length) bits a value.

    High parts are unary in a bit vector with a count of ones before every 64 bits; low parts
    are packed side by side. Access and search work on arrays of places at once.
    """

    def __init__(self, parts: dict[str, np.ndarray], name: str):
        self.length, self.width = (int(x) for x in parts[f"{name}.shape"])
        self.high, self.before, self.low = parts[f"{name}.high"], parts[f"{name}.before"], parts[f"{name}.low"]

    @staticmethod
    def parts(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        width = max(0, (top // max(1, n)).bit_length() - 1)
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        size = (int(ones[-1]) // 64 + 2) * 8 if n else 16
        bits = np.zeros(size * 8, np.uint8)
        bits[ones] = 1
        before = np.zeros(size // 8 + 1, np.uint32)
        before[1:] = np.cumsum(bits.reshape(-1, 64).sum(1, dtype=np.int64))
        packed = np.concatenate([np.zeros(0, np.uint8), *(  # blocks of values whose bits fill bytes
            np.packbits((values[a : a + _BLOCK, None] >> np.arange(width, dtype=np.uint64)[None, :] & np.uint64(1)).astype(np.uint8).reshape(-1), bitorder="little") for a in range(0, n, _BLOCK))])
        return {f"{name}.shape": np.array([n, width], np.int64), f"{name}.high": np.packbits(bits, bitorder="little"), f"{name}.before": before, f"{name}.low": np.append(packed, np.zeros(8, np.uint8))}

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, places, side="right") - 1
        left = places - self.before[word].astype(np.int64)
        at = np.full(len(places), -1, np.int64)
        for k in range(8):  # the byte of the word that holds the wanted one
            byte = self.high[word * 8 + k]
            ones = _ONES[byte]
            here = (at < 0) & (left < ones)
            at[here] = word[here] * 64 + k * 8 + _PLACE[byte[here], left[here]]
            left = np.where(at < 0, left - ones, left)
        return (at - places).astype(np.uint64) << np.uint64(self.width) | self._low(places)

    def _low(self, places: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(places), np.uint64)
        bit = places * self.width
        first, shift = bit >> 3, (bit & 7).astype(np.uint64)
        low = np.zeros(len(places), np.uint64)
        for k in range((self.width + 14) // 8):
            low |= self.low[first + k].astype(np.uint64) << np.uint64(8 * k)
        return low >> shift & np.uint64((1 << self.width) - 1)

    def values(self) -> np.ndarray:
        """The whole sequence, read from end to end."""
        ones = np.concatenate([np.zeros(0, np.int64), *(
            a * 8 + np.flatnonzero(np.unpackbits(self.high[a : a + _BLOCK], bitorder="little")) for a in range(0, len(self.high), _BLOCK))])
        out = (ones - np.arange(self.length)).astype(np.uint64) << np.uint64(self.width)
        for a in range(0, self.length, _BLOCK):
            out[a : a + _BLOCK] |= self._low(np.arange(a, min(a + _BLOCK, self.length)))
        return out

    def many(self, n: int) -> bool:
        """Whether reading the whole sequence costs less than ``n`` searches."""
        return n * 16 > self.length

    def taken(self, places: np.ndarray) -> np.ndarray:
        return self.values()[places] if self.many(len(places)) else self[places]

    def places(self, wanted: np.ndarray) -> np.ndarray:
        """First place of each wanted value in the whole sequence, or -1."""
        values = self.values()
        at = np.searchsorted(values, wanted)
        here = at < self.length
        here[here] = values[at[here]] == wanted[here]
        return np.where(here, at, -1)

    def find(self, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted value in [low, high), or -1: search for the successor, then a look."""
        lo, hi = low.copy(), high.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            middle = (lo[open_] + hi[open_]) >> 1
            less = self[middle] < wanted[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]
            open_ = open_[lo[open_] < hi[open_]]
        found = np.full(len(lo), -1, np.int64)
        inside = np.flatnonzero(lo < high)
        same = self[lo[inside]] == wanted[inside]
        found[inside[same]] = lo[inside[same]]
        return found


def quantised(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes and the 256 values they stand for: ends, and equal shares of the uses in between."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(256)
    order = np.argsort(values, kind="stable")
    uses = np.cumsum(weights[order], dtype=np.float64)
    book = values[order][np.searchsorted(uses, (np.arange(256) + 0.5) / 256 * uses[-1])]
    book[0], book[-1] = values[order[0]], values[order[-1]]
    return np.searchsorted((book[1:] + book[:-1]) / 2, values).astype(np.uint8), book


def packed_file(parts: dict[str, np.ndarray]) -> bytes:
    """All arrays in one block of bytes behind a header that says where they are."""
    head, body, at = {}, [], 0
    for name, array in parts.items():
        array = np.ascontiguousarray(array)
        head[name] = (array.dtype.str, len(array), at)
        padded = array.tobytes() + b"\0" * (-array.nbytes % 8)
        body.append(padded)
        at += len(padded)
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(body)


def mapped_file(data: bytes) -> dict[str, np.ndarray]:
    """Arrays of a packed block, mapped from a file of this worker that has no name any more."""
    handle, path = tempfile.mkstemp()
    with os.fdopen(handle, "wb") as out:
        out.write(data)
    block = np.memmap(path, np.uint8, "r")
    os.unlink(path)  # the mapping lives on; nothing is left behind
    size = int.from_bytes(bytes(block[:8]), "little")
    head = json.loads(bytes(block[8 : 8 + size]))
    return {name: block[8 + size + at : 8 + size + at + np.dtype(kind).itemsize * n].view(kind) for name, (kind, n, at) in head.items()}


def _hashed(keys: np.ndarray) -> np.ndarray:
    return keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)


class Trie:
    """Back-off trigram model: levels of Elias-Fano values, pointers and quantised logarithms.

    Level 2 holds the successors of every word, level 3 the successors of every word pair. A
    word of level 3 is not named by its number but by its place among the successors of the
    middle word in level 2, which is a smaller number.
    """

    def __init__(self, data: bytes):
        p = mapped_file(data)
        self.words, self.reach = (int(x) for x in p["sizes"])
        self.one, self.one_back = p["one"], p["one_back"]
        self.two, self.three = EliasFano(p, "two"), EliasFano(p, "three")
        self.two_begin, self.three_begin = EliasFano(p, "two_begin"), EliasFano(p, "three_begin")
        self.two_code, self.two_book, self.two_back, self.two_back_book = p["two_code"], p["two_book"], p["two_back"], p["two_back_book"]
        self.three_code, self.three_book = p["three_code"], p["three_book"]
        # a bit map of hashed pairs spares the search for most pairs that are not there
        self.seen = np.zeros(1 << 24, bool)
        self.seen[_hashed(self.two.values())] = True

    @staticmethod
    def build(counts: np.ndarray, context: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, triples: np.ndarray, triple_counts: np.ndarray, discount: float, smooth: np.ndarray | None = None, back: np.ndarray | None = None) -> bytes:
        """A model from counts of words, of words as contexts, and of kept pairs (first, second) and triples.

        ``pairs`` are rows of two columns sorted by them, ``triples`` of three. A kept n-gram has
        its count less a discount over that of its context; what is left of a context goes to the
        words that are not kept after it, in proportion to the lower order. A trie of a part of
        the pairs is given the probabilities of words and their back-off.
        """
        words = len(counts)
        smooth = (counts + 0.1) / (counts.sum() + 0.1 * words) if smooth is None else smooth
        share = (pair_counts - discount) / np.maximum(context[pairs[:, 0]], 1)
        if back is None:
            back = (1 - np.bincount(pairs[:, 0], share, words)) / np.maximum(1 - np.bincount(pairs[:, 0], smooth[pairs[:, 1]], words), 1e-6)
        two = share
        two_begin = np.searchsorted(pairs[:, 0], np.arange(words + 1))
        keys = pairs[:, 0] * words + pairs[:, 1]
        parent = np.searchsorted(keys, triples[:, 0] * words + triples[:, 1])
        middle = np.searchsorted(keys, triples[:, 1] * words + triples[:, 2])
        three_share = (triple_counts - discount) / pair_counts[parent]
        two_back = (1 - np.bincount(parent, three_share, len(pairs))) / np.maximum(1 - np.bincount(parent, two[middle], len(pairs)), 1e-6)
        three = three_share
        relative = middle - two_begin[triples[:, 1]]
        reach = int(np.diff(two_begin).max()) + 1
        pad = lambda codes: np.append(codes, np.uint8(0))  # what place -1, not found, reads
        log = lambda x: np.log10(np.maximum(x, 1e-30))
        code, book = quantised(log(two), pair_counts)
        back_code, back_book = quantised(log(two_back), pair_counts)
        three_code, three_book = quantised(log(three), triple_counts)
        order = np.lexsort((relative, parent))
        parts = {"sizes": np.array([words, reach], np.int64), "one": log(smooth).astype(np.float32), "one_back": log(back).astype(np.float32)}
        parts |= EliasFano.parts(keys, "two") | EliasFano.parts(two_begin, "two_begin")
        parts |= EliasFano.parts((parent * reach + relative)[order], "three") | EliasFano.parts(np.searchsorted(parent[order], np.arange(len(pairs) + 1)), "three_begin")
        parts |= {"two_code": pad(code), "two_book": book, "two_back": pad(back_code), "two_back_book": back_book, "three_code": pad(three_code[order]), "three_book": three_book}
        return packed_file(parts)

    def pair_places(self, keys: np.ndarray) -> np.ndarray:
        """Places of pairs (first word times the number of words, plus the second) in level 2, or -1."""
        out = np.full(len(keys), -1, np.int64)
        maybe = np.flatnonzero(self.seen[_hashed(keys.astype(np.uint64))])
        if self.two.many(len(maybe)):
            out[maybe] = self.two.places(keys[maybe].astype(np.uint64))
            return out
        first = keys[maybe] // self.words
        out[maybe] = self.two.find(self.two_begin[first].astype(np.int64), self.two_begin[first + 1].astype(np.int64), keys[maybe].astype(np.uint64))
        return out

    def scores(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
        """log10 p(third | first, second); a first word of -1 leaves one word of context."""
        keys, which = np.unique(second * self.words + third, return_inverse=True)
        places = self.pair_places(keys)[which]
        known = places >= 0
        out = np.where(known, self.two_book[self.two_code[places]], self.one_back[second] + self.one[third].astype(np.float64))
        before = np.flatnonzero(first >= 0)
        keys, which = np.unique(first[before] * self.words + second[before], return_inverse=True)
        parent = self.pair_places(keys)[which]
        before, parent = before[parent >= 0], parent[parent >= 0]
        out[before] += self.two_back_book[self.two_back[parent]]
        both = known[before]
        before, parent = before[both], parent[both]
        relative = places[before] - self.two_begin.taken(second[before]).astype(np.int64)
        keys, which = np.unique(parent * self.reach + relative, return_inverse=True)
        if self.three.many(len(keys)):
            found = self.three.places(keys.astype(np.uint64))[which]
        else:
            parent = keys // self.reach
            found = self.three.find(self.three_begin[parent].astype(np.int64), self.three_begin[parent + 1].astype(np.int64), keys.astype(np.uint64))[which]
        seen = found >= 0
        out[before[seen]] = self.three_book[self.three_code[found[seen]]]
        return out
