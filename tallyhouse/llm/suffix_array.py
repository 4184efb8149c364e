"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. Sorting the
leftmost-S suffixes (LMS) induces the order of all others in two linear sweeps over the
buckets of first symbols. LMS substrings are sorted by the same sweeps, named, and where
names repeat the text of names is sorted by recursion.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its right neighbour; the last one (the sentinel) is."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int64)))
    at = np.where(step != 0, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]  # the next place where the symbol changes
    smaller = np.ones(n, bool)
    inside = at < n
    smaller[:-1][inside] = step[at[inside]] > 0
    smaller[:-1][~inside] = False
    return smaller


def _sweeps_by_bucket(text, smaller, starts, ends, seeds):
    """Both induction sweeps, one bucket at a time with all its ready entries at once."""
    n = len(text)
    order = np.full(n, -1, np.int64)

    def put(block, wanted, pointers, direction):
        j = block[block > 0] - 1
        j = j[smaller[j] == wanted]
        if not len(j):
            return
        symbols = text[j]
        by = np.argsort(symbols, kind="stable")
        j, symbols = j[by], symbols[by]
        first = np.ones(len(j), bool)
        first[1:] = symbols[1:] != symbols[:-1]
        begin = np.flatnonzero(first)
        count = np.diff(np.append(begin, len(j)))
        rank = np.arange(len(j)) - np.repeat(begin, count)
        order[pointers[symbols] + direction * rank] = j
        pointers[symbols[begin]] += direction * count

    # seeds come sorted; each bucket keeps them at its end
    seed_symbols = text[seeds]
    count = np.bincount(seed_symbols, minlength=len(starts))
    seed_begin = np.cumsum(count) - count
    heads = starts.copy()
    used = np.flatnonzero(ends > starts)
    for c in used:
        lo = starts[c]
        while lo < heads[c]:
            hi = heads[c]
            put(order[lo:hi], False, heads, 1)
            lo = hi
        if count[c]:
            put(seeds[seed_begin[c] : seed_begin[c] + count[c]], False, heads, 1)
    tails = ends - 1
    for c in used[::-1]:
        hi = ends[c] - 1
        while hi > tails[c]:
            lo = tails[c]
            put(order[lo + 1 : hi + 1][::-1], True, tails, -1)
            hi = lo
        put(order[starts[c] : heads[c]][::-1], True, tails, -1)
    order[0] = n - 1  # the sentinel has no larger neighbour that could induce it
    return order


def _sweeps_by_entry(text, smaller, starts, ends, seeds):
    """The same sweeps entry by entry, for alphabets with few entries in a bucket.

    Buckets are lists that grow while they are read. Where the left neighbour of a place goes
    in a sweep is looked up beforehand, -1 if it is not of the sweep's kind.
    """
    n, size = len(text), len(starts)
    before = np.empty(n, np.int64)
    before[0] = -1
    before[1:] = text[:-1]
    before_small = np.append(False, smaller[:-1])
    to_large = np.where(before_small, -1, before).tolist()
    to_small = np.where(before_small, before, -1).tolist()
    large: list[list[int]] = [[] for _ in range(size)]
    seeded: list[list[int]] = [[] for _ in range(size)]
    for i, c in zip(seeds.tolist(), text[seeds].tolist()):
        seeded[c].append(i)
    for c in range(size):
        for i in large[c]:
            t = to_large[i]
            if t >= 0:
                large[t].append(i - 1)
        for i in seeded[c]:
            t = to_large[i]
            if t >= 0:
                large[t].append(i - 1)
    small: list[list[int]] = [[] for _ in range(size)]
    for c in range(size - 1, -1, -1):
        for i in small[c]:
            t = to_small[i]
            if t >= 0:
                small[t].append(i - 1)
        for i in reversed(large[c]):
            t = to_small[i]
            if t >= 0:
                small[t].append(i - 1)
    small[0] = [n - 1]
    order: list[int] = []
    for c in range(size):
        order += large[c]
        order += reversed(small[c])
    return np.array(order, np.int64)


def _named(text: np.ndarray, lms: np.ndarray, sorted_lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of LMS substrings in text order, equal for equal substrings, in sorted order."""
    n = len(text)
    length = np.zeros(n, np.int64)
    length[lms[:-1]] = np.diff(lms) + 1  # up to and with the next LMS place
    length[lms[-1]] = 1
    a, b = sorted_lms[:-1], sorted_lms[1:]
    equal = length[a] == length[b]
    k, open_ = 0, np.flatnonzero(equal)
    while len(open_):
        same = text[a[open_] + k] == text[b[open_] + k]
        equal[open_[~same]] = False
        k += 1
        open_ = open_[same]
        open_ = open_[length[a[open_]] > k]
    names = np.zeros(len(sorted_lms), np.int64)
    names[1:] = np.cumsum(~equal)
    by_place = np.zeros(n, np.int64)
    by_place[sorted_lms] = names
    return by_place[lms], int(names[-1]) + 1


def _sorted(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of a text whose last symbol, 0, occurs only there."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    smaller = _types(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    counts = np.bincount(text, minlength=symbols)
    ends = np.cumsum(counts)
    starts = ends - counts
    sweeps = _sweeps_by_bucket if symbols * 64 < n else _sweeps_by_entry
    rough = sweeps(text, smaller, starts, ends, lms[np.argsort(text[lms], kind="stable")])
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    names, distinct = _named(text, lms, rough[is_lms[rough]])
    if distinct < len(lms):
        by_rank = lms[_sorted(names, distinct)]
    else:
        by_rank = np.empty(len(lms), np.int64)
        by_rank[names] = lms
    return sweeps(text, smaller, starts, ends, by_rank)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places of all suffixes of ``data`` (whole numbers from 0) in sorted order."""
    if not len(data):
        return np.zeros(0, np.int64)
    text = np.zeros(len(data) + 1, np.int64)
    text[:-1] = data
    text[:-1] += 1
    return _sorted(text, int(text.max()) + 1)[1:]


def permuted_prefixes(data: np.ndarray, suffixes: np.ndarray, limit: int) -> np.ndarray:
    """For every place the common prefix with its predecessor in sorted order, at most ``limit``.

    Listed by place in the text, not by rank: walking the text, the value falls by at most
    one a step, and here only places that may still grow are compared further.
    """
    n = len(data)
    out = np.zeros(n, np.int64)
    before = np.full(n, -1, np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    padded = np.full(n + 1, -1, np.int64)
    padded[:n] = data
    stride = 16
    # every 16th place first, from nothing; the others start from what their left neighbour leaves them
    for first in range(min(stride, n)):
        places = np.arange(first, n, stride)
        other = before[places]
        places, other = places[other >= 0], other[other >= 0]
        have = np.maximum(out[places - 1] - 1, 0) if first else np.zeros(len(places), np.int64)
        out[places] = have
        open_ = np.flatnonzero(have < limit)
        while len(open_):
            i, j, h = places[open_], other[open_], out[places[open_]]
            inside = np.maximum(i, j) + h < n
            same = np.zeros(len(open_), bool)
            same[inside] = padded[i[inside] + h[inside]] == padded[j[inside] + h[inside]]
            open_ = open_[same]
            out[places[open_]] += 1
            open_ = open_[out[places[open_]] < limit]
    return out
