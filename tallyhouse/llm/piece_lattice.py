"""SentencePiece encoding with the N best segmentations, and decoding.

The pieces and scores of a model file span a lattice over the characters of a text. Forward
Viterbi gives the best score of every prefix. Segmentations are then listed best first by an
A-star search from the end back to the start, for which those scores are exact estimates of
what remains. No piece crosses from a word into the next white space, so the lattice falls
into units of a word with the white space before it: each distinct unit is solved once, with
the score gap to its second best, and only the units with the smallest gaps of a text, which
alone can take part in its N best segmentations, are searched.

Defined results: null and empty texts have no pieces and one segmentation, the empty one, with
score 0. A text with fewer than N segmentations lists those it has. Characters without a
piece fall back to the pieces of their bytes. A text that itself holds the white space mark
(U+2581) does not come back as it was, and ``round_trip`` says so. Null and repeated ids are
carried as they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.common import binary_texts, crc, mix, passes, powers

BEST = 4
MARK = "▁"
CACHED_UNITS = 3 << 18
_WHOLE_UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
_UNIT = re.compile(f"{MARK}*[^{MARK}\n\0]+|{MARK}+|\n")
_LETTER = re.compile(r"[^\W\d_]")
TOGETHER = 64  # characters of the longest unit that is solved together with others


def _span(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of characters, from their running sums."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts] + (ends - starts).astype(np.uint64))


class Lattice:
    """Pieces of a model file and the solved units."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and model.get_score(i) > -1e8]
        self.score = {self.text[i]: model.get_score(i) for i in normal}
        self.id = {self.text[i]: i for i in normal}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece of this model holds white space behind other characters")
        self.longest = max(map(len, self.id))
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = min(self.score.values()) - 10.0  # a byte costs more than any piece
        if MARK not in self.id:  # white space must not fall back to the bytes of its mark
            self.id[MARK], self.score[MARK] = model.piece_to_id(MARK), self.fallback
        self.bytes = [p.replace(MARK, " ").encode() for p in self.text]
        for b, i in enumerate(self.byte):
            self.bytes[i] = bytes([b])
        self.piece_sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.piece_begins = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.piece_data = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.single = {p for p in self.id if len(p) == 1}
        self.id_scores = np.array([self.score.get(p, 0.0) for p in self.text])
        names = list(self.id)
        joined = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
        sums = np.append(np.uint64(0), np.cumsum(mix(joined.astype(np.uint64) + np.uint64(1)) * powers(len(joined))[0][: len(joined)]))
        ends = np.cumsum([len(p) for p in names])
        hashes = _span(sums, ends - [len(p) for p in names], ends)
        order = np.argsort(hashes)
        self.hashes, self.hash_ids = hashes[order], np.array([self.id[p] for p in names], np.int32)[order]
        self.seen = np.zeros(1 << 20, bool)  # tells most strings that are no pieces apart
        self.seen[self.hashes >> np.uint64(44)] = True
        # where the hashes with some first bits begin, and how many share those at most
        self.first = np.minimum(np.searchsorted(self.hashes >> np.uint64(44), np.arange(1 << 20, dtype=np.uint64)), len(self.hashes) - 1)
        self.deep = int(np.unique(self.hashes >> np.uint64(44), return_counts=True)[1].max())
        # a stop behind a letter begins a unit of its own if no piece holds the two side by side
        stops = "".join(c for c in ".,;:!?" if not any(_LETTER.match(x) and y == c for p in self.id for x, y in zip(p, p[1:])))
        # (told from the stop backwards, as the few stops are found faster than the many letters)
        self.cut = re.compile(f"([{re.escape(stops)}])(?<={_LETTER.pattern}[{re.escape(stops)}])") if stops else None
        self.units: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.best: list[float] = []
        self.gap: list[float] = []
        self.found: dict[str, list] = {}
        self._forget()

    def _forget(self) -> None:
        """No units in the arrays, which hold the same as the lists for many units at once."""
        self.all_ids, self.all_sizes, self.all_begins = np.zeros(0, "<u2"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.all_best, self.all_gaps = np.zeros(0), np.zeros(0)

    def _gathered(self) -> None:
        """Units solved since the last call, added to the arrays."""
        known = len(self.all_sizes)
        if known == len(self.ids):
            return
        new = self.ids[known:]
        self.all_sizes = np.append(self.all_sizes, np.fromiter(map(len, new), np.int64, len(new)) // 2)
        self.all_begins = np.cumsum(self.all_sizes) - self.all_sizes
        self.all_ids = np.append(self.all_ids, np.frombuffer(b"".join(new), "<u2"))
        self.all_best, self.all_gaps = np.append(self.all_best, self.best[known:]), np.append(self.all_gaps, self.gap[known:])

    def edges(self, unit: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For every place the pieces that end there: begin, score, ids."""
        out: list[list] = [[] for _ in range(len(unit) + 1)]
        score, ids = self.score, self.id
        for begin in range(len(unit)):
            for end in range(begin + 1, min(len(unit), begin + self.longest) + 1):
                piece = unit[begin:end]
                if piece in score:
                    out[end].append((begin, score[piece], (ids[piece],)))
                elif end == begin + 1:
                    data = piece.encode()
                    out[end].append((begin, self.fallback * len(data), tuple(self.byte[b] for b in data)))
        return out

    def forward(self, edges: list) -> tuple[list[float], list[float], list]:
        """Best and second best score of every prefix, and the last edge of the best."""
        low = float("-inf")
        best, second, last = [0.0], [low], [None]
        for at in range(1, len(edges)):
            a, b, take = low, low, None
            for edge in edges[at]:
                begin, score, _ = edge
                x = best[begin] + score
                if x > a:
                    a, b, take = x, a, edge
                elif x > b:
                    b = x
                y = second[begin] + score
                if y > b:
                    b = y
            best.append(a)
            second.append(b)
            last.append(take)
        return best, second, last

    def learn(self, units: Iterable[str]) -> None:
        """Solve the units that are not known, most of them together."""
        new = [u for u in units if u not in self.units] if self.units else list(units)
        if len(self.units) + len(new) > CACHED_UNITS:
            self.units.clear()
            self.found.clear()
            self.ids, self.best, self.gap = [], [], []
            self._forget()
            new = list(units)
        plain = [u for u in new if len(u) <= TOGETHER and self.single.issuperset(u)]
        for i in range(0, len(plain), 1 << 15):
            self._solve_together(plain[i : i + (1 << 15)])
        for u in new:
            if u not in self.units:
                self.solve(u)
        self._gathered()

    def _solve_together(self, units: list[str]) -> None:
        """The same as :meth:`solve` for many units, place by place in all of them at once.

        Every character of these units is a piece, so the best segmentation has no bytes.
        """
        units = sorted(units, key=len, reverse=True)
        sizes = np.array([len(u) for u in units])
        begins = np.cumsum(sizes) - sizes
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        sums = np.append(np.uint64(0), np.cumsum(mix(chars.astype(np.uint64) + np.uint64(1)) * powers(len(chars))[0][: len(chars)]))
        inside = np.repeat(sizes, sizes) - (np.arange(len(chars)) - np.repeat(begins, sizes))  # characters to the unit's end
        pieces = np.full((self.longest + 1, len(chars)), -1, np.int32)
        for k in range(1, min(self.longest, int(sizes[0])) + 1):
            at = np.flatnonzero(inside >= k)
            hashed = _span(sums, at, at + k)
            maybe = self.seen[hashed >> np.uint64(44)]
            at, hashed = at[maybe], hashed[maybe]
            place = self.first[hashed >> np.uint64(44)]
            real = self.hashes[place] == hashed
            for _ in range(self.deep - 1):
                off = np.flatnonzero(~real)
                place[off] = np.minimum(place[off] + 1, len(self.hashes) - 1)
                real[off] = self.hashes[place[off]] == hashed[off]
            pieces[k, at[real]] = self.hash_ids[place[real]]
        nodes = begins + np.arange(len(units))  # a unit has one node more than characters
        best, second, step = (np.full(len(chars) + len(units), x) for x in (-np.inf, -np.inf, 0))
        best[nodes] = 0.0
        for t in range(1, int(sizes[0]) + 1):
            live = int(np.searchsorted(-sizes, -t, side="right"))
            here, chars_at = nodes[:live] + t, begins[:live] + t
            a, b, take = np.full(live, -np.inf), np.full(live, -np.inf), np.zeros(live, np.int64)
            for k in range(min(self.longest, t), 0, -1):
                piece = pieces[k, chars_at - k]
                some = np.flatnonzero(piece >= 0)
                if not len(some):
                    continue
                score = self.id_scores[piece[some]]
                x, y = best[here[some] - k] + score, second[here[some] - k] + score
                more = x > a[some]
                b[some] = np.maximum(np.where(more, a[some], np.maximum(b[some], x)), y)
                take[some[more]] = k
                a[some[more]] = x[more]
            best[here], second[here], step[here] = a, b, take
        # back from the ends, one piece of every unit at a time
        at, live, found = sizes.copy(), np.arange(len(units)), []
        while len(live):
            k = step[nodes[live] + at[live]].astype(np.int64)
            at[live] -= k
            found.append((live, pieces[k, begins[live] + at[live]]))
            live = live[at[live] > 0]
        owner, ids = np.concatenate([f[0] for f in found][::-1]), np.concatenate([f[1] for f in found][::-1])
        order = np.argsort(owner, kind="stable")
        flat = ids[order].astype("<u2").tobytes()
        cuts = (2 * np.searchsorted(owner[order], np.arange(len(units) + 1))).tolist()
        first = len(self.ids)
        self.units.update(zip(units, range(first, first + len(units))))
        self.ids += [flat[a:b] for a, b in zip(cuts, cuts[1:])]
        ends = nodes + sizes
        self.best += best[ends].tolist()
        self.gap += (best[ends] - second[ends]).tolist()

    def solve(self, unit: str) -> int:
        """Number of a unit, solved when it is met first."""
        best, second, last = self.forward(self.edges(unit))
        ids, at = [], len(unit)
        while at:
            ids.append(last[at][2])
            at = last[at][0]
        number = self.units[unit] = len(self.ids)
        self.ids.append(np.array([i for part in reversed(ids) for i in part], "<u2").tobytes())
        self.best.append(best[-1])
        self.gap.append(best[-1] - second[-1])
        return number

    def search(self, unit: str, count: int = BEST) -> list[tuple[float, tuple[int, ...]]]:
        """The best ``count`` segmentations of a unit, by A-star from its end."""
        edges = self.edges(unit)
        best, _, _ = self.forward(edges)
        out, order = [], 0
        # of equal estimates the place nearest to the start goes on; a path is a chain of its parts
        heap = [(-best[-1], len(unit), order, 0.0, None)]
        while heap and len(out) < count:
            total, at, _, behind, path = heapq.heappop(heap)
            if not at:
                ids = []
                while path:
                    ids += path[0]
                    path = path[1]
                out.append((-total, tuple(ids)))
                continue
            for begin, score, part in edges[at]:
                order += 1
                heapq.heappush(heap, (-(best[begin] + score + behind), begin, order, score + behind, (part, path)))
        return out

    def searched(self, unit: str) -> list[tuple[float, tuple[int, ...]]]:
        if unit not in self.found:
            self.found[unit] = self.search(unit)
        return self.found[unit]

    def split(self, text: str) -> list[str]:
        """The units of a text in order."""
        if not text:
            return []
        text = MARK + text.replace(" ", MARK)
        if self.cut is None or "\0" in text:
            return _WHOLE_UNIT.findall(text)
        return _UNIT.findall(self.cut.sub("\0\\1", text))

    def numbers(self, units: list[str]) -> np.ndarray:
        """Numbers of units, which are learned if they are not known."""
        out = np.fromiter(map(self.units.get, units, repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(out < 0).tolist()
        if new:
            missing = {units[i] for i in new}
            if len(self.units) + len(missing) > CACHED_UNITS:  # others are forgotten, so all are learned
                self.learn(set(units))
                return np.fromiter(map(self.units.__getitem__, units), np.int64, len(units))
            self.learn(missing)
            out[new] = [self.units[units[i]] for i in new]
        return out

    def n_best(self, units: list[str], count: int = BEST, numbers: np.ndarray | None = None) -> tuple[np.ndarray, list[float], list[list[tuple[int, tuple[int, ...]]]]]:
        """Ids of the best segmentation, the scores of the best ``count``, and their differences from the best.

        A difference names the units (by place in the text) that are cut in another way, with their ids.
        """
        numbers = self.numbers(units) if numbers is None else numbers
        sizes = self.all_sizes[numbers]
        ends = np.cumsum(sizes)
        ids = self.all_ids[np.arange(sizes.sum()) + np.repeat(self.all_begins[numbers] + sizes - ends, sizes)]
        score = float(sum(self.all_best[numbers].tolist()))
        gaps = self.all_gaps[numbers]
        open_ = np.lexsort((np.arange(len(gaps)), gaps))[: count - 1] if len(gaps) <= 64 else np.argpartition(gaps, count - 1)[: count - 1]
        lists = [(0.0, [])]
        for u in sorted(int(k) for k in open_ if np.isfinite(gaps[k])):
            options = self.searched(units[u])[:count]
            top = options[0][0]
            lists = heapq.nsmallest(count, [(d + top - s, c + [(u, part)] if k else c) for d, c in lists for k, (s, part) in enumerate(options)], key=lambda x: x[0])
        return ids, [score - d for d, _ in lists], [c for _, c in lists]

    def cut_otherwise(self, numbers: np.ndarray, ids: bytes, changes: list[list[tuple[int, tuple[int, ...]]]]) -> Iterator[tuple[bytes, bool]]:
        """Ids of each segmentation that :meth:`n_best` lists, and whether what it cuts in another way still is the same text.

        ``ids``, four bytes each, are those of the best one, which the others share but for the changed units.
        """
        last = max((u for change in changes for u, _ in change), default=-1)
        ends = np.cumsum(self.all_sizes[numbers[: last + 1]])
        for change in changes:
            same, now, at = True, [], 0
            for u, part in sorted(change):
                best, end = self.ids[numbers[u]], 4 * int(ends[u])
                same = same and b"".join(map(self.bytes.__getitem__, part)) == self.spelt(best)
                now += [ids[at : end - 2 * len(best)], np.array(part, "<u4").tobytes()]
                at = end
            yield b"".join([*now, ids[at:]]) if now else ids, same

    def spelt(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u2").tolist()))

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a segmentation: pieces side by side without the first blank."""
        sizes = self.piece_sizes[ids]
        ends = np.cumsum(sizes)
        data = self.piece_data[np.arange(sizes.sum()) - np.repeat(ends - sizes - self.piece_begins[ids], sizes)]
        return data.tobytes()[1:]


@cache
def lattice(path: str) -> Lattice:
    """One for each Python worker, which runs many tasks."""
    return Lattice(path)


_ROWS = "doc_id long, n_pieces long, ids_crc32 long, scores array<double>, round_trip boolean, all_n_pieces array<bigint>, all_ids_crc32 array<bigint>"


def _learned(model: Lattice, texts: list[bytes]) -> Iterator[tuple[bytes, list[str], np.ndarray]]:
    """Texts with their units and the numbers of those, which the model has learned by then."""
    for first, last in passes(texts):
        units = [model.split(t.decode()) for t in texts[first:last]]
        numbers = model.numbers(list(chain.from_iterable(units)))
        cuts = np.cumsum([len(u) for u in units])
        yield from zip(texts[first:last], units, np.split(numbers, cuts[:-1]))


def _encoder(path: str, count: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        for batch in batches:
            rows = []
            for text, units, numbers in _learned(model, binary_texts(batch.column("text"))):
                ids, scores, changes = model.n_best(units, count, numbers)
                found = list(model.cut_otherwise(numbers, ids.astype("<u4").tobytes(), changes))
                sums = [crc(x) for x, _ in found]
                rows.append((len(ids), sums[0], scores, all(same for _, same in found) and model.decode(ids) == text, [len(x) // 4 for x, _ in found], sums))
            sizes, sums, scores, same, every, all_sums = zip(*rows) if rows else ([],) * 6
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(scores, pa.list_(pa.float64())), pa.array(same, pa.bool_()), pa.array(every, longs), pa.array(all_sums, longs)], names=[c.split()[0] for c in _ROWS.split(", ")])
    return encode


def encoded(docs: DataFrame, model: str, count: int = BEST) -> DataFrame:
    """Digest of the best segmentation of every text, and the scores, sizes and digests of the best ``count``.

    ``round_trip``: every one of those spells the text.
    """
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(_encoder(model, count), _ROWS)


def segmented(docs: DataFrame, model: str, count: int = BEST) -> DataFrame:
    """``doc_id``, ``rank``, ``score`` and ``ids`` of the best ``count`` segmentations of every text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = lattice(model)
        for batch in batches:
            for name, (_, units, numbers) in zip(batch.column("doc_id").to_pylist(), _learned(model_, binary_texts(batch.column("text")))):
                _, scores, changes = model_.n_best(units, count, numbers)
                found = []
                for change in changes:
                    parts = [np.frombuffer(model_.ids[n], "<u2").tolist() for n in numbers]
                    for u, part in change:
                        parts[u] = list(part)
                    found.append([i for part in parts for i in part])
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.int64()), pa.array(range(1, len(found) + 1), pa.int32()), pa.array(scores, pa.float64()), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "rank", "score", "ids"])
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(cut, "doc_id long, rank int, score double, ids array<int>")


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` from ``doc_id`` and ``ids``."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = lattice(model)
        for batch in batches:
            texts = [model_.decode(np.array(ids or [], np.int64)).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return rows.selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(join, "doc_id long, text string")
