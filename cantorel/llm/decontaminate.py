"""Benchmark decontamination by q-gram lemma filtering.

A stretch of ``w`` characters of a benchmark item that occurs in a document with at most
``k`` edits shares at least w + 1 - q * (k + 1) of its q-grams with it, on diagonals at
most k apart. Shared q-grams are counted in overlapping bands of diagonals; regions that
reach the bound are kept and verified by alignment within the band. Stretches of 72
characters start at every eighth character, so that each passage of 80 holds one. Texts are
compared lower-cased, with everything but letters and digits as single blanks, as UTF-8
bytes.

Memory does not depend on how repetitive texts are: items are indexed in segments, shared
q-grams are expanded a bounded number at a time, and where a document has more of them than
that, stretch by stretch of the document, each looked at only where it could still change
the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantorel.llm.kernels import _CLASS, _GOLDEN, _LOWER, WORD, chunks, text_bytes
from cantorel.llm.storage import drop, materialize, ship

Q = 8
#: Characters of a compared stretch, the step between stretches of an item, and edits for each ten characters.
STRETCH, STEP, EDITS_PER_TEN = 72, Q, 1
#: Diagonals from one band to the next; a band is twice as wide, so diagonals up to this far apart share one.
BAND = 16
#: Characters of an item that are indexed together; segments overlap by a stretch.
SEGMENT = 1024
#: Characters of a document that are looked at together if it shares over POSTINGS q-grams with the items; these overlap by OVERLAP.
SLICE, OVERLAP = 1024, STRETCH + STRETCH * EDITS_PER_TEN // 10 + Q
#: Shared q-grams that are expanded at once.
POSTINGS = 1 << 19
#: Bytes of benchmark text that one pass over the documents looks for; more items take more passes.
PASS_BYTES = 2 << 20
_BITS = 22
#: Added to diagonals, which are negative where an item starts before its document.
_SHIFT = 2 * SEGMENT
_MOST_EDITS = STRETCH * EDITS_PER_TEN // 10


def edits(width: np.ndarray) -> np.ndarray:
    """Edits that a stretch may have: one for each ten characters, as far as the lemma still asks for a shared q-gram."""
    return np.maximum(np.minimum(width * EDITS_PER_TEN // 10, width // Q - 1), 0)


def normalize(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compared bytes of texts end to end, the place of each in ``data``, and the new offsets."""
    word = _CLASS[data] == WORD
    word &= data != 95
    gap = np.zeros(len(data), bool)
    if len(data):
        gap[1:] = ~word[1:] & word[:-1]
        gap[off[:-1][off[:-1] < len(data)]] = False
    keep = word | gap
    place = np.flatnonzero(keep)
    out = np.where(word[place], _LOWER[data[place]], np.uint8(32))
    return out, place, np.searchsorted(place, off)


def grams(data: np.ndarray) -> np.ndarray:
    """The q-gram at each position as one number."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for s in range(Q):
        m = (len(data) - s) // Q
        part = data[s : s + Q * m].view("<u8")
        out[s::Q] = part[: len(out[s::Q])]
    return out


def _slot(g: np.ndarray) -> np.ndarray:
    return (g * _GOLDEN) >> np.uint64(64 - _BITS)


@dataclass
class Index:
    """Stretches and q-gram postings of benchmark items, which are cut into segments; items under Q characters apart."""

    ids: list[int]
    data: np.ndarray
    off: np.ndarray

    def __post_init__(self) -> None:
        size = np.diff(self.off)
        step = SEGMENT - STRETCH
        parts = np.where(size >= Q, 1 + np.maximum(size - SEGMENT + step - 1, 0) // step, 0)
        self.of = np.repeat(np.arange(len(size)), parts)
        part = np.arange(len(self.of)) - np.repeat(np.cumsum(parts) - parts, parts)
        self.start = self.off[:-1][self.of] + part * step
        self.last = part == parts[self.of] - 1
        self.size = np.where(self.last, self.off[1:][self.of] - self.start, SEGMENT)
        self.width = np.minimum(size[self.of], STRETCH)
        self.budget = edits(self.width)
        self.bound = self.width + 1 - Q * (self.budget + 1)
        every = grams(self.data)
        n = np.maximum(self.size - Q + 1, 0)
        segment = np.repeat(np.arange(len(n)), n)
        pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        g = every[self.start[segment] + pos] if len(pos) else np.zeros(0, np.uint64)
        order = np.argsort(g, kind="stable")  # postings of a q-gram are in the order of segments
        g, self.segment, self.pos = g[order], segment[order].astype(np.int32), pos[order].astype(np.int32)
        self.keys, self.first = np.unique(g, return_index=True)
        self.count = np.diff(np.append(self.first, len(g)))
        self.place = np.repeat(np.arange(len(self.keys)), self.count) * len(self.of) + self.segment  # ascending
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[_slot(self.keys)] = True
        short = np.flatnonzero((size > 0) & (size < Q))
        self.short = {int(w): sorted((self.data[self.off[i] : self.off[i] + w].tobytes(), int(i)) for i in short[size[short] == w]) for w in np.unique(size[short])}

    def stretches(self, segment: int) -> np.ndarray:
        """Where the stretches of a segment start: every STEP characters, and at the item's end."""
        last = int(self.size[segment] - self.width[segment])
        every = np.arange(0, last + 1, STEP)
        return np.append(every, last) if self.last[segment] and every[-1] != last else every

    def shared(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in documents with a q-gram of an item: the document, the place in it, and the q-gram's number."""
        none = np.zeros(0, np.int64)
        if not len(self.keys):
            return none, none, none
        g = grams(data)
        at = np.flatnonzero(self.seen[_slot(g)])
        k = np.minimum(np.searchsorted(self.keys, g[at]), len(self.keys) - 1)
        doc = np.searchsorted(off, at, "right") - 1
        real = (self.keys[k] == g[at]) & (at + Q <= off[doc + 1])
        return doc[real], (at - off[doc])[real], k[real]

    def regions(self, doc: np.ndarray, at: np.ndarray, k: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(document, segment, band, places in the segment of the shared q-grams) where a bound is met, of segments lo to hi."""
        first = np.searchsorted(self.place, k * len(self.of) + lo)
        n = np.searchsorted(self.place, k * len(self.of) + hi) - first
        if n.sum() > POSTINGS and hi - lo > 1:
            middle = (lo + hi) // 2
            yield from self.regions(doc, at, k, lo, middle)
            yield from self.regions(doc, at, k, middle, hi)
            return
        post = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        if not len(post):
            return
        pos, segment = self.pos[post], self.segment[post].astype(np.int64)
        band = (np.repeat(at, n) - pos + _SHIFT) // BAND
        pair = np.repeat(doc, n) * len(self.of) + segment
        bands = int(band.max()) + 2
        key = pair * bands + band
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(key[order]) > 0))
        names, sizes = key[order[starts]], np.diff(np.append(starts, len(key)))
        # a region is a band's half and the next one's, if any
        sizes[:-1] += np.where(np.diff(names) == 1, sizes[1:], 0)
        good = sizes >= self.bound[names // bands % len(self.of)]
        for name, s, m in zip(names[good].tolist(), starts[good].tolist(), sizes[good].tolist()):
            where, what = np.unique(pos[order[s : s + m]]), name // bands
            if len(where) >= self.bound[what % len(self.of)]:
                yield what // len(self.of), what % len(self.of), name % bands, where

    def matches(self, data: np.ndarray, off: np.ndarray, once: bool = False) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(document, item) to (distance, start, end) of the best stretch and of all verified ones' extent.

        With ``once`` some of a document's items are enough.
        """
        out = self._exact(data, off)
        doc, at, k = self.shared(data, off)
        n = np.bincount(doc, self.count[k] if len(k) else None, minlength=len(off) - 1).astype(np.int64)
        group = np.cumsum(n) // POSTINGS
        heavy = n > POSTINGS
        for x in np.unique(group[(n > 0) & ~heavy]).tolist():
            take = (group == x)[doc] & ~heavy[doc]
            self._verify(list(self.regions(doc[take], at[take], k[take], 0, len(self.of))), data, off, out, once)
        for d in np.flatnonzero(heavy).tolist():
            mine = doc == d
            cuts = list(range(0, max(int(off[d + 1] - off[d]) - OVERLAP, 1), SLICE - OVERLAP))
            # the ends first: what lies between two exact matches can't change the result
            for x in cuts[:1] + cuts[:0:-1]:
                if once and any(found == d for found, _ in out):
                    break
                take = mine & (at >= x) & (at + Q <= x + SLICE)
                for region in self.regions(doc[take], at[take], k[take], 0, len(self.of)):
                    self._verify([region], data, off, out, once)
        return out

    def _verify(self, regions: list[tuple[int, int, int, np.ndarray]], data: np.ndarray, off: np.ndarray, out: dict, once: bool) -> None:
        """Align the stretches of regions that share enough q-grams, and put what is found into ``out``."""
        jobs = []
        for doc, segment, band, where in regions:
            s = self.stretches(segment)
            near = np.searchsorted(where, s + self.width[segment] - Q, "right") - np.searchsorted(where, s, "left")
            k = int(self.budget[segment])
            jobs += [(doc, segment, x, band * BAND - _SHIFT + x - k) for x in s[near >= self.bound[segment]].tolist()]
        breadth = 2 * BAND + 2 * _MOST_EDITS
        docs = {d for d, _ in out} if once else set()

        def open_job(job: tuple[int, int, int, int]) -> bool:
            doc, segment, _, low = job
            if once:
                return doc not in docs
            distance, a, b = out.get((doc, int(self.of[segment])), (1, 0, 0))
            return distance > 0 or low < a or low + int(self.width[segment]) + breadth > b

        jobs = jobs[:1] + jobs[:0:-1]
        while jobs := [j for j in jobs if open_job(j)]:
            part, jobs = jobs[:256], jobs[256:]
            found = align(
                [self.data[self.start[i] + s : self.start[i] + s + self.width[i]] for _, i, s, _ in part],
                [data[off[d] : off[d + 1]] for d, _, _, _ in part],
                [t for _, _, _, t in part],
                breadth,
            )
            for (d, i, _, _), (distance, a, b) in zip(part, found):
                if distance <= self.budget[i]:
                    key = d, int(self.of[i])
                    old = out.get(key, (distance, a, b))
                    out[key] = (min(old[0], distance), min(old[1], a), max(old[2], b))
                    docs.add(d)

    def _exact(self, data: np.ndarray, off: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
        """Occurrences as whole words of the items under Q characters."""
        out: dict[tuple[int, int], tuple[int, int, int]] = {}
        if not self.short or not len(data):
            return out
        edge = np.ones(len(data) + 1, bool)  # where a word starts or ends
        edge[1:-1] = (data[1:] == 32) | (data[:-1] == 32)
        edge[off] = True
        padded = grams(np.append(data, np.zeros(Q, np.uint8)))[: len(data)]
        for width, items in self.short.items():
            mask = np.uint64((1 << 8 * width) - 1)
            codes = np.array([int.from_bytes(t, "little") for t, _ in items], np.uint64)
            at = np.flatnonzero(edge[: len(data) - width + 1] & edge[width:]) if len(data) >= width else np.zeros(0, np.int64)
            at = at[np.isin(padded[at] & mask, codes)]
            doc = np.searchsorted(off, at, "right") - 1
            inside = at + width <= off[doc + 1]
            for d, x in zip(doc[inside].tolist(), at[inside].tolist()):
                for _, i in (t for t in items if t[0] == data[x : x + width].tobytes()):
                    a = x - int(off[d])
                    _, lo, hi = out.get((d, i), (0, a, a))
                    out[d, i] = (0, min(lo, a), max(hi, a + width))
        return out


def align(patterns: list[np.ndarray], texts: list[np.ndarray], lows: list[int], breadth: int) -> list[tuple[int, int, int]]:
    """(edits, start, end) of each pattern's best place in its text, on diagonals low to low + breadth.

    All alignments advance together, one pattern character a step. Places outside a text
    match nothing. The earliest of equally good places is given.
    """
    n, rows = len(patterns), max(map(len, patterns))
    size = np.array([len(p) for p in patterns])
    pattern = np.full((n, rows), 0, np.uint8)
    window = np.full((n, rows + breadth), 1, np.uint8)  # 0 and 1 occur in no compared text
    for k, (p, t, low) in enumerate(zip(patterns, texts, lows)):
        pattern[k, : len(p)] = p
        a, b = max(low, 0), min(low + rows + breadth, len(t))
        if b > a:
            window[k, a - low : b - low] = t[a:b]
    step = 1 << 16
    col = np.arange(breadth)
    cost = np.tile(col, (n, 1)).astype(np.int64)  # edits * step + the start's diagonal
    done = cost.copy()
    for i in range(rows):
        after = cost + step * (window[:, i : i + breadth] != pattern[:, i : i + 1])
        after[:, :-1] = np.minimum(after[:, :-1], cost[:, 1:] + step)
        cost = np.minimum.accumulate(after - step * col, axis=1) + step * col
        np.copyto(done, cost, where=(size == i + 1)[:, None])
    best = done.argmin(axis=1)
    value = done[np.arange(n), best]
    low = np.array(lows)
    return list(zip((value // step).tolist(), np.maximum(low + value % step, 0).tolist(), (low + size + best).tolist()))


_FOUND = "doc_id long, item_id long, start long, end long, distance int"
#: A pass over the documents: item ids, and their compared bytes and offsets.
Pass = tuple[list[int], np.ndarray, np.ndarray]


def _search(held: Pass):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*held)
        for whole in batches:
            for batch in chunks(whole, "text"):
                raw, off = text_bytes(batch.column("text"))
                data, place, at = normalize(raw, off)
                found = index.matches(data, at)
                lead = np.zeros(len(raw) + 1, np.int64)
                np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
                ids = batch.column("doc_id").to_pylist()
                rows = []
                for (d, i), (distance, a, b) in sorted(found.items()):
                    n = at[d + 1] - at[d]
                    a, b = min(a, n - 1), min(b, n)
                    start, end = place[at[d] + a], place[at[d] + b - 1] + 1
                    base = lead[off[d]]
                    rows.append((ids[d], index.ids[i], int(lead[start] - base), int(lead[end] - base), distance))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()])],
                    ["doc_id", "item_id", "start", "end", "distance"],
                )

    return run


def _clean(held: Pass, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*held)
        for whole in batches:
            for batch in chunks(whole, column):
                data, _, at = normalize(*text_bytes(batch.column(column)))
                keep = np.ones(batch.num_rows, bool)
                keep[[d for d, _ in index.matches(data, at, once=True)]] = False
                yield batch.filter(pa.array(keep))

    return run


def passes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[int, Iterator[Pass]]:
    """How many passes the benchmark takes, and one after the other what each looks for: about PASS_BYTES of text (one item at least)."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).filter("t is not null")
    size = rows.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    parts = 1 + size // PASS_BYTES

    def each() -> Iterator[Pass]:
        for p in range(parts):
            part = rows if parts == 1 else rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p)
            held = part.distinct().orderBy("i", "t").collect()
            data, _, off = normalize(*text_bytes(pa.array([r["t"] for r in held], pa.string())))
            yield [r["i"] for r in held], data, off

    return parts, each()


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start, end, distance) for every document that holds a passage of an item.

    A passage is a stretch of 72 compared characters of the item (the whole item, if shorter)
    found with at most 7 edits, or fewer for shorter items: one for each ten characters, none
    under 16. Stretches start at every eighth character, so no 80 characters of an item that
    occur with at most 7 edits are missed, wherever they start. Items under 8 compared characters
    are found where they stand as whole words, exactly. start and end, in code points of the
    whole original text, span all such stretches of the pair; distance is the fewest edits.

    Null and empty texts, and items without letters and digits, hold and are no passage; null
    ids and repeated rows are reported like any other, repeated items once. Very long and
    repetitive texts take more time, but no more memory. Documents are not shuffled: items
    travel to them, PASS_BYTES a pass, and the driver holds those of one pass.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts, each = passes(benchmark, id_col="item_id")
    found = None
    for held in each:
        part = rows.mapInArrow(_search(held), _FOUND)
        if parts > 1:
            part = materialize(part, "passages")
        found = part if found is None else found.unionByName(part)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``find`` reports nothing of; columns as they were.

    Each row is judged by its text alone: null and empty texts stay, and so do null ids, repeated
    rows and columns of any name; an empty benchmark removes nothing.
    """
    ship(docs.sparkSession)
    parts, each = passes(benchmark)
    for n, held in enumerate(each):
        before, docs = docs, docs.mapInArrow(_clean(held, text_col), docs.schema)
        if n < parts - 1:
            docs = materialize(docs, "clean")
            if n:
                drop(before)
    return docs
