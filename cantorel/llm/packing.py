"""Mixture-controlled packing: deficit round-robin over source queues, in closed form.

Every source is a queue of tokens, every round fills one window, and in a round each queue
is visited once and sends what it is owed: its target share of all tokens so far, less what
it has sent; the fraction of a token that is left is the deficit that later rounds pay.
Shares are dealt out along a balanced binary tree over the queues. A node that has got C
tokens in all has passed floor(C * p) of them to its left side, p that side's share, and
the rest to its right side; a side that runs dry leaves the rest to the other. What a queue
has sent before any round, what the queues before it have sent, and the round that sends a
given token then follow from a path of the tree, whatever the number of queues and rounds.
So a token's window follows from its position in its queue alone: no task waits for
another, and deficits carry across windows and partitions without a sequential pass. Queue
positions come from block totals and a prefix sum over the (small) table of blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cantorel.llm.kernels import chunks, run_hashes, text_bytes
from cantorel.llm.storage import drop, materialize, ship

WINDOW, END_ID = 2048, 1
#: Tokens whose places are worked out at once (results don't depend on it).
RUN = 1 << 18
#: Distinct pre-tokens a worker remembers; when full it starts anew (results don't depend on it).
MEMORY = 1_000_000
#: Fractional bits of a share; with this many a count of under 2^47 tokens can be multiplied exactly.
_FRACTION = 36
_LETTER, _NUMBER, _OTHER, _SPACE, _UNKNOWN = 0, 1, 2, 3, 255


class WordTokenizer:
    """Ids of a byte-level BPE tokenizer, with each distinct pre-token encoded once.

    Pre-token bounds are found on whole batches; the class of a character is asked from the
    tokenizer's own pre-tokenizer when it is first seen.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        self.inner.encode_special_tokens = True
        self.classes = np.full(0x110000, _UNKNOWN, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, hashes)
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == hashes) if len(self.keys) else np.zeros(len(hashes), bool)

    def _remember(self, hashes: np.ndarray, ids: list[list[int]]) -> None:
        """Add new pre-tokens (sorted hashes, none known) and their ids."""
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        end = self.used + int(size.sum())
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(end - len(self.flat), len(self.flat)), np.uint32)])
        self.flat[self.used : end] = np.fromiter(chain.from_iterable(ids), np.uint32, end - self.used)
        where = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, where, hashes)
        self.at = np.insert(self.at, where, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, where, size)
        self.used = end

    def _learn(self, codes: np.ndarray) -> None:
        split = self.inner.pre_tokenizer.pre_tokenize_str
        for c in np.unique(codes).tolist():
            alone = lambda before, c=c: len(split(before + chr(c))) == 1
            self.classes[c] = _LETTER if alone("a") else _NUMBER if alone("1") else _OTHER if alone("!") else _SPACE

    def starts(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Positions where pre-tokens start in code points of texts end to end."""
        n = len(codes)
        kind = self.classes[codes]
        if (kind == _UNKNOWN).any():
            self._learn(codes[kind == _UNKNOWN])
            kind = self.classes[codes]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        same = np.zeros(n, bool)
        same[1:] = (kind[1:] == kind[:-1]) & ~first[1:n]
        start = ~same
        space = kind == _SPACE
        # the last of a run of white space starts a token of its own, which takes up what follows if it is a blank
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
        start |= last
        glued = np.zeros(n, bool)
        glued[1:] = last[:-1] & (codes[:-1] == 32)
        start &= ~glued
        quotes = np.flatnonzero((codes == 39) & start)
        if len(quotes):
            ends = offsets[np.searchsorted(offsets, quotes, "right")]
            for i, end in zip(quotes.tolist(), ends.tolist()):
                tail = codes[i + 1 : min(i + 3, end)].tolist()
                size = 1 if tail[:1] and tail[0] in (115, 116, 109, 100) else 2 if tail in ([114, 101], [118, 101], [108, 108]) else 0
                if size:
                    start[i + 1 : i + 1 + size] = False
                    if i + 1 + size < end:
                        start[i + 1 + size] = True
        return np.flatnonzero(start)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the n + 1 offsets of the texts in them."""
        data, off = text_bytes(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        text = data.tobytes().decode()
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lead = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
        off = lead[off]
        starts = self.starts(codes, off)
        hashes, where, inverse = np.unique(run_hashes(codes, starts), return_index=True, return_inverse=True)
        known = self._known(hashes)
        if len(self.keys) + np.count_nonzero(~known) > MEMORY:
            self._forget()
            known[:] = False
        new = np.flatnonzero(~known)
        if len(new):
            bounds = np.append(starts, len(codes))
            first = where[new]
            words = [text[a:b] for a, b in zip(bounds[first].tolist(), bounds[first + 1].tolist())]
            self._remember(hashes[new], [e.ids for e in self.inner.encode_batch(words, add_special_tokens=False)])
        index = np.searchsorted(self.keys, hashes)[inverse]
        size = self.size[index]
        out = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(size, out=out[1:])
        ids = self.flat[np.arange(out[-1]) + np.repeat(self.at[index] - out[:-1], size)]
        return ids, out[np.searchsorted(starts, off)]


_LOADED: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer a worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


_TOKENS = "block int, queue string, doc_id long, at long, n long, ids binary"


def _tokenize(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, block, sent = word_tokenizer(path), TaskContext.get().partitionId(), {}
        width = "<u2" if max(end_id, tok.inner.get_vocab_size() - 1) < 1 << 16 else "<u4"  # on disk
        for whole in batches:
            for batch in chunks(whole, "text"):
                ids, off = tok.encode(batch.column("text"))
                n = np.diff(off) + 1
                queues, at = batch.column("queue").to_pylist(), []
                for q, k in zip(queues, n.tolist()):
                    at.append(sent.get(q, 0))
                    sent[q] = at[-1] + k
                ids = np.insert(ids, off[1:], np.uint32(end_id)).astype(width)
                ends = np.append(0, np.cumsum(n)) * ids.itemsize
                held = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), block, np.int32)), batch.column("queue"), batch.column("doc_id"), pa.array(at, pa.int64()), pa.array(n), held.cast(pa.binary())],
                    ["block", "queue", "doc_id", "at", "n", "ids"],
                )

    return run


def shares(totals: dict[str, int], proportions: dict[str, float] | None = None, temperature: float = 1.0) -> list[float]:
    """The target weight of each queue: that given, or its tokens to the power of ``temperature``."""
    if proportions is not None:
        return [max(0.0, proportions.get(q, 0.0)) for q in totals]
    return [float(n) ** temperature for n in totals.values()]


def _times(c: np.ndarray, p: np.ndarray) -> np.ndarray:
    """floor(c * p / 2^36) for counts c under 2^47, without overflow."""
    c, p = c.astype(np.uint64), p.astype(np.uint64)
    high = (c >> np.uint64(20)) * p
    low = (c & np.uint64((1 << 20) - 1)) * p
    return ((high >> np.uint64(16)) + ((((high & np.uint64(0xFFFF)) << np.uint64(20)) + low) >> np.uint64(36))).astype(np.int64)


class Schedule:
    """Windows and places in them, from positions in the queues.

    ``node_share``, ``node_left`` and ``node_right`` hold each node's share of its left side (of
    2^36) and the tokens of both sides; ``path`` and ``right`` each queue's nodes from the root
    on, and whether it is to their right.
    """

    def __init__(self, totals: dict[str, int], window: int, proportions: dict[str, float] | None = None, temperature: float = 1.0):
        self.names = {q: i for i, q in enumerate(totals)}
        self.window, self.whole = window, sum(totals.values())
        if self.whole >= 1 << 47:
            raise ValueError("at most 2^47 tokens can be packed at once")
        size, want = list(totals.values()), shares(totals, proportions, temperature)
        order = sorted(range(len(size)), key=lambda i: (-want[i], i))
        self.weight = np.array(want)
        tokens = np.append(0, np.cumsum([size[i] for i in order])).astype(np.int64)
        weights = np.append(0.0, np.cumsum([want[i] for i in order]))
        share, left, right = [], [], []
        paths: list[list[tuple[int, bool]]] = [[] for _ in size]
        parts = [(0, len(size), [])] if size else []
        while parts:
            lo, hi, path = parts.pop()
            if hi - lo == 1:
                paths[order[lo]] = path
                continue
            half = (weights[lo] + weights[hi]) / 2
            cut = int(np.clip(np.searchsorted(weights, half), lo + 1, hi - 1)) if weights[hi] > weights[lo] else (lo + hi) // 2
            if cut - 1 > lo and half - weights[cut - 1] < weights[cut] - half:
                cut -= 1
            a, b = (weights[cut] - weights[lo], weights[hi] - weights[cut]) if weights[hi] > weights[lo] else (float(tokens[cut] - tokens[lo]), float(tokens[hi] - tokens[cut]))
            p = round(a / (a + b) * (1 << _FRACTION)) if a + b else 1 << (_FRACTION - 1)
            share.append(min(p, (1 << _FRACTION) - 1) if b else p)
            left.append(int(tokens[cut] - tokens[lo]))
            right.append(int(tokens[hi] - tokens[cut]))
            node = len(share) - 1
            parts += [(lo, cut, [*path, (node, False)]), (cut, hi, [*path, (node, True)])]
        self.node_share, self.node_left, self.node_right = (np.array(x or [0], np.int64) for x in (share, left, right))
        self.depth = np.array([len(p) for p in paths], np.int64)
        deep = int(self.depth.max(initial=0))
        self.path = np.array([[k for k, _ in p] + [0] * (deep - len(p)) for p in paths], np.int64).reshape(len(size), deep)
        self.right = np.array([[r for _, r in p] + [False] * (deep - len(p)) for p in paths], bool).reshape(len(size), deep)

    def sent(self, q: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens that queues q have sent before round r, and that the queues before them in a round have."""
        count, before = np.minimum(r * self.window, self.whole), np.zeros(len(q), np.int64)
        for d in range(self.path.shape[1]):
            k, here = self.path[q, d], self.depth[q] > d
            left = np.clip(_times(count, self.node_share[k]), count - self.node_right[k], self.node_left[k])
            right = self.right[q, d]
            before += np.where(here & right, left, 0)
            count = np.where(here, np.where(right, count - left, left), count)
        return count, before

    def round_of(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The round that sends token ``at`` of queue q."""
        need = at + 1  # so many tokens must have come to the queue, and so to each node above it
        for d in range(self.path.shape[1] - 1, -1, -1):
            k, here, right = self.path[q, d], self.depth[q] > d, self.right[q, d]
            p = self.node_share[k]
            own = np.where(right, (1 << _FRACTION) - p, p)
            alone = need + np.where(right, self.node_left[k], self.node_right[k])  # when the other side has run dry
            guess = np.where(own > 0, np.minimum((need - right) * (float(1 << _FRACTION) / np.maximum(own, 1)), alone), alone)
            c = np.maximum(guess.astype(np.int64) - 2, need)
            for _ in range(5):
                left = _times(c, p)
                c += np.where(right, c - left, left) < need
            need = np.where(here, np.minimum(c, alone), need)
        return (need - 1) // self.window

    def pieces(self, q: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of tokens [at, at + n), n > 0, of queues q as (run, start in the run, length, sequence, offset).

        Rounds are stepped through where they are at most about as many as the tokens, and
        looked up token by token where a rare source is spread over more.
        """
        first, last = self.round_of(q, at), self.round_of(q, at + n - 1)
        near = last - first < 2 * n
        run, r = _spread(first[near], last[near])
        far, token = _spread(at[~near], (at + n - 1)[~near])
        far_r = self.round_of(q[~near][far], token)
        new = np.append(True, (far[1:] != far[:-1]) | (far_r[1:] != far_r[:-1])) if len(far) else np.zeros(0, bool)
        run = np.concatenate([np.flatnonzero(near)[run], np.flatnonzero(~near)[far[new]]])
        r = np.concatenate([r, far_r[new]])
        (lo, before), (hi, after) = self.sent(q[run], r), self.sent(q[run], r + 1)
        a, b = np.maximum(at[run], lo), np.minimum((at + n)[run], hi)
        keep = b > a
        return run[keep], (a - at[run])[keep], (b - a)[keep], r[keep], (after - before + a - lo)[keep]


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every integer of each closed range, and the range's index."""
    n = last - first + 1
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[row]


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(plan: Schedule, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "ids"):
                q = np.array([plan.names[x] for x in batch.column("queue").to_pylist()], np.int64)
                at, n = batch.column("at").to_numpy(), batch.column("n").to_numpy()
                raw = bytes_of(batch.column("ids"))
                ids = raw.view(f"<u{len(raw) // n.sum()}").astype("<u4")
                view, base = memoryview(ids.view(np.uint8)), np.cumsum(n) - n
                # runs of a bounded length, a bounded number of tokens at a time
                doc, skip = _spread(np.zeros(len(n), np.int64), (n - 1) // RUN)
                size = np.minimum(n[doc] - skip * RUN, RUN)
                cuts = [*np.flatnonzero(np.diff(np.cumsum(size) // RUN)) + 1, len(doc)]
                for x, y in zip([0, *cuts], cuts):
                    d, skipped = doc[x:y], skip[x:y] * RUN
                    row, start, length, seq, offset = plan.pieces(q[d], at[d] + skipped, size[x:y])
                    start, row = start + skipped[row], d[row]
                    a = 4 * (base[row] + start)
                    parts = [view[i:j] for i, j in zip(a.tolist(), (a + 4 * length).tolist())]
                    cols = [batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(n[row]), pa.array(seq), pa.array(offset)]
                    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                    if with_ids:
                        cols.append(pa.array([p.tobytes() for p in parts], pa.binary()))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names)

    return run


def bytes_of(column: pa.Array) -> np.ndarray:
    """Bytes of a binary column end to end."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[off[0] : off[-1]]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    proportions: dict[str, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str | None = "source",
    end_id: int = END_ID,
    with_ids: bool = False,
    temperature: float = 1.0,
) -> DataFrame:
    """Every token of ``docs`` in exactly one piece of a window of ``window`` tokens.

    ``proportions`` gives target shares by source; None takes each source's tokens to the power
    of ``temperature``: 1 for its share of all tokens, so that all queues run dry together, less
    to give small sources more of the early windows. While no queue is dry every window holds
    each source's target to within a few tokens (a deficit of at most one for each node above
    the queue in the tree), and so do all windows before it together. A source without a target
    follows when those beside it in the tree have run dry. Null sources are a queue of their
    own. The totals of all queues, one number a source, are on the driver and in every task.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Null ids
    and repeated rows are packed like any other row. An empty table gives no rows. Only the
    last window can be short. Columns: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with ``with_ids`` the ids as little-endian unsigned 32-bit
    numbers. Texts are tokenized once, into a table in the shared folder; no ids are shuffled
    while the table of bases, a row for each source of each block, can be broadcast.
    """
    spark = docs.sparkSession
    ship(spark)
    queue = F.lit("") if source_col is None else F.concat(F.lit("="), F.col(source_col).cast("string"))
    queue = F.coalesce(queue, F.lit(""))
    if proportions is not None:
        proportions = {f"={k}": v for k, v in proportions.items()}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), queue.alias("queue"))
    tokens = materialize(rows.mapInArrow(_tokenize(tokenizer_path, end_id), _TOKENS), "tokens")
    blocks = materialize(tokens.groupBy("block", "queue").agg(F.sum("n").alias("n")), "blocks")
    totals = {r["queue"]: r["n"] for r in blocks.groupBy("queue").agg(F.sum("n").alias("n")).orderBy("queue").collect()}
    before = F.sum("n").over(Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    bases = materialize(blocks.select("block", "queue", F.coalesce(before, F.lit(0)).alias("base")), "bases")
    drop(blocks)
    placed = tokens.join(bases, ["block", "queue"]).select("queue", "doc_id", (F.col("at") + F.col("base")).alias("at"), "n", "ids")
    plan = Schedule(totals, window, proportions, temperature)
    return placed.mapInArrow(_pack(plan, with_ids), _PIECES + (", ids binary" if with_ids else ""))
