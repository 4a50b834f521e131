"""SimHash near-duplicates by pivot distance tables.

Fingerprints that differ in at most three bits agree in at least three of six blocks of
bits, so each of the twenty choices of three blocks deals equal fingerprints' blocks
together and no link is missed. Within such a bucket the Hamming distances of every
fingerprint to fixed reference fingerprints (pivots) form a table; by the triangle
inequality a pair whose coordinates differ by more than three anywhere cannot link and
is discarded, and the survivors are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantorel.llm.graph import components, stars
from cantorel.llm.kernels import _CLASS, _GOLDEN, _LOWER, SPACE, chunks, runs, splitmix, text_bytes, xxh64
from cantorel.llm.storage import drop, materialize, ship

BITS, BLOCKS, RADIUS, SEED = 64, 6, 3, 42
#: Bits of each block, and the masks of every choice of three blocks.
_EDGES = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
_BLOCK = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(_EDGES, _EDGES[1:])]
MASKS = [sum(c) for c in combinations(_BLOCK, BLOCKS - RADIUS)]
#: Reference fingerprints.
PIVOTS = splitmix(np.arange(1, 17, dtype=np.uint64) * _GOLDEN)
#: Fingerprints of one bucket that are compared at once; larger buckets are split into pairs of such pieces.
PIECE = 2048


_EIGHTHS = np.uint64(0x0101010101010101)
#: Shingles that are hashed and counted at once.
SHINGLES = 1 << 17


def prints_of(data: np.ndarray, off: np.ndarray, shingle: int = 3) -> np.ndarray:
    """Majority bits of the XXH64 values of the word shingles of texts end to end; 0 without words."""
    n = len(off) - 1
    votes, total = np.zeros((n, BITS), np.int64), np.zeros(n, np.int64)
    word = _CLASS[data] != SPACE
    starts, _ = runs(data, off, word.view(np.uint8))
    starts = starts[word[starts]] if len(starts) else starts
    if not len(starts):
        return np.zeros(n, np.uint64)
    # the words with single blanks between them, and where each of them starts and ends there
    doc = np.searchsorted(off, starts, "right") - 1
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(word, out=before[1:])
    head = before[starts] + np.arange(len(starts))
    tail = np.append(before[starts[1:]], before[-1]) + np.arange(len(starts))
    joined = np.full(int(tail[-1]), 32, np.uint8)
    place = np.arange(before[-1]) + np.repeat(np.arange(len(starts)), tail - head)
    joined[place] = _LOWER[data[word]]
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    words = np.diff(np.append(first, len(doc)))
    total[doc[first]] = np.maximum(words - shingle + 1, 1)
    m = total[doc[first]]
    i = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first, m)
    last = np.minimum(i + shingle, np.repeat(first + words, m)) - 1
    owner = np.repeat(doc[first], m)
    for k in range(0, len(i), SHINGLES):
        h = xxh64(joined, head[i[k : k + SHINGLES]], tail[last[k : k + SHINGLES]], SEED)
        own = owner[k : k + SHINGLES]
        # runs of one text of at most 255 values; every eighth bit of them is summed in bytes of one number
        at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        parts = (np.diff(np.append(at, len(own))) + 254) // 255
        at = np.repeat(at, parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        sums = np.stack([np.add.reduceat((h >> np.uint64(j)) & _EIGHTHS, at) for j in range(8)], axis=1)
        np.add.at(votes, own[at], sums.astype("<u8").view(np.uint8).reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, BITS))
    return np.packbits(2 * votes > total[:, None], axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunks(whole, "text"):
            fp = prints_of(*text_bytes(batch.column("text")))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(fp.view(np.int64))], [*names, "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marked: bool = False) -> DataFrame:
    """(doc_id, fp long) for every row, with ``marked`` also the text's hash ``mark``; a null, empty or blank text has fingerprint zero."""
    ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    mark = [F.xxhash64(text).alias("mark")] if marked else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *mark, text.alias("text"))
    return rows.mapInArrow(_fingerprints, f"doc_id long, {'mark long, ' if marked else ''}fp long")


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances to the pivots, one row a fingerprint."""
    return np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def linked(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those pairs (i, j) within the radius: pivot coordinates discard, the bits verify."""
    for p in range(table.shape[1]):
        near = np.abs(table[i, p] - table[j, p]) <= RADIUS
        i, j = i[near], j[near]
        if not len(i):
            return i, j
    near = np.bitwise_count(fp[i] ^ fp[j]) <= RADIUS
    return i[near], j[near]


def across(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links of pieces a and b (all pairs, in blocks), as stars of positions in their concatenation."""
    fp = np.concatenate([a, b]) if not same else a
    table = pivot_table(fp)
    left = np.arange(len(a))
    right = np.arange(len(fp)) if same else np.arange(len(a), len(fp))
    order = right[np.argsort(table[right, 0], kind="stable")]
    sorted_first = table[order, 0]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for k in range(0, len(left), 256):
        part = left[k : k + 256]
        lo = np.searchsorted(sorted_first, table[part, 0] - RADIUS, "left")
        hi = np.searchsorted(sorted_first, table[part, 0] + RADIUS, "right")
        n = hi - lo
        i = np.repeat(part, n)
        j = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
        keep = i < j
        found.append(linked(fp, table, i[keep], j[keep]))
    i, j = (np.concatenate(x) for x in zip(*found))
    return fp[i], fp[j]


def _small(fp: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within many small groups of consecutive fingerprints."""
    table = pivot_table(fp)
    group = np.repeat(np.arange(len(starts)), sizes)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for lag in range(1, int(sizes.max(initial=1))):
        i = np.flatnonzero(group[lag:] == group[:-lag])
        found.append(linked(fp, table, i, i + lag))
    i, j = (np.concatenate(x) for x in zip(*found))
    return fp[i], fp[j]


_LINKS = "u long, v long, bucket long, piece long, held binary"


def _out(u: np.ndarray, v: np.ndarray, bucket: int | None = None, piece: int = 0, held: bytes | None = None) -> pa.RecordBatch:
    if held is None:
        leaf, centre = stars(u.view(np.int64), v.view(np.int64))
        n = len(leaf)
        cols = [pa.array(leaf, pa.int64()), pa.array(centre, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())]
    else:
        cols = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([bucket], pa.int64()), pa.array([piece], pa.int64()), pa.array([held], pa.binary())]
    return pa.RecordBatch.from_arrays(cols, ["u", "v", "bucket", "piece", "held"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (bucket, fp) rows of one range to links.

    A bucket over PIECE rows, and the range's first and last bucket, which other ranges may hold
    parts of, also leave their pieces, to be compared with each other.
    """
    rest_key, rest_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pieces: dict[int, int] = {}
    task = TaskContext.get()
    own = (task.partitionId() if task else 0) << 32
    begun = False

    def whole(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(key)))
        small = (sizes > 1) & (sizes <= 32)
        if small.any():
            take = np.repeat(small, sizes)
            u, v = _small(fp[take], np.cumsum(sizes[small]) - sizes[small], sizes[small])
            if len(u):
                yield _out(u, v)
        for s, n in zip(starts[sizes > 32].tolist(), sizes[sizes > 32].tolist()):
            u, v = across(fp[s : s + n], fp[:0], True)
            if len(u):
                yield _out(u, v)

    def piece(key: int, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from whole(np.full(len(fp), key), fp)
        pieces[key] = pieces.get(key, own - 1) + 1
        yield _out(fp, fp, key, pieces[key], fp.tobytes())

    for batch in batches:
        key = np.concatenate([rest_key, batch.column("bucket").to_numpy()])
        fp = np.concatenate([rest_fp, batch.column("fp").to_numpy().view(np.uint64)])
        last = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
        done_key, done_fp, rest_key, rest_fp = key[:last], fp[:last], key[last:], fp[last:]
        # the first finished bucket may be the range's first, or the end of one that has left pieces already
        if len(done_key) and (not begun or int(done_key[0]) in pieces):
            n = int(np.searchsorted(done_key, done_key[0], "right"))
            for k in range(0, n, PIECE):
                yield from piece(int(done_key[0]), done_fp[k : min(k + PIECE, n)])
            pieces.clear()
            done_key, done_fp, begun = done_key[n:], done_fp[n:], True
        yield from _cut(done_key, done_fp, whole, piece)
        while len(rest_fp) >= 2 * PIECE:
            yield from piece(int(rest_key[0]), rest_fp[:PIECE])
            rest_key, rest_fp = rest_key[PIECE:], rest_fp[PIECE:]
    for k in range(0, len(rest_fp), PIECE):
        yield from piece(int(rest_key[0]), rest_fp[k : k + PIECE])


def _cut(key: np.ndarray, fp: np.ndarray, whole, piece) -> Iterator[pa.RecordBatch]:
    """Buckets of at most two pieces as they are, larger ones piece by piece."""
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(key)))
    large = sizes > 2 * PIECE
    keep = ~np.repeat(large, sizes)
    yield from whole(key[keep], fp[keep])
    for s, n in zip(starts[large].tolist(), sizes[large].tolist()):
        for k in range(s, s + n, PIECE):
            yield from piece(int(key[s]), fp[k : min(k + PIECE, s + n)])


def _piece_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            u, v = across(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), False)
            if len(u):
                leaf, centre = stars(u.view(np.int64), v.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(centre)], ["u", "v"])


def links(fps: DataFrame) -> DataFrame:
    """Edges (u, v) with the same components as all pairs of distinct fingerprints within three bits."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    tables = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in MASKS])).alias("t", "key")
    keyed = fps.select("fp", tables).select(F.xxhash64("t", "key").alias("bucket"), "fp")
    # ranges of (bucket, fp), so that a bucket of any size is dealt over tasks
    found = keyed.repartitionByRange("bucket", "fp").sortWithinPartitions("bucket", "fp").mapInArrow(_buckets, _LINKS)
    found = materialize(found, "links")
    held = found.filter("held is not null").select("bucket", "piece", "held")
    shared = held.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    held = held.join(shared, "bucket")
    a, b = held.alias("a"), held.alias("b")
    pairs = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.piece") < F.col("b.piece")))
    pairs = pairs.select(F.col("a.held").alias("a"), F.col("b.held").alias("b")).repartition(F.xxhash64("a", "b"))
    out = found.filter("u is not null").select("u", "v").unionByName(pairs.mapInArrow(_piece_pairs, "u long, v long"))
    out._scratch = found._scratch
    return out


def _rooted(nodes: DataFrame) -> DataFrame:
    """Distinct fingerprints with the ``root`` of their component, which is never null."""
    edges = links(nodes.select("fp"))
    roots = components(edges)
    drop(edges)
    return nodes.join(roots, nodes.fp == roots.node, "left").select(*nodes.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest id reachable over links of at most three differing bits,
    the row's own included. Rows with a null id take part in the linking and get the
    component's smallest id that is not null (null if it has none). Null and empty texts
    have fingerprint zero and are linked like any other. Repeated rows stay repeated. Only
    distinct fingerprints are compared, each with its smallest id, so that a group of exact
    copies costs as much as one document. Other columns, whatever their names, are not read.
    """
    prints = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = _rooted(nodes)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = materialize(rooted.join(least, "root").select("fp", "component_id"), "components")
    return prints.join(by_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component; columns as they were.

    It is the row with the smallest id, null ids last, and of those with that id the one whose
    text has the smallest hash. Rows that share id and text are one row in the result,
    whichever other columns differ; different texts under one id, or without one, only count as
    duplicates where their fingerprints link.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, marked=True), "fingerprints")
    rows = prints.groupBy("fp", "doc_id", "mark").agg(F.count("*").alias("rows"))
    rows = rows.select("fp", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark", "rows").alias("row"))
    nodes = materialize(rows.groupBy("fp").agg(F.min("row").alias("row")), "nodes")
    drop(prints)
    first = _rooted(nodes).groupBy("root").agg(F.min("row").alias("row"))
    free = "__"
    while any(c.startswith(free) for c in docs.columns):
        free += "_"
    own, mark, n = free + "id", free + "mark", free + "rows"
    keep = materialize(first.select(F.col("row.doc_id").alias(own), F.col("row.mark").alias(mark), F.col("row.rows").alias(n)), "kept")
    drop(nodes)
    same = docs[id_col].cast("long").eqNullSafe(keep[own]) & (F.xxhash64(docs[text_col].cast("string")) == keep[mark])
    kept = docs.join(keep.hint("shuffle_hash"), same)
    once = kept.filter(F.col(n) == 1)
    more = kept.filter(F.col(n) > 1).dropDuplicates([own, mark])
    return once.unionByName(more).drop(own, mark, n)
