"""Substring dedup by hashing of lines and the sentences in them.

Units are lines, and within a line its sentences (ended by . ! or ? and white space), so
that a passage set into a longer line is found too. A unit's words, lower-cased, with
everything else as blanks, make its digest. Digests are grouped over all documents; the
occurrence of the lowest rank (document id, then place in the document) stays, all others
are removed, with their offsets in the original text kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from cantorel.llm.kernels import _CLASS, _GOLDEN, _LOWER, WORD, chunks, run_hashes, runs, splitmix, text_bytes
from cantorel.llm.storage import drop, materialize, ship

#: Shorter units are never removed: common short lines and sentences are no copied passages.
MIN_WORDS_LINE, MIN_WORDS_SENTENCE = 5, 8
#: A passage of more words than this that is removed as one is counted as a long one.
LONG_WORDS = 50
_POSITION = splitmix(np.arange(1, 1025, dtype=np.uint64) * _GOLDEN) | np.uint64(1)


def _ends(data: np.ndarray, off: np.ndarray, sentences: bool) -> np.ndarray:
    """Sorted positions after which a unit ends, text ends included."""
    stop = data == 10
    if sentences and len(data) > 1:
        mark = (data[:-1] == 46) | (data[:-1] == 33) | (data[:-1] == 63)
        stop[:-1] |= mark & ((data[1:] == 32) | (data[1:] == 9) | (data[1:] == 13))
    if len(data):
        last = off[1:][np.diff(off) > 0] - 1
        stop[last] = True
    return np.flatnonzero(stop) + 1


def units(data: np.ndarray, off: np.ndarray, sentences: bool) -> tuple[np.ndarray, ...]:
    """(row, start, end, words, digest a, digest b) of all units with words; start and end without outer blanks."""
    if not len(data):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    low = _LOWER[data]
    starts, kind = runs(low, off, _CLASS[low])
    hashes = run_hashes(low, starts)
    word = kind == WORD
    size = np.diff(np.append(starts, len(data)))
    ends = _ends(data, off, sentences)
    w_start, w_size, w_hash = starts[word], size[word], hashes[word]
    unit = np.searchsorted(ends, w_start, "right")
    if not len(unit):
        return units(data[:0], off[:1], sentences)
    first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
    n = np.diff(np.append(first, len(unit)))
    place = np.arange(len(unit)) - np.repeat(first, n)
    a = splitmix(np.add.reduceat(w_hash * _POSITION[place & 1023] + (place >> 10).astype(np.uint64), first))
    b = splitmix(np.add.reduceat(splitmix(w_hash ^ _POSITION[(place + 7) & 1023]) * (place.astype(np.uint64) + np.uint64(1)), first) + n.astype(np.uint64))
    begin, stop = w_start[first], ends[unit[first]]
    stop = np.where(data[stop - 1] == 10, stop - 1, stop)
    return np.searchsorted(off, begin, "right") - 1, begin, stop, n, a, b


def _all_units(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Lines and proper sentences of a batch, in code points of their texts; equal words make equal digests, line or sentence."""
    data, off = text_bytes(batch.column("text"))
    lines, parts = units(data, off, False), units(data, off, True)
    # a sentence that is its whole line is that line's unit already
    same = np.isin(parts[1], lines[1]) & np.isin(parts[2], lines[2])
    keep_l = lines[3] >= MIN_WORDS_LINE
    keep_p = ~same & (parts[3] >= MIN_WORDS_SENTENCE)
    row, start, end, _, a, b = (np.concatenate([x[keep_l], y[keep_p]]) for x, y in zip(lines, parts))
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return row, lead[start] - lead[off[row]], lead[end] - lead[off[row]], a, b


_UNITS = "doc_id long, mark long, start int, end int, a long, b long"


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunks(whole, "text"):
            row, start, end, a, b = _all_units(batch)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("mark").take(at), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                ["doc_id", "mark", "start", "end", "a", "b"],
            )


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, spans): the spans (start, end) to remove from each document that has any.

    ``mark`` is the text's hash. Rank is (doc_id, mark, start), null ids first, lines before
    the sentences in them. Rows with equal id and text are one document and keep or lose the
    same units. Spans are in code points of the original text; a line's can hold its sentences'.

    Texts are split once, into a table of units in the shared folder. A unit is shuffled twice,
    as a partial aggregate and in a join that adaptive execution can split, so a line that most
    documents hold is no hot key. Without documents, or without repeats, there are no rows.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.length("text") > 0).withColumn("mark", F.xxhash64("text"))
    every = materialize(rows.mapInArrow(_emit, _UNITS), "units")
    rank = F.struct("doc_id", "mark", "start")
    first = every.groupBy("a", "b").agg(F.min(rank).alias("first"), F.max(rank).alias("last")).filter(F.col("first") != F.col("last"))
    later = every.join(first.select("a", "b", "first"), ["a", "b"]).filter(~rank.eqNullSafe(F.col("first")))
    spans = materialize(later.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    drop(every)
    return spans


def merged(start: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of all rows, in places of the texts end to end, in order and with those that meet or overlap put together."""
    order = np.lexsort((end, start, row))
    start, end, row = start[order], np.maximum.accumulate(end[order]) if len(end) else end, row[order]
    new = np.append(True, (start[1:] > end[:-1]) | (row[1:] != row[:-1])) if len(row) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(end)) - 1] if len(end) else end, row[first]


def _cut(text_col: str, spans_col: str, out: list[str]):
    """Texts without their spans, the spans merged, and how many long passages they make; linear in text and spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, text_col):
                column, spans = batch.column(text_col), batch.column(spans_col)
                data, off = text_bytes(column)
                lead = np.zeros(len(data) + 1, np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
                base = lead[off]
                n = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(batch.num_rows), n)
                flat = spans.flatten()
                a, b, row = merged(*(flat.field(k).to_numpy().astype(np.int64) + base[row] for k in (0, 1)), row)
                gone = np.zeros(lead[-1] + 1, np.int64)
                np.add.at(gone, a, 1)
                np.add.at(gone, b, -1)
                keep = np.cumsum(gone)[lead[1:] - 1] == 0
                after = np.zeros(len(data) + 1, np.int64)
                np.cumsum(keep, out=after[1:])
                text = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(after[off]), pa.py_buffer(np.ascontiguousarray(data[keep])))
                text = pc.if_else(pc.is_valid(column), text.cast(pa.string()), pa.scalar(None, pa.string()))
                # words before each place; spans with no word between them are one passage
                starts, kind = runs(data, off, _CLASS[data])
                words = np.searchsorted(lead[starts[kind == WORD]], np.column_stack([a, b]))
                new = np.append(True, (words[1:, 0] > words[:-1, 1]) | (row[1:] != row[:-1])) if len(row) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                size = np.add.reduceat(words[:, 1] - words[:, 0], first) if len(first) else np.zeros(0, np.int64)
                long = np.bincount(row[first][size > LONG_WORDS], minlength=batch.num_rows)
                held = pa.StructArray.from_arrays([pa.array(x - base[row], pa.int32()) for x in (a, b)], ["start", "end"])
                removed = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32()), held)
                made = {text_col: text, "removed": removed, "long_passages": pa.array(long, pa.int64())}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in out], out)

    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later occurrences of repeated units cut out of their texts, and columns ``removed`` and ``long_passages``.

    ``removed`` holds the spans cut, in code points of the original text; it is empty where
    nothing was. ``long_passages`` counts those of over LONG_WORDS words, spans with no word
    between them as one. All rows and columns stay; columns of these names in the input are
    replaced, others may have any name. Null and empty texts stay as they are. Repeated rows keep
    or lose the same units. Time is linear in a text's length and its repeats, memory in its length.
    """
    docs = docs.drop("removed", "long_passages")
    free = "__"
    while any(c.startswith(free) for c in docs.columns):
        free += "_"
    spans = repeated(docs, id_col, text_col).select(*(F.col(c).alias(free + c) for c in ("doc_id", "mark", "spans")))
    text = F.col(text_col).cast("string")
    same = docs[id_col].cast("long").eqNullSafe(spans[f"{free}doc_id"]) & (F.xxhash64(text) == spans[f"{free}mark"])
    rows = docs.join(spans, same, "left").withColumn(text_col, text).drop(f"{free}doc_id", f"{free}mark")
    fields = [f for f in rows.schema.fields if f.name != f"{free}spans"]
    span = StructType().add("start", IntegerType()).add("end", IntegerType())
    schema = StructType(fields).add("removed", ArrayType(span)).add("long_passages", LongType())
    return rows.mapInArrow(_cut(text_col, f"{free}spans", schema.names), schema)
