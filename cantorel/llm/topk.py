"""Exact top-k inner products, term at a time.

Vectors are rows of integer weights. A bounded block of queries travels to the candidates,
which are not shuffled. Each task inverts its candidates, a block at a time, into postings,
term (dimension) to the positions and weights of the rows that have it. Queries are taken
term by term: each query's non-zero weight times a posting list is added into that query's
dense array of scores. Partial selection leaves k of each block beside the best so far, and
the tasks' winners are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cantorel.llm.storage import materialize, ship

#: Rows of a block of candidates and of queries; a score array has this many entries together.
CANDIDATES, QUERIES = 4096, 256
#: Bytes of query weights that travel to every task at once; more queries take more passes over the candidates.
PASS_BYTES = 16 << 20


def quantized(df: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, weights array<long>) of floor(scale * x); rows with a null id or vector or a null or non-finite component are left out.

    A product beyond the range of 64-bit integers is put at its end.
    """
    v = F.col(vector_col).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good)
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("weights"))


def postings(rows: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each term, positions and weights of the rows whose weight isn't zero."""
    width = max(map(len, rows), default=0)
    dense = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        dense[i, : len(r)] = r
    out = []
    for t in range(width):
        at = np.flatnonzero(dense[:, t])
        out.append((at, dense[at, t]))
    return out


def accumulate(queries: list[np.ndarray], inverted: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Score arrays of all queries against n candidates, one term after the other."""
    scores = np.zeros((len(queries), n), np.int64)
    for t, (at, weight) in enumerate(inverted):
        if not len(at):
            continue
        for k, q in enumerate(queries):
            if len(q) > t and (x := q[t]):
                if len(at) == n:
                    scores[k] += x * weight
                else:
                    scores[k, at] += x * weight
    return scores


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        over = np.flatnonzero(score > least)
        equal = np.flatnonzero(score == least)
        if len(equal) > k - len(over):
            equal = equal[np.argsort(ids[equal], kind="stable")[: k - len(over)]]
        at = np.concatenate([over, equal])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))]


def _rows(column: pa.Array) -> list[np.ndarray]:
    off, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(off[:-1], off[1:])]


_FOUND = "query_row long, query_id long, vec_id long, score long"


class Best:
    """The k highest scores so far of each of n queries, with ids; ties to smaller ids."""

    def __init__(self, n: int, k: int):
        self.k, self.size = k, np.zeros(n, np.int64)
        self.score, self.id = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        have = self.size[q]
        if have == self.k:
            # only what reaches the lowest one kept can replace it
            reach = score >= self.score[q, -1]
            if not reach.any():
                return
            score, ids = score[reach], ids[reach]
        score, ids = np.append(self.score[q, :have], score), np.append(self.id[q, :have], ids)
        at = best(score, ids, self.k)
        self.size[q] = len(at)
        self.score[q, : len(at)], self.id[q, : len(at)] = score[at], ids[at]


def _search(queries: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_row, q_id, flat, off = queries
        rows = [flat[a:b] for a, b in zip(off, off[1:])]
        kept = Best(len(rows), k)
        for whole in batches:
            for s in range(0, whole.num_rows, CANDIDATES):
                part = whole.slice(s, CANDIDATES)
                c_id, c_row = part.column("vec_id").to_numpy(), part.column("row").to_numpy()
                inverted = postings(_rows(part.column("weights")))
                own = {r: i for i, r in enumerate(c_row.tolist())}
                for x in range(0, len(rows), QUERIES):
                    for i, score in enumerate(accumulate(rows[x : x + QUERIES], inverted, len(c_id)), x):
                        mine = own.get(int(q_row[i]))
                        if mine is None:
                            kept.add(i, score, c_id)
                        else:
                            kept.add(i, np.delete(score, mine), np.delete(c_id, mine))
        at = np.repeat(np.arange(len(rows)), kept.size)
        place = np.arange(len(at)) - np.repeat(np.cumsum(kept.size) - kept.size, kept.size)
        cols = q_row[at], q_id[at], kept.id[at, place], kept.score[at, place]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], ["query_row", "query_id", "vec_id", "score"])

    return run


def search(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query row.

    Both tables have (row, vec_id, weights); ``row`` tells rows apart, and a query's own row
    is no candidate of it. Ties go to the smaller vec_id. Shorter vectors count as having
    zeros at their end. Queries without candidates, and empty tables, give no rows. Repeated
    vec_ids are separate candidates and separate queries. Weights and scores are 64-bit
    integers: a component beyond their range was put at its end, and a sum beyond it wraps.

    Candidates are read once for each PASS_BYTES of query weights and never shuffled. A task
    holds one pass's queries and k results each; only these results are shuffled, k a query and
    task. With more than one pass each is written to the shared folder, so the driver and a task
    hold the queries of one pass.
    """
    spark = queries.sparkSession
    ship(spark)
    size = queries.agg(F.sum(F.size("weights") + 2).alias("n")).first()["n"] or 0
    parts = 1 + size * 8 // PASS_BYTES
    found = None
    for p in range(parts):
        part = queries if parts == 1 else queries.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == p)
        held = part.select("row", "vec_id", "weights").toArrow().combine_chunks()
        weights = held.column("weights").combine_chunks()
        block = held.column("row").to_numpy(), held.column("vec_id").to_numpy(), weights.flatten().to_numpy(), np.append(0, np.cumsum(weights.value_lengths().to_numpy()))
        each = candidates.select("row", "vec_id", "weights").mapInArrow(_search(block, k), _FOUND)
        if parts > 1:
            each = materialize(each, "found")
        found = each if found is None else found.unionByName(each)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a column ``row`` that tells them apart, written so that it stays the same."""
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
