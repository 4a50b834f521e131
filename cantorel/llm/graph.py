"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantorel.llm.storage import drop, materialize

#: Edges a task folds into stars at once.
FOLD_EDGES = 1 << 18


class UnionFind:
    """Union-find over array positions with path halving; a root is its set's smallest position."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as edges (a, b), each as a star around its smallest node: (leaf, centre)."""
    names, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    uf = UnionFind(len(names))
    for x, y in zip(inverse[: len(a)].tolist(), inverse[len(a) :].tolist()):
        uf.union(x, y)
    root = np.array([uf.find(x) for x in range(len(names))], dtype=np.int64)
    leaf = root != np.arange(len(names))
    return names[leaf], names[root[leaf]]


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        u, v = stars(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    size = 0
    for batch in batches:
        held.append((batch.column("u").to_numpy(), batch.column("v").to_numpy()))
        size += batch.num_rows
        if size >= FOLD_EDGES:
            yield out()
            size = 0
    if held:
        yield out()


def components(edges: DataFrame) -> DataFrame:
    """Columns (u long, v long) of undirected edges to (node, root), root the smallest node of its component.

    Nodes without edges do not occur. Loops and repeated edges change nothing; an empty
    table gives an empty table. Each task first folds its edges into stars, so that at
    most (nodes - 1) edges a task are shuffled; the star steps then need about log n
    rounds. Every step is a partial aggregate and an equi-join that adaptive execution
    can split, so one component with a third of all nodes does not gather in one task.
    """
    fold = lambda df: df.filter("u <> v").mapInArrow(_fold, "u long, v long").distinct()
    now, was = materialize(fold(edges), "edges"), None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        after = materialize(small.filter("u <> v").distinct(), "stars")
        mark = [
            x.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
            for x in (now, after)
        ]
        drop(was)
        if mark[0] == mark[1]:
            drop(now)
            break
        was, now = now, after
    return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
