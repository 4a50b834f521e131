import math
import random

import numpy as np
import pyarrow as pa

from cantorel.llm import topk

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    good = [(n, i, [math.floor(256.0 * x) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in good:
        if i % 5 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, j, v in good if m != n)[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def found(spark, rows, k=3):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    v = topk.numbered(topk.quantized(df, "vec_id", "embedding"))
    return sorted(tuple(r) for r in topk.search(v.filter("vec_id % 5 = 0"), v, k).collect())


def test_matches_brute_force_with_ties_and_repeats(spark):
    rng = random.Random(2)
    unit = lambda: [rng.choice([0.0, 0.0, rng.randint(-64, 64) / 64]) for _ in range(6)]
    rows = [(i, unit()) for i in range(80)] + [(7, [0.5] * 6)] * 4 + [(200 + i, [0.25] * 6) for i in range(10)]
    rows += [(90, None), (91, [None, 1.0]), (92, [float("nan")]), (93, [float("inf")]), (None, [1.0]), (95, [1.0]), (100, [])]
    assert found(spark, rows) == brute(rows, 3)


def test_passes_are_merged(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(300)]
    monkeypatch.setattr(topk, "PASS_BYTES", 1000)
    assert found(spark, rows, 5) == brute(rows, 5)


def test_blocks_of_a_task_are_merged(monkeypatch):
    rng = random.Random(4)
    rows = [(i % 40, [rng.randint(-3, 3) for _ in range(5)]) for i in range(150)]
    monkeypatch.setattr(topk, "CANDIDATES", 7)
    monkeypatch.setattr(topk, "QUERIES", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(150)), pa.array([i for i, _ in rows]), pa.array([v for _, v in rows])], ["row", "vec_id", "weights"])
    asked = list(range(0, 150, 4))
    block = np.array(asked), np.array([rows[n][0] for n in asked]), np.array([x for n in asked for x in rows[n][1]]), np.arange(len(asked) + 1) * 5
    got = pa.Table.from_batches(topk._search(block, 4)([batch.slice(0, 60), batch.slice(60)])).to_pylist()
    for n in asked:
        score = lambda m: sum(a * b for a, b in zip(rows[n][1], rows[m][1]))  # noqa: B023, E731
        want = sorted((-score(m), rows[m][0]) for m in range(150) if m != n)[:4]
        assert sorted((-r["score"], r["vec_id"]) for r in got if r["query_row"] == n) == want


def test_components_beyond_64_bits_are_put_at_their_end(spark):
    df = spark.createDataFrame([(1, [1e30, -1e30], 0)], VECTORS)
    assert topk.quantized(df, "vec_id", "embedding").first().weights == [2**63 - 1, -(2**63)]


def test_few_and_none(spark):
    assert found(spark, []) == []
    assert found(spark, [(5, [1.0])]) == []
    assert found(spark, [(5, [1.0]), (6, [2.0])]) == [(5, 1, 6, 256 * 512)]
