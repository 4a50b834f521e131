import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from cantorel.llm import graph, simhash
from cantorel.llm.kernels import text_bytes, xxh64

from .helpers import clashing, docs, rows


def brute_print(text):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_prints_of_odd_texts_match_brute_force(monkeypatch):
    rng = random.Random(7)
    parts = ["a", "É", "ß" * 9, "x" * 31, "y" * 32, "z" * 33, "Q" * 70, "w" * 300, "1.5", " ", "\n\t", "\x0b", "\xa0", "\r"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(300)] + [None, "", " ", "one", "a b", "a b c", "k" * 5000]
    texts += [" ".join(rng.choices("abcdefgh", k=n)) for n in (256, 257, 258, 600, 1300)]
    assert simhash.prints_of(*text_bytes(pa.array(texts))).tolist() == [brute_print(t) for t in texts]
    monkeypatch.setattr(simhash, "SHINGLES", 11)
    got = simhash.prints_of(*text_bytes(pa.array(texts)))
    assert got.tolist() == [brute_print(t) for t in texts]


def test_hashes_are_xxh64():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    start = rng.integers(0, 2500, 800)
    end = start + rng.choice([*range(0, 70), 255, 256, 257, 400], 800)
    want = [xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for a, b in zip(start, end)]
    assert xxh64(data, start, end, 42).tolist() == want


def brute_components(prints, ids):
    group = list(range(len(prints)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                group[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_fingerprints_and_components_match_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}É" for i in range(50)]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 300))) for _ in range(30)]
    texts = base + [t + " extra" for t in base] + [t.upper() for t in base[:5]] + [None, "", " \t", "one", "one two", base[0]]
    ids = list(range(len(texts)))
    got = rows(simhash.near_duplicates(clashing(docs(spark, texts, ids))), "doc_id", "fingerprint", "component_id")
    prints = [brute_print(t) for t in texts]
    assert got == sorted(((i, f"{p:016x}", c) for i, p, c in zip(ids, prints, brute_components(prints, ids))), key=repr)
    assert prints[len(base) * 2 + 5] == 0


@pytest.mark.parametrize("piece", [2048, 7])
def test_links_lose_nothing(spark, monkeypatch, piece):
    rng = random.Random(2)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(10) for b in range(10)}  # one large bucket
    fps = sorted(fps)
    if piece != 2048:  # the kernel alone, as a worker would not see the change
        monkeypatch.setattr(simhash, "PIECE", piece)
        u, v = kernel_links(np.array(fps, np.uint64))
    else:
        signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
        found = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
        u, v = [r.u for r in found], [r.v for r in found]
    at = {x - (1 << 64) if x >> 63 else x: i for i, x in enumerate(fps)}
    uf = graph.UnionFind(len(fps))
    for a, b in zip(u, v):
        uf.union(at[int(a)], at[int(b)])
    assert [uf.find(i) for i in range(len(fps))] == brute_components(fps, list(range(len(fps))))


def kernel_links(fps):
    out_u, out_v, held = [], [], []
    for m in simhash.MASKS:
        bucket = (fps & np.uint64(m)).view(np.int64)
        order = np.argsort(bucket, kind="stable")
        parts = [pa.RecordBatch.from_arrays([pa.array(bucket[k]), pa.array(fps[k].view(np.int64))], ["bucket", "fp"]) for k in np.array_split(order, 9)]
        for batch in simhash._buckets(iter(parts)):
            for r in batch.to_pylist():
                if r["held"] is None:
                    out_u.append(r["u"])
                    out_v.append(r["v"])
                else:
                    held.append((m, r["bucket"], r["piece"], r["held"]))
    pairs = [(a[3], b[3]) for a in held for b in held if a[:2] == b[:2] and a[2] < b[2]]
    assert pairs
    table = pa.RecordBatch.from_pydict({"a": [a for a, _ in pairs], "b": [b for _, b in pairs]})
    for batch in simhash._piece_pairs(iter([table])):
        out_u += batch.column("u").to_pylist()
        out_v += batch.column("v").to_pylist()
    return out_u, out_v


def test_a_hot_bucket_is_dealt_over_tasks(spark):
    """6,000 fingerprints that share half of their bits: one bucket of a table holds them all, and several tasks work on it."""
    rng = random.Random(3)
    fps = sorted({(0xABCDEF12 << 32) | rng.getrandbits(32) for _ in range(6000)} | {(0xABCDEF12 << 32) | 5, (0xABCDEF12 << 32) | 4})
    signed = [(x - (1 << 64),) for x in fps]
    df = spark.createDataFrame(signed, "fp long").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = simhash.links(df).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    at = {x - (1 << 64): i for i, x in enumerate(fps)}
    uf, want = graph.UnionFind(len(fps)), graph.UnionFind(len(fps))
    for r in found:
        uf.union(at[r.u], at[r.v])
    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1 :]) <= 3).tolist():
            want.union(i, i + 1 + j)
    assert [uf.find(i) for i in range(len(fps))] == [want.find(i) for i in range(len(fps))]


def test_one_of_each_keeps_columns_and_smallest_id(spark):
    t = "a b c d e f g"
    df = docs(spark, [t, t, t, "quite other words here", None], [5, 3, 3, 9, None])
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert rows(kept, "doc_id") == [(3,), (9,), (None,)]


def test_one_of_each_keeps_other_texts_under_a_repeated_or_missing_id(spark):
    a, b, c, d, e = ("red green blue one two", "quite other words here", "third unrelated text of some length", "the fourth is alone too", "fifth with id and copy")
    df = clashing(docs(spark, [a, b, b, e, e, c, d, c, None, ""], [None, None, None, None, 4, 7, 7, 7, None, None]))
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text or "") for r in kept.select("doc_id", "text").collect()]
    assert sorted(got, key=repr) == sorted([(None, ""), (None, a), (None, b), (4, e), (7, c), (7, d)], key=repr)


def test_empty(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.one_of_each(docs(spark, [])).count() == 0


def test_components_of_chain_star_and_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (1, 0)]
    got = graph.components(spark.createDataFrame(edges, "u long, v long").repartition(5))
    assert rows(got, "node", "root") == sorted([(i, 0) for i in range(41)] + [(100 + i, 100) for i in range(30)], key=repr)
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0
