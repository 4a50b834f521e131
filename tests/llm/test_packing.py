import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cantorel.llm import packing

from .helpers import clashing, docs

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'strevmld 1!?\n\t é中 　<|endoftext|>"), max_size=30), max_size=6))
def test_word_tokenizer_equals_the_tokenizer(texts):
    ids, off = packing.word_tokenizer(PATH).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == plain(texts)


def test_word_tokenizer_forgets(monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 3)
    tok = packing.WordTokenizer(PATH)
    for texts in (["the cat sat", None], ["on a mat of mats", "the cat"], [], [""]):
        ids, off = tok.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == plain(texts)


@pytest.mark.parametrize("proportions", [None, {"a": 0.7, "b": 0.3}])
def test_every_id_in_one_gapless_piece(spark, proportions):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["the", "of", "zyx", "é", "12"], k=rng.randint(0, 400))) for _ in range(60)] + [None, ""]
    ids = [*range(60), None, 61]
    df = docs(spark, texts, ids, "a").withColumn("source", pieces_source()).repartition(3)
    got = packing.pack(clashing(df), PATH, window=256, proportions=proportions, with_ids=True).toPandas()
    want = {i: [*t, 1] for i, t in zip(ids, plain(texts))}
    for d, part in got.groupby(got.doc_id.fillna(-1)):
        part = part.sort_values("start")
        whole = np.concatenate([np.frombuffer(x, "<u4") for x in part.ids]).tolist()
        assert whole == want[None if d == -1 else int(d)]
        assert (part.doc_tokens == len(whole)).all()
    assert all(zlib.crc32(x) == c for x, c in zip(got.ids, got.ids_crc32))
    sizes = []
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == np.append(0, np.cumsum(s.length))[:-1].tolist()
        sizes.append(s.length.sum())
    assert all(x == 256 for x in sizes[:-1]) and len(sizes) == got.sequence_id.max() + 1


def pieces_source():
    from pyspark.sql import functions as F

    return F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b")


def test_windows_hold_the_target_mixture():
    totals = {"=a": 50_000, "=b": 30_000, "=c": 20_000}
    plan = packing.Schedule(totals, 1000)
    share = np.zeros((100, 3), int)
    for q, (name, n) in enumerate(totals.items()):
        _, _, length, seq, _ = plan.pieces(np.array([q]), np.array([0]), np.array([n]))
        np.add.at(share[:, q], seq, length)
    assert (share.sum(1) == 1000).all()
    assert (abs(share - [500, 300, 200]) <= 3).all()


def sequential(totals, window, **kw):
    """The tree's queues served one token after the other: (queue, position) of the tokens of each window, in order."""
    plan, names = packing.Schedule(totals, window, **kw), list(totals)
    left_of = {}
    for q in range(len(names)):
        at = tuple((int(plan.path[q, d]), bool(plan.right[q, d])) for d in range(plan.depth[q]))
        left_of[at] = q
    credit, held, next_token = {}, dict(enumerate(totals.values())), [0] * len(names)

    def stock(path):
        return sum(n for at, n in ((a, held[q]) for a, q in left_of.items()) if at[: len(path)] == path)

    def serve(path, k):
        if path in left_of:
            q = left_of[path]
            held[q] -= k
            next_token[q] += k
            return [(q, next_token[q] - k + i) for i in range(k)]
        node = next(a[len(path)][0] for a in left_of if a[: len(path)] == path)
        owed = credit.get(node, Fraction(0)) + k * Fraction(int(plan.node_share[node]), 1 << 36)
        a, b = stock((*path, (node, False))), stock((*path, (node, True)))
        n = min(max(owed.numerator // owed.denominator, k - b), a)
        credit[node] = owed - n
        return serve((*path, (node, False)), n) + serve((*path, (node, True)), k - n)

    out, rest = [], sum(totals.values())
    while rest:
        out.append(serve((), min(window, rest)))
        rest -= len(out[-1])
    return out


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.integers(1, 300), min_size=1, max_size=7), st.integers(1, 60), st.sampled_from([None, 0.3, 1.0]),
    st.lists(st.sampled_from([0.0, 0.001, 0.2, 1.0]), min_size=7, max_size=7), st.integers(1, 40),
)
def test_closed_form_is_a_sequential_deficit_round_robin(sizes, window, temperature, targets, step):
    totals = {f"={i}": n for i, n in enumerate(sizes)}
    kw = {"proportions": dict(zip(totals, targets))} if temperature is None else {"temperature": temperature}
    plan, got = packing.Schedule(totals, window, **kw), {}
    for q, n in enumerate(sizes):
        at = np.arange(0, n, step)
        size = np.minimum(step, n - at)
        for run, start, length, seq, offset in zip(*(v.tolist() for v in plan.pieces(np.full(len(at), q), at, size))):
            for i in range(length):
                got[q, int(at[run]) + start + i] = (seq, offset + i)
    want = {token: (s, o) for s, tokens in enumerate(sequential(totals, window, **kw)) for o, token in enumerate(tokens)}
    assert got == want


def test_windows_hold_the_targets_until_a_queue_is_dry():
    rng = np.random.default_rng(5)
    totals = {f"={i:03}": int(n) for i, n in enumerate(rng.integers(10**6, 10**8, 300))}
    want = dict(zip(totals, rng.random(300)))
    plan = packing.Schedule(totals, 2048, want)
    share = np.array(list(want.values())) / sum(want.values())
    dry = min(n / (2048 * f) for n, f in zip(totals.values(), share))
    for r in (1, 2, 77, int(dry / 2), int(dry) - 2):
        sent, before = plan.sent(np.arange(300), np.full(300, r))
        assert (abs(sent - r * 2048 * share) <= plan.depth + 1).all() and sent.sum() == r * 2048
        assert sorted(before.tolist())[0] == 0 and (before + sent).max() == r * 2048
    assert plan.depth.max() <= 24


def test_large_totals_missing_targets_and_rare_sources():
    # far beyond 2^21 tokens of a queue without a target
    totals = {"=a": 1 << 40, "=b": 1 << 40}
    plan = packing.Schedule(totals, 2048, {"=a": 1.0})
    run, start, length, seq, offset = plan.pieces(np.array([1, 0]), np.array([1 << 20, 5]), np.array([5000, 5000]))
    assert seq[run == 1].tolist() == [0, 1, 2] and length.sum() == 10_000
    assert seq[run == 0].min() == ((1 << 40) + (1 << 20)) // 2048 and (offset >= 0).all()
    # 10,000 tokens of a source of a 10^-8 share are looked up one by one, not by their 5 * 10^8 rounds
    totals = {"=a": 10**13, "=rare": 10**5}
    plan = packing.Schedule(totals, 2048)
    run, start, length, seq, offset = plan.pieces(np.array([1]), np.array([50_000]), np.array([10_000]))
    assert length.tolist() == [1] * 10_000 and (np.diff(seq) > 0).all()
    middle = 10**13 / 2048
    assert abs(seq[0] / middle - 0.5) < 0.01 and abs(seq[-1] / middle - 0.6) < 0.01
    sent, _ = plan.sent(np.array([0, 1]), np.array([1 << 62, 1 << 62]) // 2048)
    assert sent.tolist() == [10**13, 10**5]
    with pytest.raises(ValueError):
        packing.Schedule({"=a": 1 << 47}, 2048)


def test_long_documents_are_cut_into_runs(spark, monkeypatch):
    df = spark.createDataFrame([(1, "the of " * 3000, "a"), (2, "zyx " * 500, "b"), (3, None, None)], "doc_id long, text string, source string")
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = sorted(map(tuple, packing.pack(df, PATH, window=512).select(key).collect()))
    read = packing._pack

    def small(plan, with_ids):
        def run(batches):
            packing.RUN = 700
            yield from read(plan, with_ids)(batches)

        return run

    monkeypatch.setattr(packing, "_pack", small)
    cut = packing.pack(df, PATH, window=512).select("doc_id", "length", "sequence_id").collect()
    assert sum(r.length for r in cut) == sum(r[2] for r in whole)
    by = lambda rows: sorted((d, s, sum(r[1] for r in rows if (r[0], r[2]) == (d, s))) for d, s in {(r[0], r[2]) for r in rows})
    assert by([(r[0], r[2], r[5]) for r in whole]) == by([tuple(r) for r in cut])


def test_empty_table_and_many_sources(spark):
    assert packing.pack(docs(spark, []), PATH).count() == 0
    df = spark.createDataFrame([(i, "some words", f"s{i}") for i in range(9)], "doc_id long, text string, source string")
    assert packing.pack(df, PATH).groupBy("doc_id").count().count() == 9


def test_over_256_sources_keep_their_proportions(spark):
    rows = [(i, "the of " * (600 if i < 2 else 4), f"s{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(df, PATH, window=256, proportions={"s0": 0.75, "s1": 0.25}).filter("sequence_id = 0")
    sent = {r.doc_id: r.n for r in got.groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert abs(sent[0] - 192) <= 2 and abs(sent[1] - 64) <= 2
