import random

import numpy as np
import pyarrow as pa

from cantorel.llm import toxicity

from .helpers import clashing, docs, rows


def test_machine_learns_a_pair_that_no_single_term_tells(spark):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w = rng.choices([f"word{k}" for k in range(40)], k=20) + ["insult"] * a + ["group"] * b
        rng.shuffle(w)
        texts.append(" ".join(w))
        labels.append((i, int(a and b)))
    df = docs(spark, texts)
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    # a linear model gives these the same step: what the pair adds must come from the factors
    logit = lambda t: float(model.logits(*known(model, t), 1)[0][0])
    none, one, two, both = (logit(f"word1 {x}") for x in ("", "insult", "group", "insult group"))
    assert both - one - two + none > 1
    got = dict(rows(toxicity.score(clashing(df), model), "doc_id", "score"))
    wrong = sum((got[i] >= 0.3) != bool(y) for i, y in labels)
    assert wrong < 60


def test_pairs_with_a_term_of_over_half_of_the_clean_documents(spark):
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(1500):
        a, b, c = rng.random() < 0.3, rng.random() < 0.6, rng.random() < 0.5
        w = rng.choices([f"word{k}" for k in range(40)], k=20) + ["insult"] * a + ["group"] * b + ["kindly"] * (c and a)
        rng.shuffle(w)
        texts.append(" ".join(w))
        labels.append((i, int(a and b and not c)))
    assert sum("group" in t for t, (_, y) in zip(texts, labels) if not y) > sum(not y for _, y in labels) / 2
    model = toxicity.train(docs(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int"))
    for word in ("group", "insult", "kindly"):
        assert len(known(model, word)[0])
    logit = lambda t: float(model.logits(*known(model, t), 1)[0][0])
    none, one, two, both = (logit(f"word1 {x}") for x in ("", "insult", "group", "insult group"))
    assert both - one - two + none > 1 and both > logit("word1 insult group kindly")


def auc(labels, scores):
    pairs = [(a > b) + 0.5 * (a == b) for a, y in zip(scores, labels) if y for b, z in zip(scores, labels) if not z]
    return sum(pairs) / len(pairs)


def scored(spark, texts, labels, fitted, factors=True):
    df = docs(spark, texts)
    marks = spark.createDataFrame(labels[:fitted], "doc_id long, toxic int")
    return dict(rows(toxicity.score(df, toxicity.train(df, marks, factors=factors)), "doc_id", "score"))


def test_insult_with_any_of_six_groups(spark):
    rng = random.Random(9)
    groups = [f"group{g}" for g in "abcdef"]
    texts, labels = [], []
    for i in range(3000):
        a, held = rng.random() < 0.5, [g for g in groups if rng.random() < 0.2]
        w = rng.choices([f"word{k}" for k in range(300)], k=25) + ["insult"] * a + held
        rng.shuffle(w)
        texts.append(" ".join(w))
        labels.append((i, int(a and bool(held))))
    score = scored(spark, texts, labels, 2000)
    assert auc(*zip(*[(y, score[i]) for i, y in labels[2000:] if "insult" in texts[i]])) >= 0.95


def test_factors_tell_what_linear_weights_cannot(spark):
    """Each insult is toxic beside its own group only: any weights give both pairs of pairs the same sum."""
    rng = random.Random(5)
    texts, labels = [], []
    for i in range(3000):
        a, b = rng.choice(["", "brute", "savage"]), rng.choice(["", "northern", "southern"])
        w = rng.choices([f"word{k}" for k in range(300)], k=25) + [a, b]
        rng.shuffle(w)
        texts.append(" ".join(w))
        labels.append((i, int((a, b) in {("brute", "northern"), ("savage", "southern")})))
    got = {}
    for factors in (True, False):
        score = scored(spark, texts, labels, 2000, factors)
        got[factors] = auc(*zip(*[(y, score[i]) for i, y in labels[2000:]]))
    assert got[True] > 0.98 and got[False] < 0.85


def test_pairs_are_found_that_tell_nothing_one_by_one():
    rng = np.random.default_rng(2)
    held = rng.random((4000, 12)) < 0.5
    label = (held[:, 0] ^ held[:, 1]).astype(float)
    row, term = np.nonzero(held)
    model = toxicity.fit(row, term, label, np.arange(12))
    at = model.lookup()[term]
    right = (model.logits(row[at >= 0], at[at >= 0], 4000)[0] > 0) == (label > 0)
    assert right.mean() > 0.95


def test_logits_are_the_sum_over_all_pairs():
    rng = np.random.default_rng(3)
    model = toxicity.Machine(np.arange(9), rng.normal(size=9), rng.normal(size=(9, toxicity.FACTORS)), 0.7)
    held = rng.random((6, 9)) < [[0.6]] * 5 + [[0.0]]
    row, term = np.nonzero(held)
    for d, got in enumerate(model.logits(row, term, 6)[0]):
        at = np.flatnonzero(held[d])
        plain = model.bias + sum(model.weight[i] for i in at)
        plain += sum(sum(model.factor[i][f] * model.factor[j][f] for f in range(toxicity.FACTORS)) for i in at for j in at if i < j)
        assert abs(got - plain) < 1e-9


def known(model, text):
    row, place = toxicity.terms(pa.array([text]))
    term = model.lookup()[place]
    return row[term >= 0], term[term >= 0]


def test_terms_match_a_plain_count():
    row, place = toxicity.terms(pa.array(["The cat, the CAT", None, "", "…", "catalogue cat"]))
    each = [set(place[row == k]) for k in range(5)]
    assert len(each[0]) == 2 and not each[1] and not each[2] and len(each[4]) == 3 and len(each[0] & each[4]) == 1


def test_edges(spark):
    df = docs(spark, [None, "", "x y", "x y"], [1, None, 2, 2])
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(df, nothing)
    assert all(0 <= s < 0.3 for _, s in rows(toxicity.score(df, model), "doc_id", "score"))
    assert toxicity.accepted(df, model).columns == df.columns and toxicity.accepted(df, model).count() == 4
    marks = spark.createDataFrame([(2, 1), (2, 0), (None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.score(docs(spark, []), toxicity.train(df, marks)).count() == 0


def test_held_out_fold(spark):
    import zlib

    df = spark.range(50).select("id").withColumnRenamed("id", "doc_id")
    got = df.select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_fit_without_terms():
    model = toxicity.fit(np.zeros(0, np.int64), np.zeros(0, np.int64), np.array([0.0, 1.0]), np.zeros(0, np.int64))
    assert abs(1 / (1 + np.exp(-model.bias)) - 0.5) < 1e-9
