import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cantorel.llm import resample as rs

from .helpers import clashing, docs, rows


def good(i):
    return " ".join(f"fine{(i * k) % 23} words" for k in range(1, 12))


def bad(i):
    return " ".join(f"junk{(i * k) % 19} %%%" for k in range(1, 12))


def test_target_like_documents_are_sampled(spark):
    texts = [good(i) if i % 4 else bad(i) for i in range(200)]
    df = docs(spark, texts)
    kept = rs.resample(clashing(df), df.filter("doc_id % 4 = 1"), fraction=0.75)
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids) == 150 and sum(i % 4 != 0 for i in ids) >= 148


def test_weights_match_a_plain_sum(spark):
    texts = [good(i) for i in range(12)] + [bad(3), None, ""]
    df = docs(spark, texts)
    target = df.filter("doc_id < 5")
    got = dict(rows(rs.resample(df, target, fraction=1.0), "doc_id", "log_weight"))

    def counts(ts):
        c = Counter()
        for t in ts:
            c.update(rs.buckets(pa.array([t]))[0].tolist())
        return c

    raw, want = counts(texts), counts(texts[:5])
    p = lambda c, b: (c[b] + 1) / (sum(c.values()) + rs.BUCKETS)
    for i, t in enumerate(texts):
        w = sum(math.log(rs.BLEND + (1 - rs.BLEND) * p(want, b) / p(raw, b)) for b in rs.buckets(pa.array([t]))[0].tolist())
        assert abs(got[i] - w) < 1e-9


def test_cut_is_the_kth_greatest(spark):
    keys = [float(x) for x in np.random.default_rng(0).normal(0, 1, 500)] + [1.0] * 7 + [1e300, -1e300, 1e-300]
    df = spark.createDataFrame([(k,) for k in keys], "key double")
    for k in (1, 2, 50, 260, len(keys)):
        assert rs.cut(df, k) == sorted(keys, reverse=True)[k - 1]
    assert rs.cut(df, 0) is None


def test_edges(spark):
    df = docs(spark, ["a b", "a b", None, "c"], [1, 1, None, 2])
    got = rs.resample(df, df.limit(0), fraction=0.25)
    assert got.count() in (1, 2)
    assert rs.resample(docs(spark, []), df, fraction=0.5).count() == 0
    once = rs.resample(df, df, fraction=0.5).collect()
    assert sorted(map(str, once)) == sorted(map(str, rs.resample(df.repartition(3), df, fraction=0.5).collect()))


def test_labelled_target_is_bounded(spark):
    df = clashing(docs(spark, [good(i) for i in range(50)] + [None], [*range(50), None]))
    labels = spark.createDataFrame([(i % 30,) for i in range(60)] + [(None,), (99,)], "doc_id long")
    assert rs.labelled_target(df, labels).columns == df.columns
    assert rs.labelled_target(df, labels).count() == 30
    assert rs.labelled_target(df, labels, max_target=7).count() in (6, 7)


def test_every_labelled_document_counts(spark):
    n = 20_050
    df = spark.range(n).selectExpr("id AS doc_id", "concat('word', id % 7) AS text")
    assert rs.labelled_target(df, df.select("doc_id")).count() == n
    assert "Broadcast" not in rs.labelled_target(df, df.select("doc_id"))._jdf.queryExecution().executedPlan().toString()


def test_first_drawn_in_proportion_to_weight(spark):
    n = 6000
    df = spark.range(n).selectExpr("id AS doc_id", "id % 3 AS mark").withColumn("w", F.log(F.array_position(F.array(F.lit(0), F.lit(1), F.lit(2)), F.col("mark").cast("int")).cast("double")))
    key = rs.gumbel("doc_id", "mark")
    # of each three neighbours, with weights 1, 2 and 3, the one with the greatest key
    won = df.groupBy(F.floor(F.col("doc_id") / 3).alias("g")).agg(F.max_by("mark", F.col("w") + key).alias("m")).groupBy("m").count()
    got = {r.m: r["count"] / (n / 3) for r in won.collect()}
    assert all(abs(got[k] - (k + 1) / 6) < 0.035 for k in range(3))


def test_unseen_labels_are_told_apart(spark):
    """The target is counted on three quarters of the good documents; what is kept is measured on the others."""
    rng = random.Random(4)
    texts, quality = [], []
    for i in range(600):
        y = rng.random() < 0.8
        own = [f"fine{rng.randrange(300)}" if y else f"junk{rng.randrange(300)}" for _ in range(20)]
        texts.append(" ".join(rng.choices([f"w{k}" for k in range(200)], k=30) + own))
        quality.append(int(y))
    df = docs(spark, texts)
    labels = spark.createDataFrame(list(enumerate(quality)), "doc_id long, quality int")
    seen = labels.filter("doc_id % 4 <> 2")
    share = rs.good_share(seen)
    kept = {r.doc_id for r in rs.resample(df, rs.labelled_target(df, seen.filter("quality = 1")), share).collect()}
    good = [i for i in range(600) if i % 4 == 2 and quality[i]]
    poor = [i for i in range(600) if i % 4 == 2 and not quality[i]]
    assert sum(i in kept for i in good) / len(good) > 0.95 and sum(i in kept for i in poor) / len(poor) < 0.2
    assert rs.good_share(labels.limit(0)) == 1.0
