"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and punctuation runs and their bigrams are hashed into buckets. Bucket counts over all
documents make the raw model, counts over the target documents the target model. A
document's log weight is the sum over its n-grams of log(target / raw); adding a Gumbel
draw and keeping the k greatest samples k documents without replacement in proportion to
their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantorel.llm.kernels import _GOLDEN, chunks, splitmix, token_hashes
from cantorel.llm.storage import drop, materialize, ship

BUCKETS = 10_000
#: Counts added to every bucket of either model.
SMOOTHING = 1.0
#: Share of the raw model in the target model. It bounds what one bucket can take from a weight at log(1/20).
BLEND = 0.05
SEED = 17
#: Bins of one step of the search for the cut.
_STEP_BITS = 16


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every unigram and bigram of a column, and the row of each."""
    h, row = token_hashes(column)
    pair = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
    two = splitmix(h[:-1] * _GOLDEN ^ h[1:])[pair] if len(h) else h
    every = np.concatenate([h, two]) % np.uint64(BUCKETS)
    return every.astype(np.int64), np.concatenate([row, row[1:][pair]]) if len(row) else row


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for whole in batches:
        for batch in chunks(whole, "text"):
            total += np.bincount(buckets(batch.column("text"))[0], minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities of all buckets over every row of ``docs``; one row a bucket comes to the driver."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    total = np.full(BUCKETS, SMOOTHING)
    for r in rows.mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] += r["n"]
    return np.log(total / total.sum())


def _weigh(ratio: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                bucket, row = buckets(batch.column("text"))
                weight = np.bincount(row, ratio[bucket], minlength=batch.num_rows).astype(float)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(weight)], ["doc_id", "mark", "log_weight"])

    return run


def gumbel(*keys: str, seed: int = SEED) -> Column:
    """A standard Gumbel draw fixed by the key columns."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def cut(scored: DataFrame, k: int) -> float | None:
    """The k-th greatest ``key`` of a table; None for k = 0.

    A histogram narrows the interval that holds it until all keys in it are equal, each
    pass over the table bringing at most 2^16 bins to the driver.
    """
    if k <= 0:
        return None
    low, high = scored.agg(F.min("key"), F.max("key")).first()
    while low < high:
        width = (high - low) / (1 << _STEP_BITS)
        inside = scored.filter(F.col("key").between(low, high))
        if width == 0.0 or low + width == low:
            tail = inside.groupBy("key").count().orderBy(F.desc("key")).limit(1 << _STEP_BITS).collect()
            bins = [(r["key"], r["key"], r["count"]) for r in tail]
        else:
            bin_of = F.least(F.floor((F.col("key") - low) / width), F.lit((1 << _STEP_BITS) - 1))
            rows = inside.groupBy(bin_of.alias("bin")).agg(F.min("key").alias("a"), F.max("key").alias("b"), F.count("*").alias("n")).collect()
            bins = [(r["a"], r["b"], r["n"]) for r in sorted(rows, key=lambda r: -r["bin"])]
        for low, high, n in bins:
            if k <= n:
                break
            k -= n
    return low


def labelled_target(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", max_target: int | None = None) -> DataFrame:
    """The rows of ``docs`` whose id is in ``labels``, or among ``max_target`` of these ids by their hash where that is given.

    Ids and rows meet in a shuffle whatever their number, so nothing is held on the driver or
    sent to every worker. Null ids don't count, repeated ones count once.
    """
    ids = labels.select(F.col(id_col).cast("long").alias("__target")).dropna().distinct()
    if max_target is not None:
        ids = ids.orderBy(F.xxhash64("__target"), "__target").limit(max_target)
    return docs.join(ids.hint("shuffle_hash"), docs[id_col].cast("long") == ids["__target"], "left_semi")


def good_share(labels: DataFrame, label_col: str = "quality") -> float:
    """The share of wanted rows among labelled ones, which stands for that of all rows; 1 without labels. Null labels don't count."""
    r = labels.agg(F.count_if(F.col(label_col) == 1).alias("good"), F.count(label_col).alias("n")).first()
    return r["good"] / r["n"] if r["n"] else 1.0


def resample(docs: DataFrame, target: DataFrame, fraction: float, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(doc_id, log_weight, key, selected): the round(fraction * n) sampled rows of ``docs``.

    ``target`` holds texts that are wanted; every row of ``docs`` counts for the raw model. The
    first of the sampled rows is row i with a probability in proportion to exp(log_weight_i), the
    next one likewise among the rest. Weights are sums over a text's n-grams, as for the published
    method: two short texts of near weights are drawn by chance, of two long ones the better one
    is drawn nearly always.

    Null and empty texts have log weight 0. The draw is fixed by seed, id and text, so
    repeated rows share one; rows that tie with the last one kept are kept with it. Null ids
    are drawn like others. An empty target makes the target model uniform; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    raw = model(docs, text_col)
    ratio = np.logaddexp(np.log1p(-BLEND) + model(target, text_col), np.log(BLEND) + raw) - raw
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    weighed = rows.mapInArrow(_weigh(ratio), "doc_id long, mark long, log_weight double")
    scored = materialize(weighed.withColumn("key", F.col("log_weight") + gumbel("doc_id", "mark", seed=seed)), "weights")
    least = cut(scored, round(fraction * scored.count()))
    if least is None:
        drop(scored)
        return spark.createDataFrame([], "doc_id long, log_weight double, key double, selected boolean")
    return scored.filter(F.col("key") >= least).select("doc_id", "log_weight", "key", F.lit(True).alias("selected"))
