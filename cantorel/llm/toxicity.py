"""Toxicity by a factorization machine over hashed terms.

Terms are lower-cased words and the beginnings of longer words, hashed into 2^20 places.
The machine gives a document with terms S the logit

    b + sum_{i in S} w_i + sum_{i < j in S} <v_i, v_j>

so that two terms can weigh together (an insult with the mention of a group) what neither
weighs alone. It is fitted on a bounded sample of labelled rows, over all their terms: in
each pass a term gets a weight and factors as soon as the gradient of either is beyond
chance given the machine so far (grafting), so a term that tells nothing by itself enters
by what it tells beside others. There is no other choice of terms and no bound on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantorel.llm.kernels import _CLASS, _GOLDEN, _LOWER, _POWERS, WORD, chunks, run_hashes, runs, splitmix, text_bytes
from cantorel.llm.storage import drop, materialize, ship

PLACES = 1 << 20
#: Bytes of the word beginnings that are terms too.
STEMS = (5,)
#: Bounds of the sample that the machine is fitted on: labelled documents, and their (document, term) pairs.
MAX_LABELLED, MAX_PAIRS = 10_000, 1 << 23
_STEM_SALT = np.arange(2, 2 + max(STEMS), dtype=np.uint64) * _GOLDEN
FACTORS, STEPS, RATE, DECAY = 8, 80, 0.05, 2e-5
#: Passes over all terms, by how many times as sure a gradient must be as in the last: what strong terms explain, their neighbours need not.
PASSES = (9, 3, 1, 1)
#: Random sums over all terms in which the last pass but one looks for pairs of terms that tell nothing one by one.
SKETCHES = 2
#: Pairs that are summed at once (their temporaries are larger).
_PART = 1 << 20
THRESHOLD = 0.3


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, place) pairs of a column's terms, sorted."""
    data, off = text_bytes(column)
    data = _LOWER[data]
    starts, kind = runs(data, off, _CLASS[data])
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.diff(np.append(starts, len(data)))
    word = kind == WORD
    hashes = run_hashes(data, starts)[word]
    starts, size = starts[word], size[word]
    row = np.searchsorted(off, starts, "right") - 1
    rows, places = [row], [hashes]
    partial = np.zeros(len(starts), np.uint64)
    for k in range(max(STEMS)):
        longer = size > k
        partial[longer] += (data[starts[longer] + k].astype(np.uint64) + np.uint64(1)) * _POWERS[k]
        if k + 1 in STEMS:
            stem = size > k + 1
            rows.append(row[stem])
            places.append(splitmix(partial[stem] ^ _STEM_SALT[k]))
    key = np.concatenate(rows) * PLACES + (np.concatenate(places) >> np.uint64(44)).astype(np.int64)
    key = np.unique(key)
    return key // PLACES, key % PLACES


@dataclass
class Machine:
    """A fitted machine: sorted places, their weights and factors, the bias."""

    places: np.ndarray
    weight: np.ndarray
    factor: np.ndarray
    bias: float

    def lookup(self) -> np.ndarray:
        table = np.full(PLACES, -1, np.int32)
        table[self.places] = np.arange(len(self.places))
        return table

    def logits(self, row: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Logits of n documents with sorted (row, term) pairs, and the sums of their terms' factors."""
        out = self.bias + np.bincount(row, self.weight[term], minlength=n)
        full = np.zeros((n, FACTORS))
        if len(row):
            starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            v, at = self.factor[term], row[starts]
            full[at] = np.add.reduceat(v, starts)
            out[at] += 0.5 * (full[at] ** 2 - np.add.reduceat(v**2, starts)).sum(1)
        return out, full


def _by_term(row: np.ndarray, term: np.ndarray, value: np.ndarray, m: int) -> np.ndarray:
    """Sum over each term's documents of a value of the document (or, the other way round, over each document's terms)."""
    out = np.zeros(m)
    for k in range(0, len(row), _PART):
        out += np.bincount(term[k : k + _PART], value[row[k : k + _PART]], minlength=m)
    return out


def _surprising(total: np.ndarray, variance: np.ndarray, most: float, sure: float) -> np.ndarray:
    """Bernstein's inequality: whether a sum of errors, none over ``most``, is that large by chance once in exp(sure)."""
    return total**2 > 2 * sure * (variance + most * np.abs(total) / 3)


def _gradients(row: np.ndarray, term: np.ndarray, m: int, error: np.ndarray, chance: np.ndarray, beside: list[np.ndarray], sure: float) -> np.ndarray:
    """Terms whose weight or factors would move for more than chance. ``beside``: what factors a document holds, one column each."""
    out = _surprising(_by_term(row, term, error, m), _by_term(row, term, chance, m), 1.0, sure)
    for x in beside:
        most = float(np.abs(x).max(initial=0.0))
        if most > 0:
            spread = np.maximum(chance, error**2) * x * x
            out |= _surprising(_by_term(row, term, error * x, m), _by_term(row, term, spread, m), most, sure)
    return out


def _descend(row: np.ndarray, term: np.ndarray, label: np.ndarray, model: Machine) -> None:
    """Full-batch Adam on the logistic loss over the machine's own terms; deterministic."""
    n, m = len(label), len(model.weight)
    order = np.argsort(term, kind="stable")
    by_term, starts = row[order], np.flatnonzero(np.append(True, np.diff(term[order]) > 0)) if len(term) else np.zeros(0, np.int64)
    seen = term[order][starts]
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (model.weight, model.factor, np.zeros(1))]
    for step in range(1, STEPS + 1):
        logit, full = model.logits(row, term, n)
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label
        back = np.zeros((m, FACTORS + 1))
        if len(seen):
            back[seen] = np.add.reduceat(np.column_stack([error, error[:, None] * full])[by_term], starts)
        grads = (
            back[:, 0] / n + DECAY * model.weight,
            (back[:, 1:] - back[:, :1] * model.factor) / n + DECAY * model.factor,
            np.array([error.mean()]),
        )
        moves = []
        for (a, b), grad in zip(state, grads):
            a += 0.1 * (grad - a)
            b += 0.001 * (grad**2 - b)
            moves.append(RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8))
        model.weight -= moves[0]
        model.factor -= moves[1]
        model.bias -= float(moves[2][0])


def fit(row: np.ndarray, term: np.ndarray, label: np.ndarray, places: np.ndarray, factors: bool = True) -> Machine:
    """A machine from sorted (row, term) pairs, term a position in ``places``; without ``factors`` it is linear."""
    n, m = len(label), len(places)
    rate = float(label.mean()) if n else 0.0
    model = Machine(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)), float(np.log((rate * n + 0.5) / ((1 - rate) * n + 0.5))) if n else -30.0)
    if not len(row) or rate in (0.0, 1.0):
        return model
    random = np.random.default_rng(7)
    live = np.zeros(m, bool)
    mine, own = np.zeros(0, bool), np.zeros(0, np.int64)
    for k, times in enumerate(PASSES):
        logit, full = model.logits(row[mine], own, n) if k else (np.full(n, model.bias), np.zeros((n, FACTORS)))
        guess = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        beside = [full[:, f] for f in range(FACTORS)] if factors else []
        if factors and k == len(PASSES) - 2:
            beside += [_by_term(term, row, signs, n) for signs in random.choice([-1.0, 1.0], (SKETCHES, m))]
        new = _gradients(row, term, m, guess - label, guess * (1 - guess), beside, times * np.log(max(m, 3)) / 2) & ~live
        if not new.any():
            continue
        weight, factor = np.zeros(m), np.zeros((m, FACTORS))
        weight[live], factor[live] = model.weight, model.factor
        factor[new] = random.normal(0, 0.02, (np.count_nonzero(new), FACTORS)) if factors else 0.0
        live |= new
        model = Machine(places[live], weight[live], factor[live], model.bias)
        mine = live[term]
        own = (np.cumsum(live) - 1)[term[mine]]
        _descend(row[mine], own, label, model)
    return model


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunks(whole, "text"):
            row, place = terms(batch.column("text"))
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), held], ["doc_id", "label", "places"])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_labelled: int = MAX_LABELLED, max_pairs: int = MAX_PAIRS, factors: bool = True,
) -> Machine:
    """Fit on at most ``max_labelled`` labelled rows, taken by a hash of their id.

    If these hold more than about ``max_pairs`` terms in all, a share of them is taken, so that
    the driver's memory is bounded for texts of any length. Rows with a null id or label don't
    count; a document labelled both ways is toxic; of repeated documents one, by a hash of its
    text, is an example. Without labelled rows, or with one class alone, every score is that
    class's. Only the places of the sampled rows' terms come to the driver.
    """
    ship(docs.sparkSession)
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna()
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # at most max_labelled pairs of numbers
    sample = rows.join(F.broadcast(marks), "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    held = materialize(sample.mapInArrow(_sparse, "doc_id long, label int, places array<int>"), "labelled")
    pairs = held.agg(F.sum(F.size("places")).alias("n")).first()["n"] or 0
    order = F.xxhash64("doc_id", F.lit(5))
    part = held if pairs <= max_pairs else held.filter(F.pmod(order, F.lit(1 << 20)) < int(max_pairs / pairs * (1 << 20)))
    found = part.select("doc_id", "label", "places").orderBy("doc_id").toArrow()
    drop(held)
    column = found.column("places").combine_chunks()
    label = found.column("label").to_numpy().astype(float)
    row = np.repeat(np.arange(len(column), dtype=np.int32), np.diff(column.offsets.to_numpy()))
    places, term = np.unique(column.values.to_numpy(), return_inverse=True)
    return fit(row, term.astype(np.int32), label, places.astype(np.int64), factors)


def _score(model: Machine, column: str, reject: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.lookup()
        for whole in batches:
            for batch in chunks(whole, column):
                row, place = terms(batch.column(column))
                term = table[place]
                row, term = row[term >= 0], term[term >= 0]
                score = 1 / (1 + np.exp(-np.clip(model.logits(row, term, batch.num_rows)[0], -30, 30)))
                if reject is not None:
                    yield batch.filter(pa.array(score < reject))
                else:
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row; null and empty texts have no terms and get the bias alone."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_score(model, "text", None), "doc_id long, score double")


def accepted(docs: DataFrame, model: Machine, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold; columns as they were.

    Each row is judged by its text alone: null ids, repeated rows and columns of any name stay
    as they are, null and empty texts get the bias alone, a score at the threshold goes, and an
    empty table stays empty.
    """
    ship(docs.sparkSession)
    return docs.mapInArrow(_score(model, text_col, threshold), docs.schema)


def held_out(id_col: str = "doc_id"):
    """True for the fold whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2
