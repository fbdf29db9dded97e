"""Toxicity as ordered severity: cumulative-link regression on sparse text features, one weight vector for all grades.

P(grade > k) = sigmoid(w x - t_k) with t_0 < t_1 < ...: the weights are shared, only the thresholds differ. A text's
features are the distinct hashed words it has, and the distinct word beginnings of 4 to 6 bytes (so that inflected forms
share weight), present or not; length therefore does not dilute a few words in a long text. Features are screened by
how much more often toxic rows of the sample have them, then fitted by proximal gradient steps with an L1 penalty, which
leaves most weights at zero. ``severity`` is the expected grade, the sum of P(grade > k).

Labels say toxic or not. Grades come from the label and the training text: 0 is not toxic; a toxic text has grade 1, 2
or 3 by how many marker words (strongest screened words) it holds: up to 1, up to 3, more.

The model is trained on a bounded sample of labelled rows (``PER_CLASS`` a class). Rows: a null or empty text has
severity 0 and is not toxic; so has everything when one of the classes has no labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .linear import Adam, Rows, sigmoid
from .quality import labelled_ids
from .sampling import class_counts, labelled_sample

PER_CLASS = 4000
BITS = 20
PREFIXES = (4, 5, 6)
GRADE_CUTS = (1, 3)
LEAST_ROWS = 4
LEAST_Z = 5.0
L1 = 2e-3
STEPS = 400
_LETTERS = K.class_table([*range(97, 123), 39, *range(128, 256)])


@dataclass
class Model:
    weight: np.ndarray | None
    thresholds: np.ndarray
    least: float = 0.5


def _occurrences(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Bucket and text of every feature occurrence; the first so many are whole words."""
    data = K.lower_ascii(data)
    start, end, first = K.runs(data, at, _LETTERS)
    text = np.searchsorted(first, np.arange(len(start)), "right") - 1
    shift = np.uint64(64 - BITS)
    buckets, texts = [(K.span_hash(data, start, end) >> shift).astype(np.int32)], [text]
    for size in PREFIXES:
        longer = np.flatnonzero(end - start > size)
        salt = np.uint64(0x9E3779B97F4A7C15 * size & (1 << 64) - 1)
        h = K.mix(K.span_hash(data, start[longer], start[longer] + size) ^ salt)
        buckets.append((h >> shift).astype(np.int32))
        texts.append(text[longer])
    return np.concatenate(buckets), np.concatenate(texts), len(start)


def _present(bucket: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs in text order."""
    both = np.unique(text.astype(np.int64) << BITS | bucket)
    return both >> BITS, (both & (1 << BITS) - 1).astype(np.int64)


def _z(hits: np.ndarray, other: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """How far the share of toxic rows with a feature lies above that of the others, in standard errors."""
    p = (hits + other + 1) / (n1 + n0 + 2)
    return (hits / n1 - other / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))


def fit_ordinal(x: Rows, grade: np.ndarray, share: np.ndarray, steps: int = STEPS, l1: float = L1) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ascending thresholds of the cumulative-link model."""
    k = int(grade.max())
    above = (grade[:, None] > np.arange(k)).astype(float)
    weight, first, gaps = np.zeros(x.width), 1.0, np.zeros(max(0, k - 1))
    own, base = Adam(x.width, 0.05), Adam(k, 0.05)
    thresholds = np.array([1.0])
    for _ in range(steps):
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        residual = (sigmoid(x.dot(weight)[:, None] - thresholds) - above) * share[:, None]
        weight -= own.step(x.back(residual.sum(1)))
        weight = np.sign(weight) * np.maximum(np.abs(weight) - l1, 0)
        slope = -residual.sum(0)
        grad = np.concatenate([[slope.sum()], [np.exp(gaps[j]) * slope[j + 1 :].sum() for j in range(k - 1)]])
        step = base.step(grad)
        first, gaps = first - step[0], np.clip(gaps - step[1:], -3, 3)
    return weight, thresholds


def train(texts: list[str], toxic: list[int], prior: float) -> Model:
    """Fit on labelled texts; ``prior`` is the share of toxic rows among all labelled ones."""
    y = np.array(toxic)
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if not n1 or not n0:
        return Model(None, np.zeros(0))
    rows, buckets, word_rows, word_buckets = [], [], [], []
    for i, text in enumerate(texts):
        data = np.frombuffer(text.encode(), np.uint8)
        bucket, where, n = _occurrences(data, np.array([0, len(data)]))
        u = np.unique(bucket)
        rows.append(np.full(len(u), i))
        buckets.append(u.astype(np.int64))
        if y[i] == 1:
            word_rows.append(np.full(n, i))
            word_buckets.append(bucket[:n].astype(np.int64))
    rows, buckets = np.concatenate(rows), np.concatenate(buckets)
    hits = np.bincount(buckets[y[rows] == 1], minlength=1 << BITS)
    other = np.bincount(buckets[y[rows] == 0], minlength=1 << BITS)
    z = _z(hits, other, n1, n0)
    chosen = np.flatnonzero((hits + other >= LEAST_ROWS) & (np.abs(z) >= LEAST_Z) & ((z > 0) | (hits == 0)))
    if not len(chosen):
        return Model(None, np.zeros(0))
    column = np.full(1 << BITS, -1)
    column[chosen] = np.arange(len(chosen))
    marker = (z >= LEAST_Z) & (hits * n0 >= 9 * other * n1) & (hits >= LEAST_ROWS)
    word_rows, word_buckets = np.concatenate(word_rows), np.concatenate(word_buckets)
    count = np.bincount(word_rows[marker[word_buckets]], minlength=len(y))
    grade = np.where(y == 1, 1 + np.searchsorted(np.array(GRADE_CUTS), count, "left"), 0)
    present = Sparse(column, rows, buckets, len(y))
    share = np.where(y == 1, prior / n1, (1 - prior) / n0)
    held = np.arange(len(y)) % 4 == 3
    weight, thresholds = fit_ordinal(present.take(np.flatnonzero(~held)), grade[~held], share[~held])
    check = sigmoid(present.take(np.flatnonzero(held)).dot(weight) - thresholds[0])
    least = _decide(check, y[held], share[held])
    weight, thresholds = fit_ordinal(present, grade, share)
    full = np.zeros(1 << BITS, np.float32)
    full[chosen] = weight
    return Model(full, thresholds, least)


def _decide(p: np.ndarray, y: np.ndarray, share: np.ndarray) -> float:
    """The probability from which a text counts as toxic: the best F1 on rows not trained on, in the middle of ties."""
    if not (y == 1).any() or not (y == 0).any():
        return 0.5
    cuts = np.linspace(0.15, 0.6, 46)
    hit = np.array([share[(p >= c) & (y == 1)].sum() for c in cuts])
    false = np.array([share[(p >= c) & (y == 0)].sum() for c in cuts])
    f1 = 2 * hit / (hit + false + share[y == 1].sum())
    return float(np.median(cuts[f1 >= f1.max() - 1e-9]))


def Sparse(column: np.ndarray, rows: np.ndarray, buckets: np.ndarray, n: int) -> Rows:
    held = column[buckets] >= 0
    rows, index = rows[held], column[buckets[held]]
    return Rows(index, np.ones(len(index)), np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]), int(column.max()) + 1)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Train on labelled documents; a document with contrary labels counts as toxic."""
    marked = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = class_counts(marked, "toxic")
    if len(counts) < 2:
        return Model(None, np.zeros(0))
    chosen = labelled_ids(marked, counts, per_class)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = labelled_sample(texts, "toxic", class_counts(texts, "toxic"), per_class)
    return train(sample.column("text").to_pylist(), sample.column("toxic").to_pylist(), counts.get(1, 0) / sum(counts.values()))


def severity(model: Model, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """P(grade > k) for every text and k."""
    n = len(at) - 1
    if model.weight is None:
        return np.zeros((n, 1))
    bucket, text, _ = _occurrences(data, at)
    held = model.weight[bucket] != 0
    text, bucket = _present(bucket[held], text[held])
    z = np.bincount(text, model.weight[bucket], n)
    p = sigmoid(z[:, None] - model.thresholds)
    p[np.diff(at) == 0] = 0
    return p


def _grade(model: Model):
    def run(batches):
        for whole in batches:
            for batch in K.slices(whole, "text", 4 << 20):
                p = severity(model, *K.utf8(batch.column(1)))
                columns = [batch.column(0), pa.array(p.sum(1)), pa.array((p >= 0.5).sum(1).astype(np.int32)), pa.array(p[:, 0] >= model.least)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "severity", "grade", "toxic"])

    return run


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, grade, toxic) for every row; whole texts are read."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_grade(model), "doc_id long, severity double, grade int, toxic boolean")
