"""Quality rules: base counts of every text, and hashed n-gram logistic regression with calibrated probabilities.

The classifier sees hashed single words and word pairs, and hashed byte 2- and 3-grams, each kind as shares of its text.
It is trained in NumPy on a bounded sample of labelled rows (``PER_CLASS`` of each class); Platt scaling on sampled rows
not trained on, weighted to the classes' shares among all labelled rows, gives probabilities. Arrow batches are scored
against the fixed thresholds below; base counts come from the same pass over the words.

Rows: a null or empty text has no words, fails the base rule and is not kept. Without labels of both classes the
classifier has no verdict and the base rule decides alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .linear import Rows, logistic, platt, sigmoid
from .sampling import class_counts, labelled_sample

PER_CLASS = 1200
BITS = 16
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of words
LEAST_QUALITY = 0.5
SYMBOLS = b"[#*$%&|<>]"[1:-1]
_PAIR = 0xC6A4A7935BD1E995
_REPEAT = 0xE7037ED1A0B428DB


@dataclass
class Model:
    weight: np.ndarray | None  # words, then pairs, then byte 2-grams, then byte 3-grams
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0


def _sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[end] - total[start]


def _features(data: np.ndarray, at: np.ndarray, w: K.Words):
    """(bucket, first, end) of each kind of feature: one bucket an occurrence, in text order."""
    shift = np.uint64(64 - BITS)
    yield (w.hash >> shift).astype(np.int64), w.first[:-1], w.first[1:]
    pairs = K.windows(w.hash, 2, _PAIR)
    yield (pairs >> shift).astype(np.int64) + (1 << BITS), w.first[:-1], np.maximum(w.first[:-1], np.minimum(w.first[1:] - 1, len(pairs)))
    for k, size in enumerate((2, 3)):
        n = max(0, len(data) - size + 1)
        value = data[:n].astype(np.uint32)
        for j in range(1, size):
            value |= data[j : j + n].astype(np.uint32) << np.uint32(8 * j)
        value *= np.uint32(0x9E3779B1)
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x85EBCA77)
        bucket = (value >> np.uint32(32 - BITS)).astype(np.int64) + ((2 + k) << BITS)
        yield bucket, np.minimum(at[:-1], n), np.maximum(np.minimum(at[:-1], n), np.minimum(at[1:] - size + 1, n))


def score(model: Model, data: np.ndarray, at: np.ndarray, w: K.Words) -> np.ndarray:
    """Calibrated probability that a text is of good quality."""
    total = np.zeros(len(at) - 1)
    weight = model.weight.astype(np.float32)
    for bucket, first, end in _features(data, at, w):
        total += _sums(weight[bucket], first, end) / np.maximum(end - first, 1)
    return sigmoid(model.slope * (total + model.bias) + model.offset)


def _lines(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line (split at each line feed), and the text that it is of."""
    feed = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([at[:-1], feed + 1]), kind="stable")
    end = np.sort(np.concatenate([at[1:], feed]), kind="stable")
    text = np.sort(np.concatenate([np.arange(len(at) - 1), np.searchsorted(at, feed, "right") - 1]), kind="stable")
    return start, end, text


def base_counts(data: np.ndarray, at: np.ndarray, w: K.Words) -> dict[str, np.ndarray]:
    n = len(at) - 1
    n_words = np.diff(w.first)
    heads = ((data & 0xC0) != 0x80).astype(np.int8)  # bytes that begin a code point
    space = K.class_table(K.SEPARATORS)
    word_chars = _sums(heads * ~space[data], at[:-1], at[1:])
    n_symbols = _sums(K.class_table(SYMBOLS)[data].astype(np.int8), at[:-1], at[1:])
    start, end, text = _lines(data, at)
    held = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, text = start[held], end[held], text[held]
    line = K.span_hash(data, start, end)
    by = np.lexsort((line, text))
    again = (line[by][1:] == line[by][:-1]) & (text[by][1:] == text[by][:-1])
    n_dup_lines = np.bincount(text[by][1:][again], minlength=n)
    at_word = K.window_starts(w.first, WINDOW)
    hashes = K.windows(w.hash, WINDOW, _REPEAT)[at_word]
    doc = np.searchsorted(w.first, at_word, "right") - 1
    mixed = K.mix(hashes ^ K.mix(doc.astype(np.uint64) + np.uint64(1)))  # equal only in the same text
    by = np.argsort(mixed, kind="stable")
    same = mixed[by][1:] == mixed[by][:-1]
    twice = np.zeros(len(by), bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    cover = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(cover, at_word[twice], 1)
    np.add.at(cover, at_word[twice] + WINDOW, -1)
    n_repeat = _sums((np.cumsum(cover[:-1]) > 0).astype(np.int64), w.first[:-1], w.first[1:])
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat}


def train(texts: list[str], labels: list[int], prior: float) -> Model:
    """Fit on the given rows; every fourth is kept for calibration. ``prior``: share of class 1 among all labelled rows."""
    y = np.array(labels)
    if len(set(labels)) < 2:
        return Model(None)
    index, value, lengths = [], [], []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        at = np.array([0, len(data)])
        own = 0
        for bucket, first, end in _features(data, at, K.words(data, at)):
            u, n = np.unique(bucket[first[0] : end[0]], return_counts=True)
            index.append(u)
            value.append(n / max(1, n.sum()))
            own += len(u)
        lengths.append(own)
    rows = Rows(np.concatenate(index).astype(np.int32), np.concatenate(value), np.concatenate([[0], np.cumsum(lengths)]), 4 << BITS)
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(y), bool)
    fitted = rows.take(np.flatnonzero(~held))
    weight, bias = logistic(fitted, y[~held])
    check, cy = (rows.take(np.flatnonzero(held)), y[held]) if held.any() else (fitted, y[~held])
    share = np.where(cy == 1, prior / max(1, (cy == 1).sum()), (1 - prior) / max(1, (cy == 0).sum()))
    slope, offset = platt(check.dot(weight) + bias, cy, share)
    return Model(weight.astype(np.float32), bias, slope, offset)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Train on labelled documents; a document with contrary labels counts as low quality."""
    quality = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = class_counts(quality, "quality")
    if len(counts) < 2:
        return Model(None)
    # the ids are cut to about the sample's size before any text moves
    chosen = labelled_ids(quality, counts, per_class)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = labelled_sample(texts, "quality", class_counts(texts, "quality"), per_class)
    y = sample.column("quality").to_pylist()
    return train(sample.column("text").to_pylist(), y, counts.get(1, 0) / sum(counts.values()))


def labelled_ids(rows: DataFrame, counts: dict, per_class: int) -> DataFrame:
    """Ids and labels of at most about ``4 * per_class`` rows a class, by a hash: small enough to broadcast."""
    label = rows.columns[1]
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, 4.0 * per_class / n))).otherwise(share)
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 31)) < share * F.lit(float(1 << 31)))


def _rate(model: Model):
    def run(batches):
        for whole in batches:
            for batch in K.slices(whole, "text", 4 << 20):
                data, at = K.utf8(batch.column(1))
                w = K.words(data, at)
                c = base_counts(data, at, w)
                failed = (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])
                p = score(model, data, at, w) if model.weight is not None else np.full(len(failed), np.nan)
                kept = ~failed & ~(p < LEAST_QUALITY)
                columns = [batch.column(0), *(pa.array(v.astype(np.int64)) for v in c.values())]
                columns += [pa.array(failed), pa.array(kept), pa.array(p, from_pandas=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *c, "base_failed", "kept", "quality"])

    return run


def rate(docs: DataFrame, model: Model) -> DataFrame:
    """Counts, verdicts and the probability of good quality for every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return docs.mapInArrow(_rate(model), f"doc_id long, {counts}, base_failed boolean, kept boolean, quality double")
