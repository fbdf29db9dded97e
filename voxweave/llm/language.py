"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

A text becomes lower-case letters with single gaps between words; its byte 2-, 3- and 4-grams, word edges included, are
hashed to rows of an embedding table. The mean row goes through a linear softmax. Both are trained by minibatch
stochastic gradient descent in NumPy on a bounded sample of labelled rows (``PER_LANGUAGE`` a language, whole texts and
short pieces of them); a temperature is fitted on sampled rows that were not trained on, and so is the score below which
a prediction is rejected. Scoring multiplies embeddings and softmax out into one table and sums its entries over whole
texts, a batch at a time.

Rows: a null text, an empty one and one without a letter get ``und``, score 0, and are rejected. Without labelled rows
everything is ``und``. Extra columns of the input stay, unless a result column has their name: that one is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import small_batches
from . import kernels as K
from .sampling import class_counts, labelled_sample

SIZES = (2, 3, 4)
BITS = 15
DIM = 16
PER_LANGUAGE = 700
EPOCHS = 4
MAX_ERROR = 0.02
LEAST_SCORE = 0.3
UNKNOWN = "und"
_GAP = 4


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # languages x buckets: embedding times softmax
    bias: np.ndarray
    temperature: float
    least_score: float


def _stream(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters in lower case with other bytes as blanks, ``_GAP`` blanks before each text; start and end of each text."""
    table = np.full(256, 32, np.uint8)
    letters = [*range(65, 91), *range(97, 123), *range(128, 256)]
    table[letters] = letters
    table[65:91] += 32
    n = len(at) - 1
    out = np.full(len(data) + _GAP * (n + 1), 32, np.uint8)
    shift = np.repeat(_GAP * (1 + np.arange(n)), np.diff(at))
    out[np.arange(len(data)) + shift] = table[data]
    start = at[:-1] + _GAP * (1 + np.arange(n))
    return out, start, start + np.diff(at)


def _buckets(stream: np.ndarray, size: int) -> np.ndarray:
    """Hashed bucket of the n-gram that starts at each byte."""
    n = len(stream) - size + 1
    value = stream[:n].astype(np.uint32)
    for k in range(1, size):
        value |= stream[k : k + n].astype(np.uint32) << np.uint32(8 * k)
    value ^= np.uint32(0x9E37 * size)
    value *= np.uint32(0x85EBCA6B)
    value ^= value >> np.uint32(13)
    value *= np.uint32(0xC2B2AE35)
    return value >> np.uint32(32 - BITS)


def _blank(stream: np.ndarray) -> np.ndarray:
    """n-grams that start with two blanks say nothing; they are left out of the mean."""
    out = stream[:-1] == 32
    out &= stream[1:] == 32
    return out


def _sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[end] - total[start]


def logits(model: Model, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logit of every language for every text, before the temperature."""
    stream, start, end = _stream(data, at)
    start, full = start - 1, len(stream)
    blank = _blank(stream)
    out = np.zeros((len(at) - 1, len(model.languages)))
    count = np.zeros(len(at) - 1)
    for size in SIZES:
        bucket = _buckets(stream, size)
        dead = blank[: len(bucket)]
        stop = np.minimum(end, full - size + 1)
        count += _sums(~dead, start, stop)
        for k in range(len(model.languages)):
            value = model.table[k][bucket]
            value[dead] = 0
            out[:, k] += _sums(value, start, stop)
    return out / np.maximum(count, 1)[:, None] + model.bias


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def has_letter(column: pa.Array, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a text has a letter; only texts without an ASCII one are looked at character by character."""
    ascii_letter = K.class_table([*range(65, 91), *range(97, 123)])
    out = _sums(ascii_letter[data], at[:-1], at[1:]) > 0
    for i in np.flatnonzero(~out & (np.diff(at) > 0)):
        out[i] = any(c.isalpha() for c in column[int(i)].as_py())
    return out


def predict(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray]:
    data, at = K.utf8(column)
    known = has_letter(column, data, at)
    if not model.languages:
        return [UNKNOWN] * len(known), np.zeros(len(known))
    p = _softmax(logits(model, data, at) / model.temperature)
    best = p.argmax(1)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)]
    return names, np.where(known, p[np.arange(len(best)), best], 0.0)


def _examples(texts: list[str], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[bytes], np.ndarray]:
    """Whole texts and, from each, three short pieces that begin at a word."""
    out, y = [], []
    for text, label in zip(texts, labels):
        out.append(text.encode())
        y.append(label)
        words = text.split()
        for _ in range(3 if len(words) > 6 else 0):
            a = int(rng.integers(0, len(words)))
            out.append(" ".join(words[a : a + int(rng.integers(2, 12))]).encode())
            y.append(label)
    return out, np.array(y)


def _rows(examples: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct buckets of each example and their share."""
    buckets, shares = [], []
    for one in examples:
        stream, start, end = _stream(np.frombuffer(one, np.uint8), np.array([0, len(one)]))
        blank, found = _blank(stream), []
        for size in SIZES:
            b = _buckets(stream, size)
            stop = min(int(end[0]), len(b))
            part = b[start[0] - 1 : stop]
            found.append(part[~blank[start[0] - 1 : stop]])
        u, n = np.unique(np.concatenate(found), return_counts=True)
        buckets.append(u.astype(np.int64))
        shares.append(n / max(1, n.sum()))
    return buckets, shares


def _descend(buckets, shares, y: np.ndarray, classes: int, rng: np.random.Generator, dim: int = DIM, epochs: int = EPOCHS):
    embed = rng.normal(0, 0.1, (1 << BITS, dim)).astype(np.float32)
    weight, bias = rng.normal(0, 0.1, (dim, classes)).astype(np.float32), np.zeros(classes, np.float32)
    seen = np.zeros(1 << BITS, np.float32)  # squared steps, for rates by bucket
    size = 32
    for epoch in range(epochs):
        rate = 2.0 / (1 + epoch)
        order = rng.permutation(len(y))
        for a in range(0, len(y), size):
            own = [i for i in order[a : a + size] if len(buckets[i])]
            if not own:
                continue
            index = np.concatenate([buckets[i] for i in own])
            share = np.concatenate([shares[i] for i in own]).astype(np.float32)
            first = np.concatenate([[0], np.cumsum([len(buckets[i]) for i in own])])
            mean = np.add.reduceat(embed[index] * share[:, None], first[:-1], axis=0)
            delta = _softmax(mean @ weight + bias)
            delta[np.arange(len(own)), y[own]] -= 1
            back = (delta @ weight.T).repeat(np.diff(first), axis=0) * share[:, None]
            weight -= rate * (mean.T @ delta) / np.sqrt(len(own))
            bias -= 0.1 * rate * delta.mean(0)
            u, inverse = np.unique(index, return_inverse=True)
            by = np.argsort(inverse, kind="stable")
            grad = np.add.reduceat(back[by], np.concatenate([[0], np.cumsum(np.bincount(inverse))[:-1]]), axis=0)
            seen[u] += (grad * grad).mean(1)
            embed[u] -= rate * grad / np.sqrt(seen[u] + 1e-8)[:, None] * 0.2
    return embed, weight, bias


def train(texts: list[str], labels: list[str], seed: int = 7, max_error: float = MAX_ERROR) -> Model:
    """Fit on the given rows; every fifth row is kept for temperature and rejection."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((0, 1 << BITS), np.float32), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    y = np.array([languages.index(x) for x in labels])
    held = np.arange(len(y)) % 5 == 4
    examples, ey = _examples([t for t, h in zip(texts, held) if not h], y[~held], rng)
    embed, weight, bias = _descend(*_rows(examples), ey, len(languages), rng)
    model = Model(languages, np.ascontiguousarray((embed @ weight).T), bias.astype(float), 1.0, LEAST_SCORE)
    check, cy = _examples([t for t, h in zip(texts, held) if h], y[held], rng)
    if not check:
        return model
    body, at = np.frombuffer(b"".join(check), np.uint8), np.concatenate([[0], np.cumsum([len(c) for c in check])])
    z = logits(model, body, at)

    def loss(t: float) -> float:
        return -np.log(np.maximum(_softmax(z / t)[np.arange(len(cy)), cy], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
    p = _softmax(z / model.temperature)
    score, right = p.max(1), p.argmax(1) == cy
    order = np.argsort(-score)
    wrong = np.cumsum(~right[order]) / (1 + np.arange(len(order)))
    good = np.flatnonzero(wrong <= max_error)
    least = float(score[order][good[-1]]) if len(good) else 1.0
    model.least_score = LEAST_SCORE if len(good) == len(order) else max(LEAST_SCORE, least)
    return model


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Train on rows with a language whose ``crc32(doc_id) mod 4`` is not 2."""
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 2))
    counts = class_counts(rows, "lang")
    if not counts:
        return train([], [])
    sample = labelled_sample(rows, "lang", counts, per_language)
    model = train(sample.column("text").to_pylist(), sample.column("lang").to_pylist())
    K.give_back()
    return model


def fold(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _score(model: Model, at: int):
    def run(batches):
        for whole in batches:
            for batch in K.slices(whole, whole.schema.names[at], 4 << 20):
                column = batch.column(at)
                names, score = predict(model, column)
                reject = (np.array(names, object) == UNKNOWN) | (score < model.least_score)
                more = [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(reject.astype(bool), pa.bool_())]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *more], names=[*batch.schema.names, "lang_pred", "score", "rejected"]
                )
        K.give_back()

    return run


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` added; the whole text is read."""
    small_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score", "rejected")
    schema = T.StructType(list(docs.schema.fields)).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.mapInArrow(_score(model, docs.columns.index(text)), schema)
