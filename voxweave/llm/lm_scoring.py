"""Language-model scores of whole texts: a hashed maximum-entropy model beside its unigram base.

The model is described in ``maxent``. Here Spark gathers what it needs and runs it:

* Word counts of all training texts are summed by word (map-side combine). Words stand for themselves by a 64-bit hash.
  Class and slot totals of the model come from these counts.
* Weights are trained in ``ROUNDS`` rounds, each over its own share of the training texts, all of them together. Every
  task starts from the weights of the round, follows the gradients of its texts and returns how far each weight row
  moved; movements are averaged, weighted by how much a task saw of the row, in groups of ``FAN_IN`` tasks, level by level.
* Texts are scored in Arrow batches. Counts of the most frequent words (at most ``HEAVY``, chosen by a histogram of
  counts) ride along; the other words of a document are joined with the count table, whatever their number.

Rows: a null or empty text is its end token alone. A null id is never held out and is learnt from. Repeated rows and ids
are rows of their own, each counted and scored. Without training rows every count is 0. Only id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from . import maxent as M
from .native import settle
from .sizing import text_bytes

ROUNDS = 2
HEAVY = 1 << 17
FAN_IN = 64
TASK_BYTES = 24 << 20
MOST_TASKS = 1 << 14
CHUNK = 2048  # weight rows that travel together
SLICE = 4 << 20
HELD_OUT = 2
FOLDS = 7


@dataclass
class Model:
    counts: DataFrame  # (hash, slot, n), one row a word
    n_tokens: int
    n_words: int
    denominators: np.ndarray
    weights: M.Weights
    heavy: tuple[np.ndarray, np.ndarray]  # hashes in order, and their counts


def held_out(doc_id: Column) -> Column:
    """Whether ``crc32`` of the id as text leaves the remainder that is not learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))


def _tokens(batches, limit: int = SLICE):
    for whole in batches:
        for batch in K.slices(whole, "text", limit):
            yield batch, M.tokens(*K.utf8(batch.column(batch.schema.get_field_index("text"))))


def _count(batches):
    for _, t in _tokens(batches, 2 * SLICE):  # what a slice holds twice is one row
        hashes, at, n = np.unique(t.hash, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(t.slot[at]), pa.array(n)], names=["hash", "slot", "n"]
        )


def word_counts(docs: DataFrame) -> DataFrame:
    """(hash, slot, n) of every token of the texts."""
    found = _texts(docs).mapInArrow(_count, "hash long, slot int, n long")
    return found.groupBy("hash").agg(F.min("slot").alias("slot"), F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = HEAVY) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of all words above a power of two that at most ``most`` words reach."""
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    sizes = sorted(counts.groupBy(power.alias("power")).count().collect(), reverse=True)
    least, total = 64, 0
    for p, n in sizes:
        total += n
        if total > most:
            break
        least = p
    table = counts.where(power >= least).select("hash", "n").toArrow()
    hashes = table.column("hash").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], table.column("n").to_numpy().astype(np.int64)[order]


def _learn(shared, seed: int):
    """One task's movements of the weights, and how much it saw of each row, in chunks of rows."""

    def run(batches):
        part = TaskContext.get().partitionId()
        weights = M.Weights(*shared.value)
        learner, any_text = M.Learner(weights, seed=seed + part), False
        for _, t in _tokens(batches):
            learner.learn(t)
            any_text = True
        if not any_text:
            return
        for k, (old, new, seen) in enumerate(zip((weights.by_class, weights.by_slot), learner.tables, learner.seen)):
            weight = (seen - 1).sum(1)
            moved = (new - old) * weight[:, None]
            for a in range(0, len(old), CHUNK):
                if weight[a : a + CHUNK].any():
                    body = weight[a : a + CHUNK].tobytes() + moved[a : a + CHUNK].tobytes()
                    yield pa.RecordBatch.from_pydict({"tab": pa.array([k], pa.int32()), "chunk": pa.array([a], pa.int32()), "part": pa.array([part], pa.int32()), "body": pa.array([body], pa.binary())})

    return run


def _sum(table: pa.Table) -> pa.Table:
    bodies = [np.frombuffer(b.as_buffer(), np.float32) for b in table.column("body")]
    total = bodies[0].astype(np.float32)
    for b in bodies[1:]:
        total = total + b
    return table.slice(0, 1).set_column(table.schema.get_field_index("body"), "body", pa.array([total.tobytes()], pa.binary()))


def _round(texts: DataFrame, weights: M.Weights, tasks: int, seed: int) -> M.Weights:
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((weights.class_bias, weights.slot_bias, weights.by_class, weights.by_slot))
    schema = "tab int, chunk int, part int, body binary"
    sums, groups = texts.coalesce(tasks).mapInArrow(_learn(shared, seed), schema), tasks
    while groups > 1:
        groups = -(-groups // FAN_IN)
        sums = sums.withColumn("part", F.col("part").cast("int") % groups)
        sums = sums.groupBy("tab", "chunk", "part").applyInArrow(_sum, schema)
    tables = [weights.by_class.copy(), weights.by_slot.copy()]
    for row in sums.collect():  # a fixed number of chunks
        rows = tables[row.tab][row.chunk : row.chunk + CHUNK]
        body = np.frombuffer(row.body, np.float32)
        weight = body[: len(rows)]
        rows += body[len(rows) :].reshape(rows.shape) / np.maximum(weight, 1e-12)[:, None]
    shared.unpersist()
    return M.Weights(weights.class_bias, weights.slot_bias, *tables)


def fit(docs: DataFrame, rounds: int = ROUNDS, task_bytes: int = TASK_BYTES, heavy: int = HEAVY) -> Model:
    """Counts and weights from the rows that are not held out."""
    train = _texts(docs.where(~held_out(F.col("doc_id"))))
    counts, n_words = settle(word_counts(train))
    by_slot = counts.groupBy("slot").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    tokens_of, words_of = np.zeros(M.CLASSES * M.SLOTS), np.zeros(M.CLASSES * M.SLOTS)
    for slot, n, words in by_slot:
        tokens_of[slot], words_of[slot] = n, words
    weights = M.Weights(*M.biases(tokens_of))
    if n_words:
        size = text_bytes(train)
        tasks = int(min(MOST_TASKS, max(1, size // task_bytes)))
        share = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(rounds))
        for r in range(rounds):
            weights = _round(train.where(share == r), weights, tasks, 1000 * r)
    n_tokens = int(sum(n for _, n, _ in by_slot))
    return Model(counts, n_tokens, n_words, M.log_denominators(tokens_of, words_of), weights, frequent(counts, heavy))


def _score(shared):
    """Sums over each text: tokens, known frequent words, their log counts, the model's part; the other words by hash."""

    def run(batches):
        class_bias, slot_bias, by_class, by_slot, denominators, hashes, counts = shared.value
        weights, logs = M.Weights(class_bias, slot_bias, by_class, by_slot), np.append(np.log(counts + 1.0), 0)
        frequent_words = M.Lookup(hashes)
        for batch, t in _tokens(batches):
            texts = batch.num_rows
            value = M.log_probs(weights, t) - denominators[t.slot]
            at = frequent_words.find(t.hash)
            known, seen = at < len(hashes), logs[at]
            value += seen
            head = t.first[:-1]
            rest = np.flatnonzero(~known)
            doc = np.searchsorted(t.first, rest, "right") - 1
            by = np.lexsort((t.hash[rest], doc))
            doc, rare = doc[by], t.hash[rest][by]
            new = np.ones(len(by), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (rare[1:] != rare[:-1])
            start = np.flatnonzero(new)
            bounds = np.searchsorted(doc[start], np.arange(texts + 1)).astype(np.int32)
            offsets = pa.array(bounds)
            many = np.diff(np.append(start, len(by)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(np.diff(t.first)), pa.array(np.add.reduceat(known.astype(np.int64), head)),
                    pa.array(np.add.reduceat(seen, head)), pa.array(np.add.reduceat(value, head)),
                    pa.ListArray.from_arrays(offsets, pa.array(rare[start].view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(many)),
                ],
                names=["_key", "doc_id", "n_tokens", "known", "seen", "value", "rare", "many"],
            )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), scores in log10, one row for each of ``docs``."""
    spark, w = docs.sparkSession, model.weights
    shared = spark.sparkContext.broadcast((w.class_bias, w.slot_bias, w.by_class, w.by_slot, model.denominators, *model.heavy))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"_key long, doc_id {kind}, n_tokens long, known long, seen double, value double, rare array<long>, many array<long>"
    keyed = _texts(docs).select(F.monotonically_increasing_id().alias("_key"), "doc_id", "text")
    sums, _ = settle(keyed.mapInArrow(_score(shared), schema))
    rare = sums.select("_key", F.explode(F.arrays_zip("rare", "many")).alias("w")).select("_key", F.col("w.rare").alias("hash"), F.col("w.many").alias("many"))
    log = F.sum(F.col("many") * F.log(F.col("n") + F.lit(1.0)))
    found = rare.join(model.counts.select("hash", "n"), "hash").groupBy("_key").agg(F.sum("many").alias("more"), log.alias("log"))
    more, seen = F.coalesce("more", F.lit(0)), F.coalesce("log", F.lit(0.0))
    ten = float(np.log(10))
    base = F.col("seen") + seen - F.col("n_tokens") * F.lit(float(np.log(model.n_tokens + model.n_words + 1)))
    return sums.drop("rare", "many").join(found, "_key", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("known") + more).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), (base / ten).alias("base_score"), ((F.col("value") + seen) / ten).alias("score"),
    )
