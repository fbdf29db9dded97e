"""Importance resampling towards a target distribution: bucket gains, Gumbel keys, distributed quickselect.

Features are runs of 1 to ``most`` consecutive words (A-Z lower-cased; ASCII letters and digits and everything beyond
ASCII), joined by one space; ``crc32`` of their bytes modulo ``buckets`` is their bucket. Bucket counts of the documents
and of the target texts are summed from one array a batch. A bucket's gain is the floored thousandth log ratio of the two
smoothed shares, a document's weight the floored mean gain of its features, read from the array of gains in Arrow
batches. Its score adds Gumbel noise made from a hash of seed and id, so the highest scores are a draw without
replacement by weight.

The draw never sorts all documents. Keys are (score from the top, id, number of features, weight). A round takes
``PIVOTS`` keys at random from the interval still open, counts exactly how many keys lie below and at each, and keeps the
one gap in which the k-th key lies, until the k-th key is a pivot. Rows up to that key are the winners; only they are
sorted, by ranges, and ranked from the counts of the ranges.

Rows: null and empty texts have no feature, weight 0, and are never drawn while ``least_words`` is above 0. A null id
takes part as the seed alone and comes after other ids of its score. Repeated rows are rows of their own; where only some
rows of one key fit, that many of them are drawn, and they are alike in all result columns. An empty table gives no
rows; without target texts gains still follow the formula.
"""

from __future__ import annotations

import math
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .native import settle

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
PIVOTS = 64
SLICE = 4 << 20
RANGE_ROWS = 1 << 20
_word = K.class_table([*range(48, 58), *range(97, 123), *range(128, 256)])


def feature_buckets(data: np.ndarray, at: np.ndarray, buckets: int, most: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every feature, and the number of words of every text; each distinct feature is hashed once."""
    low = K.lower_ascii(data)
    start, end, first = K.runs(low, at, _word)
    hashes, body = K.span_hash(low, start, end), low.tobytes()
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    out, of = [], []
    for size in range(1, most + 1):
        if size > len(hashes):
            break
        run = hashes if size == 1 else K.windows(hashes, size, 0x9E3779B97F4A7C15)
        head = K.window_starts(first, size)
        _, place, back = np.unique(run[head], return_index=True, return_inverse=True)
        distinct = [b" ".join(body[start[i] : end[i]] for i in range(h, h + size)) for h in head[place].tolist()]
        crc = np.fromiter((zlib.crc32(x) % buckets for x in distinct), np.int64, len(distinct))
        out.append(crc[back])
        of.append(text[head])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out]), np.concatenate([empty, *of]), np.diff(first)


def _count(buckets: int, most: int):
    def run(batches):
        for whole in batches:
            total = np.zeros(buckets, np.int64)
            for batch in K.slices(whole, "text", SLICE):
                total += np.bincount(feature_buckets(*K.utf8(batch.column(0)), buckets, most)[0], minlength=buckets)
            held = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, most: int = 1) -> np.ndarray:
    """Features of all texts in each bucket; what comes to the driver is one number a bucket."""
    found = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_count(buckets, most), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandth log ratio of smoothed bucket shares."""
    n, big_s, big_t = len(source), float(source.sum()), float(target.sum())
    ratio = [((t + 1) * (big_s + n)) / ((s + 1) * (big_t + n)) for s, t in zip(source.astype(float), target.astype(float))]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _weigh(gain: np.ndarray, at: int, most: int):
    def run(batches):
        for whole in batches:
            for batch in K.slices(whole, whole.schema.names[at], SLICE):
                bucket, text, words = feature_buckets(*K.utf8(batch.column(at)), len(gain), most)
                n = np.bincount(text, minlength=batch.num_rows)
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, text, gain[bucket])
                weight = total // np.maximum(n, 1)
                more = [pa.array(words), pa.array(n), pa.array(weight)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "n_words", "n_features", "weight"])

    return run


def weigh(docs: DataFrame, gain: np.ndarray, most: int = 1, seed: int = SEED) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features``, ``weight`` and ``score``; columns of these names are replaced."""
    docs = docs.drop("n_words", "n_features", "weight", "score").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType(list(docs.schema.fields))
    for name in ("n_words", "n_features", "weight"):
        schema = schema.add(name, "long")
    noise = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(noise, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return docs.mapInArrow(_weigh(gain, docs.columns.index("text"), most), schema).withColumn("score", F.col("weight") + gumbel)


def _key() -> Column:
    """Ascending order of this struct is the order of the draw."""
    return F.struct((-F.col("score")).alias("a"), F.col("doc_id").isNull().alias("b"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("c"), F.col("n_features").alias("d"), F.col("weight").alias("e"))


def _literal(key: tuple) -> str:
    """SQL of a key; one expression is far quicker to build than a column for each of its parts."""
    return "struct({} AS a, {} AS b, {} AS c, {} AS d, {} AS e)".format(*[str(v).lower() if isinstance(v, bool) else f"bigint('{v}')" for v in key])


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS, seed: int = SEED) -> tuple:
    """The k-th smallest key (from 1) of ``rows``, found by counting; ``rows`` should be a written table."""
    rows, least, most, turn = rows.withColumn("_at", _key()), None, None, 0
    while True:
        open_rows = rows
        if least is not None:  # the bound on the score alone reaches the scan
            open_rows = open_rows.where((F.col("score") <= -least[0]) & (F.col("_at") > F.expr(_literal(least))))
        if most is not None:
            open_rows = open_rows.where((F.col("score") >= -most[0]) & (F.col("_at") < F.expr(_literal(most))))
        chosen = open_rows.select("_at").orderBy(F.xxhash64("_at", F.lit(seed + turn))).limit(pivots).collect()
        keys = sorted({tuple(r[0]) for r in chosen})
        if not keys:
            raise ValueError("fewer rows than k")
        among = F.expr("array(" + ", ".join(map(_literal, keys)) + ")")
        place = F.size(F.filter(among, lambda p: p < F.col("_at"))).alias("above"), F.array_contains(among, F.col("_at")).alias("at")
        found = {(above, at): n for above, at, n in open_rows.groupBy(*place).count().collect()}
        gone = 0
        for i, p in enumerate(keys):  # keys in the gap before a pivot, then those at it
            below = gone + found.get((i, False), 0)
            if k <= below:
                most = p
                break
            if k <= below + found[i, True]:
                return p
            least, gone = p, below + found[i, True]
        k, turn = k - gone, turn + 1


def _ranked(winners: DataFrame, n: int) -> DataFrame:
    """``winners`` with ``rank`` in the order of keys: sorted in ranges, ranges counted."""
    parts = max(1, -(-n // RANGE_ROWS))
    order = [_key(), F.col("_row")]
    kept = winners.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kept, _ = settle(kept.withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id()))
    counts = sorted(kept.groupBy("_part").count().collect())  # one row a range
    before = np.concatenate([[0], np.cumsum([c for _, c in counts])]).tolist()
    offsets = winners.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)] or [(0, 0)], "_part int, _before long")
    inside = F.col("_in") - F.shiftleft(F.col("_part").cast("long"), 33)
    return kept.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_before") + inside + 1).drop("_part", "_before", "_in")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, pivots: int = PIVOTS) -> DataFrame:
    """``scored`` with ``rank`` for the drawn rows; it needs the columns of ``weigh`` and is written once."""
    rows, _ = settle(scored.withColumn("_row", F.monotonically_increasing_id()))
    fits = F.col("n_words") >= least_words
    n = rows.where(fits).count()
    k = percent * n // 100
    unranked = F.lit(None).cast("long")
    if k == 0:
        return rows.withColumn("rank", unranked).drop("_row")
    last = F.expr(_literal(kth_key(rows.where(fits), k, pivots)))
    winners = _ranked(rows.where(fits & (_key() <= last)), k)
    winners = winners.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    rest = rows.where(~(fits & (_key() <= last))).withColumn("rank", unranked)
    return reduce(DataFrame.unionByName, [winners, rest]).drop("_row")


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, most: int = 1, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``, drawn towards the texts of ``target``.

    All columns of ``docs`` are written once with the scores; leave out what the caller does not need.
    """
    gain = gains(bucket_counts(docs, buckets, most), bucket_counts(target, buckets, most))
    return draw(weigh(docs.drop("rank", "_row"), gain, most, seed), percent, least_words)
