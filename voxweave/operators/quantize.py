"""Vector quantisation: nearest codeword, k-means, running-average codebooks, residual and grouped codes.

Vectors are rows of the big table; a codebook is a small table (stage, code, vec). Distances are a matrix product
per Arrow batch inside a scalar function, so the big table is neither shuffled nor multiplied. The codebook goes
to the tasks only while it fits ``limit_bytes``; a larger one is walked in blocks, and the best word so far is
carried along, which gives the same answer. Sums over members are plain Spark aggregates with map-side combine,
so one word that attracts a third of all vectors is no hot key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import _col
from ..functions.vectors import matrix, nearest_rows
from ..session import BROADCAST_BYTES, cut_lineage, join_small_or_salted, measured
from .ordering import sample_vectors

NEAREST = "struct<code:int,dist:double>"


def _ordered(rows) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted(rows, key=lambda r: r["code"])
    return np.array([r["code"] for r in rows], np.int32), np.array([r["vec"] for r in rows], np.float64)


class Words:
    """A codebook that has been measured and, block by block, brought to the driver for shipping."""

    def __init__(self, codebook: DataFrame, limit_bytes: int = BROADCAST_BYTES, rows: list | None = None):
        self._table = codebook.select(F.col("code").cast("int").alias("code"), F.col("vec").cast("array<double>").alias("vec"))
        self._rows = rows
        if rows is None:
            size = self._table.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
            self.count, self.dim = size["n"], size["dim"] or 0
        else:
            self.count, self.dim = len(rows), len(rows[0]["vec"]) if rows else 0
        per_block = max(1, limit_bytes // max(1, 8 * self.dim))
        self.blocks = max(1, -(-self.count // per_block))

    @property
    def fits(self) -> bool:
        return self.blocks == 1

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes and vectors of one block, in code order."""
        if self._rows is not None and self.fits:
            return _ordered(self._rows)
        mine = F.pmod(F.xxhash64("code"), F.lit(self.blocks)) == number
        return _ordered((self._table if self.fits else self._table.where(mine)).collect())


def load_books(codebooks: DataFrame, keys: list[str], limit_bytes: int = BROADCAST_BYTES) -> tuple[list[tuple], dict | None]:
    """Keys of a set of codebooks in order, and their words per key when all of them fit the limit together."""
    sizes = codebooks.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(F.size("vec")).alias("_dim")).collect()
    names = sorted(tuple(r[k] for k in keys) for r in sizes)
    if sum(r["_n"] * (r["_dim"] or 0) * 8 for r in sizes) > limit_bytes:
        return names, None
    rows = codebooks.select(*keys, F.col("code").cast("int").alias("code"), F.col("vec").cast("array<double>").alias("vec")).collect()
    grouped: dict = {name: [] for name in names}
    for r in rows:
        grouped[tuple(r[k] for k in keys)].append(r)
    return names, {name: _ordered(found) for name, found in grouped.items()}


def spread(found: pa.Array, lost: pa.Array) -> pa.Array:
    """Results of the rows that are not null, in their places among the nulls."""
    if not lost.true_count:
        return found
    gone = lost.to_numpy(zero_copy_only=False)
    return found.take(pa.array(np.cumsum(~gone) - 1, mask=gone))


def _nearest_column(codes: np.ndarray, words: np.ndarray):
    @F.arrow_udf(NEAREST)
    def nearest(vec: pa.Array) -> pa.Array:
        lost = vec.is_null()
        row, dist = nearest_rows(matrix(vec), words)
        found = pa.StructArray.from_arrays([pa.array(codes[row]), pa.array(dist)], names=["code", "dist"])
        return spread(found, lost)

    return nearest


def nearest_codeword_join(df: DataFrame, codebook: DataFrame | Words, vec: str = "vec", into: str = "nearest",
                          limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Closest codeword (code, squared distance) of every vector; ties go to the lowest code."""
    words = codebook if isinstance(codebook, Words) else Words(codebook, limit_bytes)
    if words.fits:
        return df.withColumn(into, _nearest_column(*words.block(0))(F.col(vec).cast("array<double>")))
    for number in range(words.blocks):
        codes, vectors = words.block(number)
        if not len(codes):
            continue
        found = _nearest_column(codes, vectors)(F.col(vec).cast("array<double>"))
        df = df.withColumn("_found", found)
        order = F.struct(F.col("_found")["dist"].alias("dist"), F.col("_found")["code"].alias("code"))
        # The checkpoint ends the stage, so a task holds one block at a time.
        best = order if "_best" not in df.columns else F.least("_best", order)
        df = cut_lineage(df.withColumn("_best", best).drop("_found"))
    pair = F.struct(F.col("_best")["code"].alias("code"), F.col("_best")["dist"].alias("dist"))
    return df.withColumn(into, F.when(F.col("_best")["code"].isNotNull(), pair)).drop("_best")


def codeword_lookup(codes: DataFrame, codebook: DataFrame, on: list[str], dim: int | None = None, limit_bytes: int = BROADCAST_BYTES,
                    how: str = "inner") -> DataFrame:
    """Centroid of every code: a broadcast join while the codebook fits, else salted, because few codes are hot."""
    words = codebook.select(*on, "vec")
    width = dim or codebook.agg(F.max(F.size("vec"))).first()[0] or 1
    return join_small_or_salted(codes, words, on, how, limit_bytes=limit_bytes, row_bytes=8 * width)


def sum_vectors(df: DataFrame, keys: list[str], vec: str, into: str = "total", value: Column | None = None, also: list[Column] | None = None) -> DataFrame:
    """Element-wise sum of a vector column per group.

    Elements are summed as (keys, position) rows with map-side combine, so a hot group is ``dim`` small rows per
    task; they become arrays again only once they are final. ``value`` may be an expression over ``_x`` and the
    other columns; ``also`` are sums taken alongside (the same for every position).
    """
    value = F.col("_x").cast("double") if value is None else value
    long = df.select("*", F.posexplode(vec).alias("_i", "_x"))
    sums = long.groupBy(*keys, "_i").agg(F.sum(value).alias("_s"), *(also or []))
    kept = [c for c in sums.columns if c not in (*keys, "_i", "_s")]
    ordered = F.array_sort(F.collect_list(F.struct("_i", "_s")))
    return sums.groupBy(*keys).agg(
        F.transform(ordered, lambda p: p["_s"]).alias(into), *[F.max(c).alias(c) for c in kept]
    )


def _member_sums(df: DataFrame, words: Words, vec: str) -> DataFrame:
    """(code, total, members) over the vectors closest to each word; words without members are absent."""
    if not words.fits:
        found = nearest_codeword_join(df.select(F.col(vec).alias("vec")), words)
        found = found.select(F.col("nearest")["code"].alias("code"), "vec")
        return sum_vectors(found, ["code"], "vec", also=[F.count(F.lit(1)).alias("members")])
    codes, vectors = words.block(0)

    def gather(batches):
        """One sum per word and partition, so no vector leaves its task."""
        total, members = np.zeros_like(vectors), np.zeros(len(codes), np.int64)
        for batch in batches:
            x = matrix(batch.column(0))
            if not len(x):
                continue
            row, _ = nearest_rows(x, vectors)
            order = np.argsort(row, kind="stable")
            starts = np.flatnonzero(np.diff(row[order], prepend=-1))
            total[row[order][starts]] += np.add.reduceat(x[order], starts, axis=0)
            members += np.bincount(row, minlength=len(codes))
        used = np.flatnonzero(members)
        offsets = np.arange(len(used) + 1, dtype=np.int32) * vectors.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(total[used].ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(codes[used]), pa.array(members[used]), lists], names=["code", "_members", "vec"]
        )

    vectors_only = df.select(F.col(vec).cast("array<double>").alias("vec"))
    partial = vectors_only.mapInArrow(gather, "code int, _members long, vec array<double>")
    return sum_vectors(partial, ["code"], "vec", also=[F.sum("_members").alias("members")])


def kmeans_fit(df: DataFrame, k: int, rounds: int = K.KMEANS_ROUNDS, vec: str = "vec", row_id: str = "vec_id",
               seed: int = 0, start: DataFrame | None = None, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(code, vec, members) after ``rounds`` rounds from ``k`` sampled start vectors.

    A word without members keeps its vector. ``members`` belongs to the last assignment, which is the one before
    the last update of the vectors.
    """
    if start is None:
        start = sample_vectors(df, k, row_id, seed).select(F.col("draw").cast("int").alias("code"), F.col(vec).alias("vec"))
    means = start.select("code", F.col("vec").cast("array<double>").alias("vec"), F.lit(0).cast("long").alias("members"))
    spark = df.sparkSession

    words = Words(means, limit_bytes)
    for _ in range(rounds):
        sums = _member_sums(df, words, vec)
        moved = F.transform("total", lambda x: x / F.col("_n"))
        means = (
            means.select("code", "vec")
            .join(sums.withColumnRenamed("members", "_n"), "code", "left")
            .select("code", F.coalesce(moved, "vec").alias("vec"), F.coalesce("_n", F.lit(0)).alias("members"))
        )
        if words.fits:
            # A codebook within the limit is brought back as data, which also ends its history.
            rows = means.collect()
            means = spark.createDataFrame(rows, means.schema)
            words = Words(means, limit_bytes, rows)
        else:
            means = cut_lineage(means)
            words = Words(means, limit_bytes)
    return means


def ema_codebook_update(codebook: DataFrame, df: DataFrame, vec: str = "vec", decay: float = K.EMA_DECAY,
                        epsilon: float = K.EMA_EPSILON, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One running-average step over all vectors: new (code, vec, size, avg) with smoothed sizes."""
    words = Words(codebook, limit_bytes)
    sums = _member_sums(df, words, vec)
    keep, fresh = F.lit(decay), F.lit(1.0 - decay)
    old = codebook.select("code", F.col("size").cast("double"), F.col("avg").cast("array<double>"))
    step = old.join(sums, "code", "left").select(
        "code",
        (keep * F.col("size") + fresh * F.coalesce("members", F.lit(0))).alias("size"),
        F.when(F.col("total").isNull(), F.transform("avg", lambda a: keep * a))
        .otherwise(F.zip_with("avg", "total", lambda a, t: keep * a + fresh * t))
        .alias("avg"),
    )
    total = step.agg(F.sum("size")).scalar()
    smoothed = (F.col("size") + epsilon) / (F.col("_total") + words.count * epsilon) * F.col("_total")
    return step.withColumn("_total", total).withColumn("_s", smoothed).select(
        "code", F.transform("avg", lambda a: a / F.col("_s")).alias("vec"), "size", "avg"
    )


def dead_code_expiry(codebook: DataFrame, df: DataFrame, vec: str = "vec", row_id: str = "vec_id", seed: int = 0,
                     threshold: float = K.DEAD_CODE_SHARE) -> DataFrame:
    """Words whose share of all members (times the codebook size) is below ``threshold`` take a sampled vector.

    Sizes and averages stay. The n-th word takes the n-th sampled vector, as in replacing by mask. A threshold of
    0 switches the step off.
    """
    if threshold == 0:
        return codebook.withColumn("expired", F.lit(False))
    count = codebook.count()
    total = codebook.agg(F.sum("size")).scalar()
    samples = sample_vectors(df, count, row_id, seed).select(
        F.col("draw").cast("int").alias("code"), F.col(vec).cast("array<double>").alias("_new")
    )
    marked = codebook.withColumn("expired", F.col("size") / total * count < threshold)
    return (
        marked.join(samples, "code", "left")
        .withColumn("vec", F.when(F.col("expired"), F.col("_new")).otherwise(F.col("vec")))
        .drop("_new")
    )


def commitment_loss(df: DataFrame, codebook: DataFrame, vec: str = "vec", weight: float = 1.0,
                    limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mean squared difference between vectors and their codewords, times ``weight``."""
    words = Words(codebook, limit_bytes)
    found = nearest_codeword_join(df.select(vec), words, vec)
    return found.agg((F.avg(F.col("nearest")["dist"]) / words.dim * weight).alias("loss"))


# ---------------------------------------------------------------- residual and grouped codes


def _encode_column(shipped: list):
    @F.arrow_udf("array<int>")
    def encode(column: pa.Array) -> pa.Array:
        lost = column.is_null()
        residual = matrix(column).copy()
        if not len(residual):
            return pa.nulls(len(column), pa.list_(pa.int32()))
        out = np.empty((len(residual), len(shipped)), np.int32)
        for i, (codes, words) in enumerate(shipped):
            row, _ = nearest_rows(residual, words)
            residual -= words[row]
            out[:, i] = codes[row]
        offsets = np.arange(len(out) + 1, dtype=np.int32) * len(shipped)
        return spread(pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel())), lost)

    return encode


def _decode_column(shipped: list, semantic: int):
    dim = shipped[0][1].shape[1]

    @F.arrow_udf("array<double>")
    def decode(column: pa.Array) -> pa.Array:
        lost = column.is_null()
        rows = column.drop_null()
        ids = rows.flatten().to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.cumsum(pc.list_value_length(rows).to_numpy(zero_copy_only=False))]).astype(np.int64)
        halves = [np.zeros((len(rows), dim)), np.zeros((len(rows), dim))]
        for i, (known, words) in enumerate(shipped):
            own = np.flatnonzero(np.diff(first) > i)
            wanted = ids[first[own] + i]
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            if (known[at] != wanted).any():
                raise ValueError(f"stage {i} has no word {wanted[known[at] != wanted][0]}")
            halves[i >= semantic][own] += words[at]
        out = halves[0] + halves[1]
        offsets = np.arange(len(out) + 1, dtype=np.int32) * dim
        return spread(pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel())), lost)

    return decode


def rvq_encode(df: DataFrame, codebooks: DataFrame, vec: str = "vec", into: str = "codes", limit_bytes: int = BROADCAST_BYTES,
               stages: int | None = None) -> DataFrame:
    """Residual codes: nearest word, subtract it, go on with the next stage. ``codebooks`` is (stage, code, vec)."""
    names, books = load_books(codebooks, ["stage"], limit_bytes)
    if books is not None:
        return df.withColumn(into, _encode_column([books[n] for n in names[:stages]])(F.col(vec).cast("array<double>")))
    width = codebooks.agg(F.max(F.size("vec"))).first()[0]
    out = df.withColumns({"_residual": F.col(vec).cast("array<double>"), into: F.array().cast("array<int>")})
    for (stage,) in names[:stages]:
        book = codebooks.where(F.col("stage") == stage)
        words = book.select(F.col("code").cast("int").alias("_code"), F.col("vec").alias("_word"))
        out = nearest_codeword_join(out, book, "_residual", "_near", limit_bytes).withColumn("_code", F.col("_near")["code"])
        # One word may be the nearest of very many rows: a small book is broadcast by Spark, a large one is salted.
        out = join_small_or_salted(out, words, "_code", "left", limit_bytes=limit_bytes, row_bytes=8 * width).withColumns(
            {
                "_residual": F.zip_with("_residual", "_word", lambda r, w: r - w),
                into: F.when(F.col("_code").isNotNull(), F.concat(into, F.array("_code"))),
            }
        )
        out = cut_lineage(out.drop("_near", "_code", "_word"))
    return out.drop("_residual")


def rvq_decode(df: DataFrame, codebooks: DataFrame, codes: str = "codes", into: str = "decoded", key: list[str] | None = None,
               semantic: int = 0, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Sum of the codewords of all stages.

    With ``semantic`` the first stages and the rest are summed apart and then added, as split quantisers do.
    Codebooks within the limit are gathered inside the tasks; otherwise codes are joined to their words and
    summed per ``key``. Either way null codes give null, a row with fewer codes than stages sums those it has (none:
    zeros), and a code without a word is an error.
    """
    names, books = load_books(codebooks, ["stage"], limit_bytes)
    if books is not None:
        return df.withColumn(into, _decode_column([books[n] for n in names], semantic)(F.col(codes)))
    if not key:
        raise ValueError("codebooks beyond the broadcast limit need the key columns of a frame")
    dim = codebooks.agg(F.max(F.size("vec"))).first()[0]
    long = df.select(*key, F.posexplode(F.slice(codes, 1, len(names))).alias("_at", "code")).withColumn(
        "stage", F.get(F.array(*[F.lit(s) for (s,) in names]), F.col("_at"))
    )
    words = codeword_lookup(long, codebooks, ["stage", "code"], dim, limit_bytes, "left")
    lost = F.raise_error(F.format_string("stage %d has no word %d", F.col("_at"), F.col("code"))).cast("array<double>")
    words = words.withColumn("vec", F.coalesce("vec", lost))
    half = sum_vectors(words.withColumn("_half", F.col("_at") >= semantic), [*key, "_half"], "vec", "_v")
    sums = sum_vectors(half, key, "_v", into)
    zeros = F.array_repeat(F.lit(0.0), dim)
    found = df.join(sums, key, "left")
    return found.withColumn(into, F.when(F.col(codes).isNotNull(), F.coalesce(F.col(into), zeros)))


def split_groups(vec: Column | str, dim: int, groups: int) -> list[Column]:
    """Equal chunks of a vector; the last may be shorter."""
    width = -(-dim // groups)
    starts = range(0, dim, width)
    return [F.slice(_col(vec), s + 1, min(width, dim - s)) for s in starts]


def grouped_rvq_encode(df: DataFrame, codebooks: DataFrame, dim: int, groups: int, vec: str = "vec", into: str = "codes",
                       limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Residual codes of each chunk. ``codebooks`` is (group, stage, code, vec); the result is array<array<int>>."""
    chunks = split_groups(F.col(vec).cast("array<double>"), dim, groups)
    names, books = load_books(codebooks, ["group", "stage"], limit_bytes)
    if books is not None:
        shipped = [[books[n] for n in names if n[0] == g] for g in range(len(chunks))]
        return df.withColumn(into, F.array(*[_encode_column(s)(c) for s, c in zip(shipped, chunks)]))
    for g, chunk in enumerate(chunks):
        book = codebooks.where(F.col("group") == g).drop("group")
        df = rvq_encode(df.withColumn("_chunk", chunk), book, "_chunk", f"_g{g}", limit_bytes).drop("_chunk")
    parts = [f"_g{g}" for g in range(len(chunks))]
    return df.withColumn(into, F.array(*parts)).drop(*parts)


def grouped_rvq_decode(df: DataFrame, codebooks: DataFrame, groups: int, codes: str = "codes", into: str = "decoded",
                       key: list[str] | None = None, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    names, books = load_books(codebooks, ["group", "stage"], limit_bytes)
    if books is not None:
        shipped = [[books[n] for n in names if n[0] == g] for g in range(groups)]
        return df.withColumn(into, F.concat(*[_decode_column(s, 0)(F.get(codes, F.lit(g))) for g, s in enumerate(shipped)]))
    for g in range(groups):
        book = codebooks.where(F.col("group") == g).drop("group")
        df = rvq_decode(df.withColumn("_c", F.get(codes, F.lit(g))), book, "_c", f"_d{g}", key, 0, limit_bytes).drop("_c")
    parts = [f"_d{g}" for g in range(groups)]
    return df.withColumn(into, F.concat(*parts)).drop(*parts)


# ---------------------------------------------------------------- statistics over frames


def _few(means: DataFrame, dim: int) -> DataFrame:
    """Means worked out once and broadcast while they are few; a long clip then stays where its frames are.

    More of them are joined by shuffle, where adaptive execution splits a clip with very many frames.
    """
    return measured(means, max(1, (BROADCAST_BYTES >> 3) // (8 * dim)))


KEYS_HELD = 4096
STATE = "weight double, mean array<double>, m2 array<double>"


def _merge(w: np.ndarray, mean: np.ndarray, m2: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One state (weight, mean, sum of squared deviations) for each run of states that begins at ``first``.

    Deviations are taken from the run's own mean, so nothing is lost where values lie far from zero.
    """
    run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(w))))
    total = np.add.reduceat(w, first)
    centre = np.add.reduceat(w[:, None] * mean, first) / np.where(total == 0, 1, total)[:, None]
    gap = mean - centre[run]
    return total, centre, np.add.reduceat(m2 + w[:, None] * gap * gap, first)


def _states(at_key: int):
    """States of each key in a partition, merged as batches come in, and sent before too many keys are held."""

    def run(batches):
        held, part = {}, TaskContext.get().partitionId()

        def send():
            kind = kinds[0]
            rows = list(held.items())
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], kind), pa.array([part % 64] * len(rows), pa.int32()), pa.array([s[0] for _, s in rows]),
                 pa.array([s[1] for _, s in rows], pa.list_(pa.float64())), pa.array([s[2] for _, s in rows], pa.list_(pa.float64()))],
                names=["key", "_salt", "weight", "mean", "m2"],
            )

        kinds = [None]
        for batch in batches:
            batch = batch.filter(pc.and_(batch.column(1).is_valid(), batch.column(2).is_valid()))
            if not batch.num_rows:
                continue
            kinds[0] = batch.column(0).type
            codes = batch.column(0).dictionary_encode()
            names, code = codes.dictionary.to_pylist(), codes.indices.fill_null(len(codes.dictionary)).to_numpy(zero_copy_only=False)
            names.append(None)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
            by = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.diff(code[by], prepend=-1))
            states = _merge(batch.column(2).to_numpy(zero_copy_only=False)[by], x[by], np.zeros_like(x), first)
            for k, state in zip(code[by][first].tolist(), zip(*states)):
                have = held.get(names[k])
                if have is not None:
                    both = _merge(*(np.stack([np.asarray(a), np.asarray(b)]) for a, b in zip(have, state)), np.array([0]))
                    state = tuple(b[0] for b in both)
                held[names[k]] = state
            if len(held) >= KEYS_HELD:
                yield send()
        if held:
            yield send()

    return run


def _merged(table: pa.Table) -> pa.Table:
    w = table.column("weight").to_numpy()
    mean, m2 = (table.column(c).combine_chunks().flatten().to_numpy().reshape(len(w), -1) for c in ("mean", "m2"))
    total, centre, spread = _merge(w, mean, m2, np.array([0]))
    head = table.slice(0, 1)
    for name, value in (("weight", total), ("mean", list(centre)), ("m2", list(spread))):
        at = head.schema.get_field_index(name)
        head = head.set_column(at, name, pa.array(value, head.schema.field(at).type))
    return head


def moment_states(frames: DataFrame, key: str, vec: str, weight: Column) -> DataFrame:
    """(key, weight, mean, m2) of the vectors of each key, in one pass.

    A task sends one state for each key it saw, whatever the number of frames; states of a key are merged in up to 64
    groups and these once more, so a clip that fills half the table is no different from a small one.
    """
    slim = frames.select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("_v"), weight.cast("double").alias("_w"))
    kind = slim.schema["key"].dataType.simpleString()
    states = slim.mapInArrow(_states(0), f"key {kind}, _salt int, {STATE}")
    states = states.groupBy("key", "_salt").applyInArrow(_merged, f"key {kind}, _salt int, {STATE}")
    states = states.groupBy("key").applyInArrow(_merged, f"key {kind}, _salt int, {STATE}")
    return states.select(F.col("key").alias(key), "weight", "mean", "m2")


def mean_center_frames(frames: DataFrame, key: str, vec: str, dim: int, into: str = "centered") -> DataFrame:
    """Subtract the per-dimension mean over all frames of a clip."""
    means = moment_states(frames, key, vec, F.lit(1.0)).select(key, F.col("mean").alias("_mean"))
    centered = F.zip_with(F.col(vec).cast("array<double>"), "_mean", lambda x, m: x - m)
    return frames.join(_few(means, dim), key).withColumn(into, centered).drop("_mean")


def weighted_mean_std_pool(frames: DataFrame, key: str, vec: str, weight: str, dim: int, epsilon: float = 1e-12) -> DataFrame:
    """Weighted mean and standard deviation per dimension; the weights of a clip sum to 1.

    One pass: the sum of squared deviations is carried beside the mean. Where weights do not sum to 1, the mean is the
    weighted sum and deviations are taken from it.
    """
    states = moment_states(frames, key, vec, F.col(weight))
    pooled = F.transform("mean", lambda m: m * F.col("weight"))
    off = lambda m: m * (1 - F.col("weight"))
    square = F.zip_with("m2", "mean", lambda s, m: s + F.col("weight") * off(m) * off(m))
    return states.select(key, pooled.alias("mean"), F.transform(square, lambda v: F.sqrt(F.greatest(v, F.lit(epsilon)))).alias("std"))
