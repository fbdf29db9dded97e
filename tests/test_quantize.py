import numpy as np
import pytest
from pyspark.sql import functions as F

from voxweave.functions import vectors as N
from voxweave.operators import preferences as P
from voxweave.operators import quantize as Z
from voxweave.operators import reports as R

RNG = np.random.default_rng(3)
X = RNG.normal(size=(60, 6))
SMALL = 6 * 8 * 2  # bytes of two words: forces the block-wise way


@pytest.fixture(scope="module")
def vecs(spark):
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "vec_id long, vec array<double>").repartition(3)


def book(spark, words):
    return spark.createDataFrame([(i, [float(v) for v in w]) for i, w in enumerate(words)], "code int, vec array<double>")


def nearest(x, words):
    return np.array([((words - v) ** 2).sum(1).argmin() for v in x])


@pytest.mark.parametrize("limit", [1 << 20, SMALL])
def test_nearest(spark, vecs, limit):
    words = X[:9]
    got = Z.nearest_codeword_join(vecs, book(spark, words), limit_bytes=limit).orderBy("vec_id").collect()
    assert [r.nearest.code for r in got] == nearest(X, words).tolist()
    assert np.allclose([r.nearest.dist for r in got], [((words - v) ** 2).sum(1).min() for v in X])


@pytest.mark.parametrize("limit", [1 << 20, 16])
def test_equal_distances_take_the_lowest_code(spark, limit):
    df = spark.createDataFrame([(0, [0.0]), (1, [1e8])], "vec_id long, vec array<double>")
    words = book(spark, [[1.0], [-1.0], [1.0], [-1.0]])
    got = Z.nearest_codeword_join(df, words, limit_bytes=limit).orderBy("vec_id").collect()
    assert [r.nearest.code for r in got] == [0, 0]


def kmeans(x, means, rounds):
    for _ in range(rounds):
        at = nearest(x, means)
        bins = np.bincount(at, minlength=len(means))
        means = np.array([x[at == k].mean(0) if bins[k] else means[k] for k in range(len(means))])
    return means, bins


@pytest.mark.parametrize("limit", [1 << 20, SMALL])
def test_kmeans_keeps_the_mean_of_an_empty_cluster(spark, vecs, limit):
    start = np.vstack([X[:4], np.full((1, 6), 99.0)])
    got = Z.kmeans_fit(vecs, 5, 3, start=book(spark, start), limit_bytes=limit).orderBy("code").collect()
    means, bins = kmeans(X, start, 3)
    assert [r.members for r in got] == bins.tolist() and bins[4] == 0
    assert np.allclose([r.vec for r in got], means)


def test_more_words_than_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [5.0])], "vec_id long, vec array<double>")
    got = Z.kmeans_fit(df, 6, 2).orderBy("code").collect()
    assert len(got) == 6 and sum(r.members for r in got) == 2


def test_ema_and_expiry(spark, vecs):
    words = X[:4]
    state = book(spark, words).withColumns({"size": F.lit(2.0) + F.col("code"), "avg": F.col("vec")})
    got = Z.ema_codebook_update(state, vecs, decay=0.9).orderBy("code").collect()
    at = nearest(X, words)
    size = 0.9 * (2.0 + np.arange(4)) + 0.1 * np.bincount(at, minlength=4)
    avg = 0.9 * words + 0.1 * np.array([X[at == k].sum(0) for k in range(4)])
    smooth = (size + 1e-5) / (size.sum() + 4e-5) * size.sum()
    assert np.allclose([r.size for r in got], size) and np.allclose([r.vec for r in got], avg / smooth[:, None])
    dead = Z.dead_code_expiry(state, vecs, threshold=0.9).orderBy("code").collect()
    assert [r.expired for r in dead] == [2 / 14 * 4 < 0.9, 3 / 14 * 4 < 0.9, False, False]
    assert np.allclose(dead[3].vec, words[3]) and any(np.allclose(dead[0].vec, x) for x in X)
    assert not any(r.expired for r in Z.dead_code_expiry(state, vecs, threshold=0).collect())


def stages(spark):
    rows = [(s, k, (X[10 * s + k] / (s + 1)).tolist()) for s in range(3) for k in range(5)]
    return spark.createDataFrame(rows, "stage int, code int, vec array<double>")


@pytest.mark.parametrize("limit", [1 << 20, SMALL])
def test_residual_codes(spark, vecs, limit):
    books = stages(spark)
    got = Z.rvq_encode(vecs, books, limit_bytes=limit).orderBy("vec_id").collect()
    residual, want = X.copy(), []
    for s in range(3):
        words = X[10 * s : 10 * s + 5] / (s + 1)
        at = nearest(residual, words)
        residual = residual - words[at]
        want.append(at)
    assert [r.codes for r in got] == np.array(want).T.tolist()
    coded = Z.rvq_encode(vecs, books)
    back = Z.rvq_decode(coded, books, key=["vec_id"], semantic=1, limit_bytes=limit).orderBy("vec_id").collect()
    assert np.allclose([r.decoded for r in back], X - residual)


@pytest.mark.parametrize("limit", [1 << 20, SMALL])
def test_grouped_chunks_may_be_uneven(spark, vecs, limit):
    parts = [(g, s, k, X[10 * s + k][lo:hi].tolist()) for g, (lo, hi) in enumerate(((0, 2), (2, 4), (4, 6))) for s in range(2) for k in range(4)]
    books = spark.createDataFrame(parts, "group int, stage int, code int, vec array<double>")
    coded = Z.grouped_rvq_encode(vecs, books, 6, 3, limit_bytes=limit)
    back = Z.grouped_rvq_decode(coded, books, 3, key=["vec_id"], limit_bytes=limit).orderBy("vec_id").collect()
    assert all(len(r.codes) == 3 and len(r.decoded) == 6 for r in back)
    assert ((X - np.array([r.decoded for r in back])) ** 2).sum() <= (X**2).sum()
    widths = [c._jc.toString() for c in Z.split_groups("vec", 7, 3)]
    assert widths == ["slice(vec, 1, 3)", "slice(vec, 4, 3)", "slice(vec, 7, 1)"]


def test_frame_statistics(spark):
    x = X[:12]
    w = np.array([(i % 3 + 1) for i in range(12)], float)
    w /= w.sum()
    df = spark.createDataFrame([("a", i, v.tolist(), float(w[i])) for i, v in enumerate(x)], "k string, t int, vec array<double>, w double")
    r = Z.weighted_mean_std_pool(df, "k", "vec", "w", 6).first()
    mean = (w[:, None] * x).sum(0)
    assert np.allclose(r["mean"], mean)
    assert np.allclose(r["std"], np.sqrt(np.maximum((w[:, None] * (x - mean) ** 2).sum(0), 1e-12)))
    centered = Z.mean_center_frames(df, "k", "vec", 6).orderBy("t").collect()
    assert np.allclose([c.centered for c in centered], x - x.mean(0))


def test_vector_columns(spark):
    df = spark.createDataFrame([([3.0, 4.0], 0.0), ([0.0, 0.0], 2.0)], "v array<double>, u double")
    assert [r[0] for r in df.select(N.l2_normalize("v")).collect()] == [[0.6, 0.8], [0.0, 0.0]]
    assert df.select(N.codebook_from_sums("v", "u", 0.5)).collect()[0][0] == [6.0, 8.0]


def test_logprobs(spark):
    rows = [("a", [1000.0, 0.0], 0), ("a", [0.0, 0.0], 1), ("a", [5.0, 1.0], -100), ("b", [0.0, -1000.0], 1)]
    tokens = spark.createDataFrame(rows, "seq string, logits array<double>, label int")
    sequences = spark.createDataFrame([("a",), ("b",), ("none",)], "seq string")
    got = {r.seq: r.logprob for r in P.sequence_logprobs(sequences, tokens).collect()}
    assert got["a"] == pytest.approx(-np.log(2)) and got["b"] == pytest.approx(-1000.0) and got["none"] == 0.0


def test_preference_loss_is_finite(spark):
    df = spark.createDataFrame([(1e6, 0.0, 0.0, 0.0), (-1e6, 0.0, 0.0, 0.0)], "policy_chosen double, policy_rejected double, ref_chosen double, ref_rejected double")
    assert P.preference_loss(df).first().loss == pytest.approx(0.5e5)
    assert P.preference_loss(df, smoothing=0.5).first().loss == pytest.approx(0.5e5)
    assert P.reward_metrics(df).first().accuracy == 0.5


def test_usage_and_rates(spark):
    df = spark.createDataFrame([(0, 16000), (0, 16000), (1, 16000), (1, 24000)], "batch int, rate int")
    got = {r.batch: (r.n_rates, r.encode_calls) for r in R.distinct_sample_rates(df).collect()}
    assert got == {0: (1, 1), 1: (2, 2)}
