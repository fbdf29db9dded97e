"""Joins that a few keys dominate, and moment states of hot clips."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxweave import session as S
from voxweave.operators import cleaning as C
from voxweave.operators import quantize as Z
from voxweave.sources import readers as D


def sides(spark):
    keys = ["hot"] * 300 + ["warm"] * 90 + [f"k{i}" for i in range(60)] + [None] * 80 + ["absent"] * 5
    left = spark.createDataFrame([(k, i % 3, i) for i, k in enumerate(keys)], "k string, m int, i int").repartition(5)
    right = spark.createDataFrame([(k, m, f"{k}{m}", bytearray(b"x" * 9)) for k in {*keys} - {None, "absent"} for m in range(3)], "k string, m int, v string, b binary")
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_heavy_join_equals_a_plain_one(spark, how, limit):
    left, right = sides(spark)
    want = Counter(tuple(r) for r in left.join(right, ["k", "m"], how).select("i", "k", "v").collect())
    got = S.join_heavy(left, right, ["k", "m"], how, F.length("b"), limit_bytes=limit, share=10)
    assert Counter(tuple(r) for r in got.select("i", "k", "v").collect()) == want
    one = right.where("m = 0").drop("m")
    want = Counter(tuple(r) for r in left.join(one, "k", how).select("i", "k", "v").collect())
    for joined in (S.join_heavy(left, one, "k", how, limit_bytes=limit, share=10), S.join_small_or_salted(left, one, "k", how, limit_bytes=limit)):
        assert Counter(tuple(r) for r in joined.select("i", "k", "v").collect()) == want


def test_heavy_keys_leave_the_shuffle(spark):
    left, right = sides(spark)
    assert S.heavy_keys(left, ["k"], 10) in ([("hot",), ("warm",)], [("warm",), ("hot",)])
    assert S.heavy_keys(left.limit(0), ["k"], 10) == []
    plan = S.join_heavy(left, right.where("m = 0").drop("m"), "k", share=10)._jdf.queryExecution().optimizedPlan().toString()
    light = [x for x in plan.split("\n") if "Filter" in x and "NOT k" in x]
    assert light and all("hot" in x and "warm" in x for x in light)


def test_audio_of_one_path_serves_most_rows(spark):
    left, _ = sides(spark)
    files = spark.createDataFrame([("hot", bytearray(b"h"), 1), ("k1", bytearray(b"1"), 1)], "path string, content binary, length long")
    rows = left.select("i", F.col("k").alias("path_"))
    for limit in (1 << 20, 0):
        got = D.join_audio_bytes(rows, files, "path_", limit_bytes=limit)
        assert got.columns == ["path_", "i", "bytes"] and got.count() == rows.count()
        assert {r.path_: r.bytes and bytes(r.bytes) for r in got.collect() if r.path_ in ("hot", "k1", "k2", None)} == {"hot": b"h", "k1": b"1", "k2": None, None: None}
    struct = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in (("bytes", "binary"), ("path", "string"), ("filename", "string"), ("samples", "array<double>"), ("rate", "int"))])
    audio = left.select(F.col("i").alias("raw_index"), F.col("k").alias("audio_path"), struct.alias("audio"))
    got = C.audio_value_unify(audio, "org/set", files=files).collect()
    assert Counter(bytes(r.audio_value.bytes or b"") for r in got) == {b"h": 300, b"1": 1, b"": 234}


@pytest.mark.parametrize("held", [1, 4096])
def test_moment_states(spark, monkeypatch, held):
    """A clip in most rows, far from zero, next to small ones, a null key and null vectors."""
    monkeypatch.setattr(Z, "KEYS_HELD", held)
    rng = np.random.default_rng(1)
    keys = ["hot"] * 400 + ["a", "b", "b", None, None] * 3
    data = [(k, (1e6 + rng.normal(size=4)).tolist(), float(rng.random())) for k in keys]
    frames = spark.createDataFrame(data + [("a", None, 1.0), ("gone", None, 1.0)], "k string, v array<double>, w double").repartition(6)
    got = {r.k: r for r in Z.moment_states(frames, "k", "v", F.col("w")).collect()}
    assert set(got) == set(keys)
    for k in got:
        x, w = np.array([v for q, v, _ in data if q == k]), np.array([u for q, _, u in data if q == k])
        mean = (w[:, None] * x).sum(0) / w.sum()
        assert np.allclose(got[k].weight, w.sum()) and np.allclose(got[k].mean, mean, rtol=1e-12)
        assert np.allclose(got[k].m2, (w[:, None] * (x - mean) ** 2).sum(0), rtol=1e-6)
    plan = Z.moment_states(frames, "k", "v", F.col("w"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    assert Z.moment_states(frames.limit(0), "k", "v", F.col("w")).count() == 0
