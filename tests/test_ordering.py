import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from voxweave.operators import ordering as O

# One source holds most rows, indices have holes, and spans are tiny so that many are used.
ROWS = [("big", i * 3 % 1009) for i in range(500)] + [("mid", i * 7) for i in range(60)] + [("one", 5)]


@pytest.fixture(scope="module")
def rows(spark):
    data = ROWS[:]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "source string, raw_index long").repartition(5)


def by_source():
    out = {}
    for s, i in sorted(set(ROWS)):
        out.setdefault(s, []).append(i)
    return out


def test_positions(rows):
    got = O.dense_position(rows, ["source"], ["raw_index"], O.span_of("raw_index", 16)).collect()
    want = {(s, i): k for s, ids in by_source().items() for k, i in enumerate(ids)}
    assert {(r.source, r.raw_index): r.position for r in got} == want


@pytest.mark.parametrize("cap", [1, 15, 16, 17, 60, 10_000])
def test_cap(rows, cap):
    got = sorted((r.source, r.raw_index) for r in O.cap_per_source(rows, cap, span=16).collect())
    assert got == sorted((s, i) for s, ids in by_source().items() for i in ids[:cap])


def test_cap_without_broadcast(rows, monkeypatch):
    monkeypatch.setattr(O, "measured", lambda df: df)  # as if there were too many spans
    got = sorted((r.source, r.raw_index) for r in O.cap_per_source(rows, 37, span=16).collect())
    assert got == sorted((s, i) for s, ids in by_source().items() for i in ids[:37])


def test_global_index_follows_the_configured_order(rows):
    order = ["one", "big", "absent", "mid"]
    got = O.assign_global_index(rows, order, span=16).collect()
    want = [(s, i) for s in order for i in by_source().get(s, [])]
    assert [(r.source, r.raw_index) for r in sorted(got, key=lambda r: r.global_index)] == want
    assert sorted(r.global_index for r in got) == list(range(len(want)))


def test_batches_do_not_span_sources(rows):
    got = O.fixed_batches(rows, 32, span=16).collect()
    sizes = {}
    for r in got:
        sizes[(r.source, r.batch)] = sizes.get((r.source, r.batch), 0) + 1
    assert max(sizes.values()) == 32 and sizes[("one", 0)] == 1 and sizes[("mid", 1)] == 28


def folded(lengths, ratio, size):
    """Batch numbers from one pass with a running maximum."""
    out, batch, top, filled = [], -1, None, 0
    for n in lengths:
        if top is None or filled == size or n > ratio * top:
            batch, top, filled = batch + 1, n, 0
        top, filled = max(top, n), filled + 1
        out.append(batch)
    return out


@pytest.mark.parametrize("ratio,size,chunk", [(4.0, 32, 64), (1.5, 4, 8), (2.0, 5, 5), (1.1, 3, 7), (9.0, 1, 4)])
def test_length_ratio_equals_one_pass(spark, ratio, size, chunk):
    rng = random.Random(size)
    lengths = {s: [rng.choice([0, 1, 2, 3, 5, 8, 30, 200]) for _ in range(n)] for s, n in (("a", 200), ("b", 9), ("c", 1))}
    data = [(s, i * 2, n) for s, ns in lengths.items() for i, n in enumerate(ns)]
    df = spark.createDataFrame(data, "source string, raw_index long, length int").repartition(3)
    got = O.length_ratio_batches(df, ratio, size, span=16, chunk=chunk).orderBy("source", "raw_index").collect()
    assert [r.batch for r in got] == [b for s in "abc" for b in folded(lengths[s], ratio, size)]


def test_shuffle_keeps_rows_and_repeats(spark):
    df = spark.range(300)
    first = O.epoch_shuffle(df, "id", 0, 3).orderBy("shuffled_at").collect()
    again = O.epoch_shuffle(df.repartition(7), "id", 0, 3).orderBy("shuffled_at").collect()
    other = O.epoch_shuffle(df, "id", 1, 3).orderBy("shuffled_at").collect()
    assert [r.id for r in first] == [r.id for r in again] != [r.id for r in other]
    assert sorted(r.id for r in other) == list(range(300)) == [r.shuffled_at for r in first]


def test_samples(spark):
    df = spark.range(10).withColumnRenamed("id", "vec_id")
    without = O.sample_vectors(df, 4).collect()
    assert len({r.vec_id for r in without}) == 4 and sorted(r.draw for r in without) == [0, 1, 2, 3]
    again = O.sample_vectors(df, 25).collect()
    assert sorted(r.draw for r in again) == list(range(25)) and {r.vec_id for r in again} <= set(range(10))


def test_take_limit(spark):
    df = spark.range(100).withColumn("k", 99 - F.col("id"))
    assert sorted(r.k for r in O.take_limit(df, 7, ["k"], O.span_of("k", 4)).collect()) == list(range(7))
    assert O.take_limit(df, 1000, ["k"], O.span_of("k", 4)).count() == 100


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_task_over_all_rows(rows):
    for df in (O.cap_per_source(rows, 20, span=16), O.assign_global_index(rows, ["big", "mid"], span=16), O.fixed_batches(rows, span=16)):
        assert "SinglePartition" not in plan(df)


def test_even_spans(spark):
    """Dense, hashed, clustered and missing order values all give short spans in the order of the values."""
    rng = random.Random(3)
    rows = [("dense", i) for i in range(400)] + [("hashed", rng.randrange(-(1 << 62), 1 << 62)) for _ in range(400)]
    rows += [("clustered", rng.choice((0, 10**15)) + rng.randrange(500)) for _ in range(600)] + [(None, i * 7) for i in range(30)]
    rows += [("dense", None)] * 300 + [("hashed", None)] * 5 + [("one", 4)] * 3
    df = spark.createDataFrame([(s, v, i) for i, (s, v) in enumerate(rows)], "source string, raw_index long, i int").repartition(4)
    spans = O.even_spans(df, ["source"], "raw_index", 20).collect()
    sizes = Counter((r.source, r._span) for r in spans if r.raw_index is not None)
    assert max(sizes.values()) <= 80 and len(sizes) < 400
    assert max(Counter(r._span for r in spans if r.source == "dense" and r.raw_index is None).values()) < 60
    got = O.fixed_batches(df, 7, even=20).collect()
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        want = sorted((r.raw_index for r in own if r.raw_index is not None))
        placed = sorted(own, key=lambda r: (r.batch, r.slot))
        assert [r.raw_index for r in placed] == want + [None] * (len(own) - len(want))
        assert [(r.batch, r.slot) for r in placed] == [(k // 7, k % 7) for k in range(len(own))]
    assert O.cap_per_source(df, 15, even=20).groupBy("source").count().where("count > 15").count() == 0
    assert [r.raw_index for r in O.take_limit(df.where("source = 'hashed'"), 9, ["raw_index"], even=50).orderBy("raw_index").collect()] == sorted(v for s, v in rows if s == "hashed" and v is not None)[:9]
    assert O.fixed_batches(df.limit(0), 7, even=20).count() == 0
