"""Source divergence, importance resampling and language-model scores, next to plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import SCHEMA, corpus, frame, row
from voxweave.llm import divergence, lm_scoring, maxent, resampling
from voxweave.llm import kernels as K


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sourced(seed=3, n=150):
    """Rows of two languages and five sources, one of them with a third of the rows, with many identical texts."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        lang, source = rng.choice(["aa", "bb", None]), rng.choice(["s0", "s0", "s1", "é2", None, "empty"])
        words = [f"{rng.choice('xyzé')}{rng.choice('AbÇ')}" for _ in range(rng.randrange(0, 30))]
        text = None if source == "empty" else " ".join(words) if i % 3 else "same Same, sAme xA"
        rows.append((i, text, lang, source, 0, 7, "x", "y", "z", "w", "v"))
    return rows + rows[:4]


def audit_by_hand(rows, least, top):
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(r[1]))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = [t for t in df if df[t] >= least]
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if df[t] >= least) for s in {d[1] for d in own}}
        whole, v = sum(counts.values(), Counter()), len(kept)
        share = {s: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * v) for t in kept} for s, c in [*counts.items(), (None, whole)]}
        for s in counts:
            pairs = sorted((-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode(), o) for o in counts if o != s)
            terms = sorted((share[None][t] - share[s][t], t.encode(), t) for t in kept if counts[s][t] and share[s][t] > share[None][t])
            out += [(lang, s, "pair", o, -f, k + 1) for k, (f, _, o) in enumerate(pairs)]
            out += [(lang, s, "term", t, -f, k + 1) for k, (f, _, t) in enumerate(terms[:top])]
    return sorted(out)


@pytest.mark.parametrize("block_entries", [4, 200_000])
def test_audit(spark, block_entries, monkeypatch):
    monkeypatch.setattr(divergence, "STRIPE", 2 if block_entries == 4 else 512)
    rows = sourced()
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, rows), 5, 4, block_entries).collect())
    assert got == audit_by_hand(rows, 5, 4) and len(got) > 40


def test_audit_odd_tables(spark):
    rows = corpus()
    assert sorted(tuple(r) for r in divergence.audit(frame(spark, rows), 3).collect()) == audit_by_hand(rows, 3, 50)
    assert divergence.audit(frame(spark, [])).collect() == []
    alone = frame(spark, [row(1, None), (2, "a b", "en", "t", 0, 7, "x", "y", "z", "w", "v")])
    assert {(r.source, r.part, r.item, r.value, r["rank"]) for r in divergence.audit(alone).collect()} == {("s", "pair", "t", 0, 1), ("t", "pair", "s", 0, 1)}


def test_distances_to_points():
    values, points = np.array([1, 4, 4, 9]), np.array([0, 4, 20])
    assert divergence._to_points(values, points).tolist() == [18, 8, 62]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def runs(text, most):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def resampled_by_hand(rows, targets, buckets, most, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in runs(x, most)) for texts in ([r[1] for r in rows], targets))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for r in rows:
        f = runs(r[1], most)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(words(r[1])), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fits = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for k, r in enumerate(fits[: percent * len(fits) // 100]):
        r[5] = k + 1
    return out


@pytest.mark.parametrize("most,percent,pivots", [(1, 30, 2), (3, 50, 64), (1, 100, 5), (1, 1, 3)])
def test_resampling(spark, most, percent, pivots, monkeypatch):
    monkeypatch.setattr(resampling, "RANGE_ROWS", 7)
    rows = corpus() + [corpus()[0]] * 9  # many rows of one key
    targets = ["w1 w2 w3 w1", None, "", rows[3][1]]
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    docs = frame(spark, rows)
    gain = resampling.gains(resampling.bucket_counts(docs, 97, most), resampling.bucket_counts(target, 97, most))
    got = resampling.draw(resampling.weigh(docs, gain, most), percent, 20, pivots)
    got = [(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted((tuple(r) for r in resampled_by_hand(rows, targets, 97, most, percent, 20)), key=key)


def test_resampling_odd_tables(spark):
    target = spark.createDataFrame([], "text string")
    assert resampling.resample(frame(spark, []), target).collect() == []
    got = resampling.resample(frame(spark, [row(1, None), row(2, "a"), row(None, "")]), target).collect()
    assert [(r.n_features, r["rank"]) for r in sorted(got, key=lambda r: r.doc_id or 9)] == [(0, None), (1, None), (0, None)]
    with pytest.raises(ValueError, match="fewer rows"):
        resampling.kth_key(resampling.weigh(frame(spark, []), np.zeros(5, np.int64)), 1)


def language_rows(n=300, seed=2):
    """Words of two vocabularies that never share a text, so that context tells."""
    rng = random.Random(seed)
    vocabulary = {"x": [f"{a}{b}ing" for a in "bcdfg" for b in "aeiou"], "y": [f"{a}{b}eur" for a in "klmnp" for b in "aeiou"]}
    return [row(i, " ".join(rng.choice(vocabulary[kind]) for _ in range(rng.randrange(20, 60)))) for i, kind in enumerate(rng.choice("xy") for _ in range(n))]


def base_by_hand(rows):
    tokens = [[w for w in re.split(r"[\x20\x09-\x0D]+", low(r[1])) if w] + [None] for r in rows]
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    c = Counter(t for own, h in zip(tokens, held) if not h for t in own)
    n, v = sum(c.values()), len(c)
    return [(r[0], h, len(own), sum(c[t] > 0 for t in own), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own)) for r, own, h in zip(rows, tokens, held)]


@pytest.mark.parametrize("heavy", [0, 3, 1 << 17])
def test_base_scores(spark, heavy):
    rows = corpus() + language_rows(40)
    model = lm_scoring.fit(frame(spark, rows), rounds=1, heavy=heavy)
    assert len(model.heavy[0]) <= heavy
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm_scoring.score(frame(spark, rows), model).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=key), sorted(base_by_hand(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-12)
    assert all(r[6] < 0 for r in got)


def test_model_beats_base_on_held_out_texts(spark):
    docs = frame(spark, language_rows(3000), 3)
    got = lm_scoring.score(docs, lm_scoring.fit(docs, task_bytes=200_000)).where("held_out").collect()
    assert len(got) > 300 and np.mean([r.score > r.base_score for r in got]) > 0.95


def test_same_words_without_held_out_texts(spark):
    """Held-out texts change nothing that is learnt."""
    rows = language_rows(80)
    other = [r if zlib.crc32(str(r[0]).encode()) % 7 != 2 else row(r[0], "zzz " * 50) for r in rows]
    a, b = (lm_scoring.fit(spark.createDataFrame(x, SCHEMA).coalesce(1)) for x in (rows, other))
    assert a.n_tokens == b.n_tokens and a.n_words == b.n_words
    assert all((x == y).all() for x, y in zip((a.weights.by_class, a.weights.by_slot), (b.weights.by_class, b.weights.by_slot)))


def test_probabilities_sum_to_one(spark):
    rows = [r for r in language_rows(120)]
    docs = frame(spark, rows, 2)
    model = lm_scoring.fit(docs)
    counts = {r["hash"]: (r.slot, r.n) for r in model.counts.collect()}
    unknown = {s: 1 for s in range((maxent.CLASSES - 1) * maxent.SLOTS)}
    for context in ("baing bcing", "koeur", ""):
        stem = maxent.tokens(*K.utf8(pa.array([context])))
        total = 0.0
        for slot, n in [*counts.values(), *[(s, 0) for s in unknown]]:
            t = maxent.Tokens(stem.hash, np.append(stem.slot[:-1], np.int32(slot)), stem.first)
            share = 0.0 if slot == maxent.END_SLOT else math.log(n + 1) - model.denominators[slot]
            total += math.exp(maxent.log_probs(model.weights, t)[-1] + share)
        assert total == pytest.approx(1, abs=1e-4)


def test_scores_of_odd_tables(spark):
    empty = lm_scoring.fit(frame(spark, []))
    assert empty.n_tokens == 0 and lm_scoring.score(frame(spark, []), empty).collect() == []
    got = lm_scoring.score(frame(spark, [row(1, None), row(None, "a B a")]), empty).collect()
    assert sorted((r.n_tokens, r.n_known, r.base_score) for r in got) == [(1, 0, 0.0), (4, 0, 0.0)]
    held = lm_scoring.fit(frame(spark, [row(i, "a") for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2]))
    assert held.n_tokens == 0


def test_gradient_follows_what_is_seen(spark):
    """A learner that sees one continuation only comes to expect it."""
    t = maxent.tokens(*K.utf8(pa.array(["left right " * 40] * 60)))
    weights = maxent.Weights(*maxent.biases(np.bincount(t.slot, minlength=maxent.CLASSES * maxent.SLOTS)))
    before = maxent.log_probs(weights, t).mean()
    learner = maxent.Learner(weights)
    for _ in range(20):
        learner.learn(t)
    assert maxent.log_probs(maxent.Weights(weights.class_bias, weights.slot_bias, *learner.tables), t).mean() > before + 0.3
    assert not weights.by_class.any()  # the shared weights stay as they were


def test_frequent_words_are_bounded_by_power(spark):
    counts = spark.createDataFrame([(i, 0, n) for i, n in enumerate([1, 1, 2, 3, 4, 9, 100])], "hash long, slot int, n long")
    assert lm_scoring.frequent(counts, 2)[1].tolist() == [9, 100]
    assert lm_scoring.frequent(counts, 3)[1].tolist() == [4, 9, 100]
    assert lm_scoring.frequent(counts.where("n < 0"), 3)[1].tolist() == []


def test_results_do_not_depend_on_partitions(spark):
    rows = sourced(5, 60)
    docs = [frame(spark, rows, k) for k in (1, 5)]
    a, b = ([sorted(tuple(r) for r in divergence.audit(d, 4).collect()) for d in docs])
    assert a == b
    target = spark.createDataFrame([("xA yb",)], "text string")
    a, b = ([sorted(map(str, resampling.resample(d, target, percent=40, least_words=5).select("doc_id", "weight", "score", F.col("rank")).collect())) for d in docs])
    assert a == b
