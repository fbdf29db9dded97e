"""Substring dedup, Jaccard join, line dedup and quality counts against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.fixtures import corpus, frame, prose, row
from voxweave.llm import jaccard, kernels as K, lines, quality, substrings
from voxweave.session import ARROW_LIMIT

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FIRST = -(1 << 63)


def key(doc_id):
    return FIRST if doc_id is None else doc_id


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x1c ▁", max_size=30)), max_size=8))
@settings(max_examples=80, deadline=None)
def test_words_and_hashes(texts):
    data, at = K.utf8(pa.array(texts, pa.string()))
    w = K.words(data, at)
    got = [[data[s:e].tobytes().decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [WORD.findall(t or "") for t in texts]
    flat = [x for g in got for x in g]
    assert len(set(w.hash.tolist())) == len(set(flat))
    values = np.array([hash(x) & 0xFFFF for x in flat], np.uint64)
    wins = [tuple(values[i : i + 3].tolist()) for i in range(len(values) - 2)]
    assert len(set(K.windows(values, 3, 0x9E3779B97F4A7C15).tolist())) == len(set(wins))


@given(st.lists(st.integers(0, 5000), max_size=40, unique=True))
@settings(max_examples=60, deadline=None)
def test_packed_gaps(values):
    values = np.array(sorted(values), np.int64)
    assert K.unpack_gaps(K.pack_gaps(values)).tolist() == values.tolist()


def substrings_by_hand(rows, size):
    seen, out = {}, []
    windows = {}
    for r in rows:
        w = WORD.findall(r[1] or "")
        for i in range(len(w) - size + 1):
            g = tuple(w[i : i + size])
            windows[g] = min(windows.get(g, (1 << 62, 0)), (key(r[0]), i))
    for r in rows:
        w = WORD.findall(r[1] or "")
        gone = set()
        for i in range(len(w) - size + 1):
            if windows[tuple(w[i : i + size])] < (key(r[0]), i):
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("batch", [1 << 20, 150])
def test_substrings(spark, monkeypatch, batch):
    monkeypatch.setattr(substrings, "BATCH_WORDS", batch)
    rows = corpus()
    got = substrings.repeated_windows(frame(spark, rows), 20)
    assert Counter(tuple(r)[:4] for r in got.collect()) == substrings_by_hand(rows, 20)
    spans = {r.doc_id: (r.span_starts, r.span_ends) for r in got.collect()}
    assert all(len(a) == len(b) and all(x < y for x, y in zip(a, b)) for a, b in spans.values())


def test_substrings_of_nothing(spark):
    assert substrings.repeated_windows(frame(spark, [])).count() == 0


def components_by_hand(rows, share=75):
    ids, sets = [], {}
    for r in rows:
        w = WORD.findall("".join(c.lower() if c.isascii() else c for c in r[1] or ""))
        g = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        ids.append((r[0], g))
        sets.setdefault(key(r[0]), []).append(g)
    names = sorted(sets)
    root = {n: n for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= share * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    back = lambda n: None if n == FIRST else n
    return Counter((d, len(g), back(find(key(d)))) for d, g in ids)


@pytest.mark.parametrize("batch,part,cut", [(1 << 20, 400, None), (200, 2, 1 << 30), (200, 2, 2)])
def test_jaccard(spark, monkeypatch, batch, part, cut):
    """Also with small batches, salted hubs, and all sets light or all heavy."""
    monkeypatch.setattr(jaccard, "BATCH", batch)
    monkeypatch.setattr(jaccard, "PART_ROWS", part)
    if cut is not None:
        monkeypatch.setattr(jaccard, "boundary", lambda sets, shared: cut if cut < 1000 else 400)
    rows = corpus(3)
    got = jaccard.jaccard_components(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == components_by_hand(rows)


def test_jaccard_chain_and_unlinked_group(spark):
    """A chain whose ends are not linked, and texts that share a passage but are no copies."""
    rng = random.Random(5)
    body = prose(rng, 120, 5000)
    rows, now = [], list(body)
    for i in range(12):
        rows.append(row(i, " ".join(now)))
        for _ in range(2):
            now[rng.randrange(len(now))] = f"new{i}{rng.randrange(99)}"
    passage = prose(rng, 40, 5000)
    for i in range(12):
        rows.append(row(50 + i, " ".join(passage + prose(rng, 25, 90000))))
    got = jaccard.jaccard_components(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == components_by_hand(rows)


def test_jaccard_of_shared_ids(spark):
    """Rows of different texts and sizes under a null id and under one id, each with a near copy elsewhere."""
    rng = random.Random(8)
    rows = []

    def near(body):
        return " ".join([*body[:-1], "changed"])

    for i, shared in enumerate((None, None, None, 40, 40, 40, 41, None, 41)):
        body = prose(rng, 30 + 45 * i, 90000)
        rows += [row(shared, " ".join(body)), row(200 + i, near(body))]
    rows += [row(7, rows[6][1]), row(41, " "), row(None, None), row(300, ""), row(301, " ".join(prose(rng, 50, 90000)))]
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        got = jaccard.jaccard_components(frame(spark, rows)).collect()
        assert Counter(tuple(r) for r in got) == components_by_hand(rows)
    apart = [r for r in rows if r[0] not in (None, 41)]  # one id alone joins its texts
    got = jaccard.jaccard_components(frame(spark, apart)).collect()
    assert Counter(tuple(r) for r in got) == components_by_hand(apart)
    assert {r.component_id for r in got if r.doc_id in (7, 40, 203, 204, 205)} == {7}


@pytest.mark.parametrize("few", [False, True])
def test_rounds_over_a_long_list(spark, monkeypatch, few):
    """A list of unlinked sets takes few rounds whichever way its pairs are compared, and every link is found."""
    for limit in () if few else ("LOOKED", "PAIRS", "EACH", "FEW"):
        monkeypatch.setattr(jaccard, limit, 0, raising=False)
    monkeypatch.setattr(jaccard, "DEALT", 500, raising=False)
    if few:
        monkeypatch.setattr(jaccard, "PAIRS", 0)
    rng, rounds, plain = random.Random(4), [], jaccard.links
    monkeypatch.setattr(jaccard, "links", lambda *a, **k: rounds.append(1) or plain(*a, **k))
    words = [rng.getrandbits(63) for _ in range(60)]
    sets = [set(rng.sample(words, 12 if i % 5 else 10)) for i in range(140)]
    sets += [{*sorted(sets[i])[1:], rng.choice(words)} for i in range(20)]
    rows = [(i, len(s), np.array(sorted(s), np.uint64).tobytes()) for i, s in enumerate(sets)]
    members = [(1, i, len(s), rng.random(), 0) for i, s in enumerate(sets)]
    got = jaccard.linked_components(
        spark.createDataFrame(members, "key long, _id long, n long, w double, place int"), spark.createDataFrame(rows, "_id long, n long, tokens binary")
    ).collect()
    root = list(range(len(sets)))
    linked = {(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    for _ in sets:
        for i, j in linked:
            root[i] = root[j] = min(root[i], root[j])
    of = {i for pair in linked for i in pair}
    assert len(linked) >= 10 and sorted(map(tuple, got)) == sorted((i, root[i]) for i in of)
    assert len(rounds) <= 6


def test_jaccard_works_on_slices(spark, monkeypatch):
    """A worker holds the texts of one slice at a time, and Arrow batches end by bytes."""
    rows = [row(i, " ".join(prose(random.Random(i), 300))) for i in range(40)]
    texts = [r[1] for r in rows]
    h, first = jaccard.shingle_sets(*K.utf8(pa.array(texts)))
    prints = jaccard._fingerprints(h, first).view(np.int64)
    batch = pa.record_batch({"doc_id": pa.array(range(40), pa.int64()), "text": pa.array(texts)})
    wanted = pa.table({"_id": range(1, 40, 2), "print1": prints[0][1::2], "print2": prints[1][1::2], "n": np.diff(first)[1::2], "node": range(500, 520)})
    held, plain = [], jaccard.shingle_sets
    monkeypatch.setattr(jaccard, "SLICE", 4000)
    monkeypatch.setattr(jaccard, "shingle_sets", lambda data, at: held.append(len(data)) or plain(data, at))
    got = jaccard._sets_of(pa.table({"texts": [K.to_stream(batch)]}), wanted)
    assert max(held) < 4000 + 2 * max(map(len, texts)) and sum(held) == sum(len(t) for t in texts[1::2])
    sets = {i: t for i, t in zip(got.column("_id").to_pylist(), got.column("tokens").to_pylist())}
    assert sets == {500 + k: h[first[2 * k + 1] : first[2 * k + 2]].tobytes() for k in range(20)}
    before = spark.conf.get(ARROW_LIMIT, None)
    spark.conf.unset(ARROW_LIMIT)
    jaccard.jaccard_components(frame(spark, rows[:2]))
    assert int(spark.conf.get(ARROW_LIMIT)) <= 4 << 20
    spark.conf.unset(ARROW_LIMIT) if before is None else spark.conf.set(ARROW_LIMIT, before)


def test_jaccard_of_nothing(spark):
    assert jaccard.jaccard_components(frame(spark, [])).count() == 0
    one = jaccard.jaccard_components(frame(spark, [row(4, None), row(5, " ")])).collect()
    assert Counter(tuple(r) for r in one) == Counter([(4, 0, 4), (5, 0, 5)])


def lines_by_hand(rows):
    def chunks(text):
        parts, out, first, before = text.split("\n"), [], 0, 0
        for i, x in enumerate(parts):
            h = int(hashlib.md5(x.encode()).hexdigest()[:15], 16) % lines.PRIME
            if (before * lines.BASE + h) % lines.PRIME % lines.DIVISOR == 0 or i == len(parts) - 1:
                out.append((first, i))
                first = i + 1
            before = h
        out = [c for c in out if c[1] > c[0] + 1] + [(i, i + 1) for i in range(len(parts) - 1)]
        return parts, [c for c in out if WORD.search("".join(parts[c[0] : c[1] + 1]))]

    at, out = {}, []
    for r in rows:
        if r[1] is not None:
            parts, own = chunks(r[1])
            for a, b in own:
                body = "\n".join(parts[a : b + 1])
                at[body] = min(at.get(body, (1 << 62, 0)), (key(r[0]), a))
    for r in rows:
        if r[1] is None:
            out.append((r[0], None, 0, 0))
            continue
        parts, own = chunks(r[1])
        gone = {i for a, b in own if at["\n".join(parts[a : b + 1])] != (key(r[0]), a) for i in range(a, b + 1)}
        out.append((r[0], "\n".join(x for i, x in enumerate(parts) if i not in gone), len(parts), len(gone)))
    return Counter(out)


def test_lines(spark):
    rng = random.Random(2)
    block = [" ".join(prose(rng, 6)) for _ in range(9)]
    rows = corpus()
    for i in range(12):
        own = [" ".join(prose(rng, 6)) for _ in range(i % 5)]
        rows.append(row(500 + i, "\n".join(own + block + own[:1])))
    docs = frame(spark, rows)
    got = lines.drop_repeated_chunks(docs)
    assert got.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    found = Counter(tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_removed").collect())
    assert found == lines_by_hand(rows)
    assert sum(r[3] for r in found) > 20
    assert lines.drop_repeated_chunks(frame(spark, [])).count() == 0


@pytest.mark.parametrize("span_bytes", [0, 32 << 20])
def test_lines_of_shared_ids(spark, monkeypatch, span_bytes):
    """Rows of different texts under one id, or none, lose only their own lines."""
    monkeypatch.setattr(lines, "SPAN_BYTES", span_bytes)
    rng = random.Random(4)
    passage = [" ".join(prose(rng, 6)) for _ in range(35)]
    other = [" ".join(prose(rng, 6)) for _ in range(40)]
    rows = [row(1, "\n".join(passage)), row(7, "\n".join(passage)), row(7, "\n".join(other))]
    got = Counter(tuple(r) for r in lines.drop_repeated_chunks(frame(spark, rows)).select("doc_id", "text", "n_lines", "n_removed").collect())
    assert got == lines_by_hand(rows) and {r[3] for r in got} == {0, 35}
    rows += [row(None, "\n".join(x)) for x in (passage[3:9], other[:5], other[:5], ["new line", *passage[10:12]])]
    rows += [row(7, "\n".join(["head", *other[4:9], "tail"])), row(0, "\n".join(other[30:]))]
    got = Counter(tuple(r) for r in lines.drop_repeated_chunks(frame(spark, rows)).select("doc_id", "text", "n_lines", "n_removed").collect())
    assert got == lines_by_hand(rows)


def test_short_passages_are_found(spark):
    """Shared passages of 2 to 8 lines, planted once in each of many texts, go from all but the first."""
    rng = random.Random(9)
    passages = [[" ".join(prose(rng, 9, 90000)) for _ in range(n)] for n in range(2, 9)]
    rows = []
    for i in range(70):
        body = [" ".join(prose(rng, 9, 90000)) for _ in range(rng.randrange(6, 14))]
        at = rng.randrange(len(body))
        rows.append(row(i, "\n".join(body[:at] + passages[i % 7] + body[at:])))
    got = {r.doc_id: r.n_removed for r in lines.drop_repeated_chunks(frame(spark, rows)).collect()}
    assert got == {i: 0 if i < 7 else len(passages[i % 7]) for i in range(70)}


@pytest.mark.parametrize("batch", [1 << 20, 60])
def test_substrings_of_shared_ids(spark, monkeypatch, batch):
    monkeypatch.setattr(substrings, "BATCH_WORDS", batch)
    rng = random.Random(6)
    passage = prose(rng, 40, 5000)
    rows = [row(1, " ".join(passage)), row(5, " ".join(prose(rng, 30, 90000) + passage)), row(5, " ".join(prose(rng, 80, 90000)))]
    got = Counter(tuple(r)[:4] for r in substrings.repeated_windows(frame(spark, rows, 1), 20).collect())
    assert got == substrings_by_hand(rows, 20) and sorted(r[2] for r in got) == [0, 0, 40]
    for i in range(9):  # null ids and one id with the passage at several places
        rows.append(row((None, 5, 5)[i % 3], " ".join(prose(rng, 7 * i, 90000) + passage[: 20 + i] + prose(rng, 5, 90000))))
    rows += rows[3:6]
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        got = Counter(tuple(r)[:4] for r in substrings.repeated_windows(frame(spark, rows, 1 + seed), 20).collect())
        assert got == substrings_by_hand(rows, 20)


def test_quality_counts(spark):
    rows = corpus() + [row(900, "a b c d e " * 7 + "# $ |\nsame line\nsame line\n\n \n same line")]
    docs = frame(spark, rows)
    got = quality.rate(docs, quality.Model(None)).collect()
    want = []
    for r in rows:
        t = r[1] or ""
        w = WORD.findall(t)
        win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count = Counter(win)
        cover = {j for i, x in enumerate(win) if count[x] > 1 for j in range(i, i + 5)}
        held = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        symbols = sum(c in "#*$%&|<>" for c in t)
        want.append((r[0], len(w), sum(map(len, w)), symbols, len(held) - len(set(held)), len(cover), failed, not failed, None))
    assert Counter(tuple(r) for r in got) == Counter(want)
    assert quality.rate(frame(spark, []), quality.Model(None)).count() == 0
