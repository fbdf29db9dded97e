"""Piece encoding against a plain Viterbi, decontamination against brute force, and the pipeline against its parts."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tests.llm.fixtures import corpus, frame, row
from tests.llm.test_text_operators import components_by_hand, lines_by_hand
from voxweave.llm import decontaminate, pieces
from voxweave.llm import kernels as K


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


@pytest.fixture(scope="module")
def automaton(vocabulary):
    return pieces.Automaton(vocabulary)


def plain_viterbi(v, text):
    own = {p.decode(): (float(s), int(i)) for p, s, i in zip(v.pieces, v.scores, v.ids)}
    text = " " + text if text else ""
    longest, unknown = max(map(len, own)), float(v.scores.min()) - pieces.UNKNOWN_COST
    best, back = [0.0] + [-np.inf] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            got = own.get(text[start:end])
            if got and best[start] + got[0] > best[end]:
                best[end], back[end] = best[start] + got[0], (start, [got[1]])
        if text[end - 1] not in own and best[end - 1] + unknown > best[end]:
            best[end], back[end] = best[end - 1] + unknown, (end - 1, [int(v.byte_ids[b]) for b in text[end - 1].encode()])
    out, end = [], len(text)
    while end:
        out[:0] = back[end][1]
        end = back[end][0]
    return out


@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="the and ing\n\t▁é日,.", max_size=60)), max_size=6))
@settings(max_examples=60, deadline=None)
def test_pieces(vocabulary, automaton, texts):
    ids, bounds, same = pieces.encode_texts(automaton, *K.utf8(pa.array(texts, pa.string())))
    assert same.all()
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == plain_viterbi(vocabulary, text)


def test_pieces_in_spark(spark, vocabulary):
    docs = frame(spark, corpus() + [row(999, "x" * 30000), row(998, "é\n" * 20000)])
    got = pieces.tokenize(docs, vocabulary).cache()
    rows = {r.doc_id: r for r in got.collect()}
    assert all(r.round_trip is not False for r in rows.values())
    nulls = [r for r in got.collect() if r.ids is None]
    assert [(r.n_tokens, r.round_trip) for r in nulls] == [(None, None)]
    back = pieces.detokenize(got, vocabulary)
    assert Counter(map(tuple, back.collect())) == Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert pieces.tokenize(frame(spark, []), vocabulary).count() == 0


def test_other_vocabularies():
    """Pieces that go on over a blank: texts are walked whole; ties go to the longer last piece."""
    byte_ids = np.arange(256, dtype=np.int32)
    v = pieces.Vocabulary(np.array([256, 257, 258, 259], np.int32), [b" a", b"b", b"a b", b" a b"], np.array([-1.0, -1.0, -1.0, -3.0]), byte_ids, 260)
    a = pieces.Automaton(v)
    assert not a.splits
    ids, bounds, same = pieces.encode_texts(a, *K.utf8(pa.array(["a b", "", "c"])))
    assert same.all() and [ids[x:y].tolist() for x, y in zip(bounds[:-1], bounds[1:])] == [plain_viterbi(v, t) for t in ("a b", "", "c")]


UPPER = "[A-ZÄÖÜÉ]"
LOWER = "[a-zäöüéß]"


def canonical(text):
    text = re.sub(f"((?:{LOWER}|[,;]) ){UPPER}{LOWER}+", "\\1<name>", text)
    text = re.sub(f"(<name> ){UPPER}{LOWER}+", "\\1<name>", text)
    out = []
    for raw in re.split(r"[\x20\x09-\x0D]+", text):
        bare = raw.rstrip(")],.;:!?").lstrip("([+-$")
        if re.fullmatch(r"\d[\d.,:/%\-]*", bare):
            out.append("<num>")
        elif re.fullmatch(r"\d[\d.,]*[^\W\d_]{1,4}", bare):
            out.append("<measure>")
        elif bare.lower() in decontaminate.UNITS:
            out.append("<unit>")
        else:
            word = raw if raw.startswith("<name>") else "".join(c for c in raw.lower() if c.isalnum())
            if word:
                out.append("<name>" if word.startswith("<name>") else word)
    return out


ITEMS = [
    (1, "A train leaves the station at 9 and travels 120 km before Anna gets off to meet Boris near the old bridge."),
    (2, "short one here now"),
    (3, None),
    (4, ""),
    (5, "No numbers in this question but it is long enough to have several windows of words."),
]
TEXTS = [
    (10, "Intro words. A train leaves the station at 7 and travels 300 km before Carla gets off to meet Dmitri near the old bridge. More."),
    (11, "A train leaves the station at 9 and travels 120 km before Anna gets off to meet Boris near the old bridge."),
    (12, "A train leaves a city and nothing else of it is the same as in any other text that we have here."),
    (13, "we saw short one here now and then"),
    (14, None), (15, ""), (16, "12 km 13 km 14 km 15 km 16 km 17 km"),
    (17, "pre no numbers in this question but it is long enough to have several windows of words post"),
    (18, "two two numbers in this question but it differs from there on in every way"),
]


def test_decontamination(spark):
    docs = frame(spark, [row(i, t) for i, t in TEXTS] + [row(11, TEXTS[1][1]), row(None, TEXTS[1][1])])
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(10, 1), (11, 1), (None, 1), (13, 2), (17, 5)}
    assert got[10, 1].reparameterised and not got[11, 1].reparameterised and got[10, 1].slots == 5
    matches = Counter((r.doc_id, r.item_id, r.size, r.place, r.item_place) for r in decontaminate.template_matches(docs, bench).distinct().collect())
    want = Counter()
    for i, a in ITEMS:
        w = canonical(a or "")
        size = min(len(w), 6)
        if len(w) < 4:
            continue
        for d, t in [*TEXTS, (None, TEXTS[1][1])]:
            v = canonical(t or "")
            for x in range(len(w) - size + 1):
                if 2 * sum(not y.startswith("<") for y in w[x : x + size]) < size:
                    continue
                for y in range(len(v) - size + 1):
                    want[d, i, size, y, x] += v[y : y + size] == w[x : x + size]
    assert matches == +want
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {12, 14, 15, 16, 18}
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_inconsistent_slots(spark):
    """One value of the item stands for two of the document: a match by chance."""
    bench = spark.createDataFrame([(1, "if Eve has 3 apples and then gives 3 apples to Tom how many apples has Eve now")], "item_id long, text string")
    docs = [row(1, "if Bob has 5 apples and then gives 5 apples to Sam how many apples has Bob now"), row(2, "if Bob has 5 apples and then gives 7 apples to Sam how many apples has Kim now")]
    got = {r.doc_id for r in decontaminate.contaminated(frame(spark, docs), bench).collect()}
    assert got == {1}


def test_copies_with_other_values(spark):
    """Each copy is judged by itself: other values elsewhere in a document do not clear it."""
    item = "if Eve has 3 apples and then gives 3 apples to Tom how many apples has Eve now"
    copy = lambda a, n, b: f"if {a} has {n} apples and then gives {n} apples to {b} how many apples has {a} now"
    chance = "if Bob has 5 apples and then gives 7 apples to Sam how many apples has Kim now"
    filler = "then we went on to talk of rather different things for a while and "
    other = "a tank holds 40 pails of clear water while two small pumps take 50 turns to move all of it over the yard when 30 valves stay shut"
    w = other.split()
    edited = " ".join(w[:7] + ["surely"] + w[7:14] + ["surely"] + w[14:21] + ["surely"] + w[21:])  # no single shift has enough windows
    docs = [
        row(1, item + " and " + copy("Bob", 5, "Sam")),
        row(2, filler + " and ".join(copy(a, n, "Sam") for a, n in (("Bob", 5), ("Kim", 7), ("Ann", 9)))),
        row(3, filler + item + " " + filler + chance),
        row(4, filler + edited + " " + filler + edited.replace("40", "44").replace("50", "55").replace("30", "33")),
        row(5, chance), row(6, chance + " " + filler + chance),
    ]
    bench = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contaminated(frame(spark, docs), bench).collect()}
    assert set(got) == {1, 2, 3, 4} and got[2].reparameterised and not got[3].reparameterised
    assert all(r.clashes == 0 for r in got.values())


def test_short_and_numeric_items(spark):
    """Items under four words, and windows of mostly numbers, are found with their very values and no others."""
    items = [(1, "Compute 12 + 35 - 7 * 20 / 4."), (2, "Define entropy."), (3, "Add 1 2 3 4 5 6 7 8 9 then tell me what comes out here")]
    docs = [
        row(1, "we read: compute 12 + 35 - 7 * 20 / 4. and more"), row(2, "we read: compute 12 + 35 - 7 * 20 / 5. and more"),
        row(3, "now define Entropy, please"), row(4, "now define enthalpy, please"), row(5, "entropy define"),
        row(6, "add 2 3 4 5 6 7 8 9 1 then tell me what comes out here"), row(7, "1 2 3 4 5 6 7 8"), row(8, "9 9 9 9 9 9 9 9"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, docs), bench).collect()}
    assert got >= {(1, 1), (3, 2), (6, 3)} and not {d for d, _ in got} & {2, 4, 5, 8}


def test_pipeline_stages(spark, folder, monkeypatch):
    rows = corpus()
    docs = frame(spark, rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("language_id", "line_dedup", "jaccard_join", "decontamination"):
        out = stages[name](spark, docs, folder)
        assert out.columns == docs.columns, name
        assert out.count() <= len(rows)
        assert stages[name](spark, docs.limit(0), folder).count() == 0
    cleaned = stages["line_dedup"](spark, docs, folder)
    assert Counter((r.doc_id, r.text) for r in cleaned.select("doc_id", "text").collect()) == Counter((r[0], r[1]) for r in lines_by_hand(rows).elements())
    kept = stages["jaccard_join"](spark, docs, folder)
    want = Counter(r[0] for r in components_by_hand(rows).elements() if r[0] == r[2])
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "n_tokens", "ids", "round_trip"]
