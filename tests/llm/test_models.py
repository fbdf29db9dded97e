"""Trained operators: accuracy on rows that were not trained on, and rows without content."""

import random
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import corpus, frame, row
from voxweave.llm import language, licenses, quality, toxicity, urls
from voxweave.llm import kernels as K
from voxweave.llm.linear import Rows, logistic, platt, sigmoid

SYLLABLES = {"en": "th er ing and ly ou wh".split(), "de": "sch ung ein ß keit ü ge".split(), "fr": "eau tre é ç oi ê ré".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def languages(seed, n):
    rng = random.Random(seed)
    return [row(i, text(rng, lang, rng.randrange(3, 60)), lang) for i, lang in enumerate(rng.choice(list(SYLLABLES)) for _ in range(n))]


def test_language(spark):
    docs = frame(spark, languages(1, 600))
    model = language.fit(docs, 100)
    got = language.identify(docs, model).collect()
    assert np.mean([r.lang_pred == r.lang for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    odd = frame(spark, [row(1, None), row(2, ""), row(3, "12 34 !!"), row(None, "ung ein sch keit")])
    odd = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert [(odd[i].lang_pred, odd[i].score, odd[i].rejected) for i in (1, 2, 3)] == [("und", 0.0, True)] * 3
    assert odd[None].lang_pred == "de"
    assert len(language.identify(frame(spark, corpus()), model).collect()) == len(corpus())


def test_language_never_learns_from_held_out_rows(spark):
    rows = languages(2, 400)
    poisoned = [r if zlib.crc32(str(r[0]).encode()) % 4 != 2 else row(r[0], r[1], "xx") for r in rows]
    model = language.fit(frame(spark, poisoned), 60)
    assert "xx" not in model.languages
    assert language.fit(frame(spark, [])).languages == []
    assert language.predict(language.fit(frame(spark, [])), pa.array(["abc"]))[0] == ["und"]


def test_whole_text_counts():
    """The end of a long text counts as much as its start."""
    rng = random.Random(3)
    model = language.train(*zip(*[(r[1], r[2]) for r in languages(4, 300)]))
    long = text(rng, "de", 50) + " " + text(rng, "fr", 4000)
    assert language.predict(model, pa.array([long]))[0] == ["fr"]


def labelled(n, seed=5):
    rng = random.Random(seed)
    bad = "idiot scum moron trash loser".split()
    rows, marks = [], []
    for i in range(n):
        words = text(rng, "en", rng.randrange(20, 120)).split()
        toxic, junk = int(i % 6 == 0), int(i % 5 == 0)
        for _ in range(rng.choice((1, 2, 5)) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        if junk:
            words = [w + rng.choice(("***", "###", "$$$")) for w in words]
        rows.append(row(i, " ".join(words)))
        marks.append((i, 1 - junk, toxic))
    return rows, marks


def test_toxicity(spark):
    rows, marks = labelled(900)
    docs, labels = frame(spark, rows), spark.createDataFrame([m for m in marks if m[0] < 600], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in toxicity.grade(docs, model).collect()}
    unseen = [m for m in marks if m[0] >= 600]
    assert np.mean([got[m[0]].toxic == bool(m[2]) for m in unseen]) > 0.97
    few = np.mean([r.severity for r in got.values() if sum(w in rows[r.doc_id][1].split() for w in ("idiot", "scum", "moron", "trash", "loser")) == 1])
    many = np.mean([r.severity for r in got.values() if sum(w in rows[r.doc_id][1].split() for w in ("idiot", "scum", "moron", "trash", "loser")) >= 3])
    assert few < many
    odd = {r.doc_id: r for r in toxicity.grade(frame(spark, [row(1, None), row(2, ""), row(None, "you idiot scum moron")]), model).collect()}
    assert (odd[1].severity, odd[1].toxic, odd[2].severity) == (0.0, False, 0.0) and odd[None].toxic
    empty = toxicity.fit(docs, labels.limit(0))
    assert not any(r.toxic for r in toxicity.grade(docs, empty).collect())


def test_quality(spark):
    rows, marks = labelled(700)
    docs, labels = frame(spark, rows), spark.createDataFrame([m for m in marks if m[0] < 500], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.rate(docs, model).collect()}
    clean = [m for m in marks if m[0] >= 500 and not got[m[0]].base_failed]
    assert np.mean([got[m[0]].kept == bool(m[1]) for m in clean]) > 0.97
    assert all(0 <= r.quality <= 1 for r in got.values())
    assert quality.fit(docs, labels.where("quality = 1")).weight is None


def test_logistic_and_platt():
    rng = np.random.default_rng(0)
    x = rng.random((400, 6))
    y = (x[:, 0] - x[:, 1] > 0).astype(int)
    rows = Rows(np.tile(np.arange(6), 400), x.ravel(), np.arange(0, 2401, 6), 6)
    weight, bias = logistic(rows, y, steps=200)
    z = rows.dot(weight) + bias
    assert np.allclose(z, x @ weight + bias, atol=1e-3)
    assert np.mean((z > 0) == y) > 0.95
    a, b = platt(z, y, np.ones(400))
    p = sigmoid(a * z + b)
    assert abs(p.mean() - y.mean()) < 0.05


@pytest.fixture(scope="module")
def scanner(spark):
    rng = random.Random(8)
    rows = [row(i, "\n".join(text(rng, "en", rng.randrange(3, 30)) for _ in range(6))) for i in range(200)]
    docs = frame(spark, rows)
    return docs, licenses.fit(docs, 400)


def test_licences(spark, scanner):
    docs, model = scanner
    assert licenses.scan(docs, model).count() == 0
    notices = [
        (1, "th er\nLicensed under the Apache License, Version 2.0.", "Apache-2.0"),
        (2, "Released under the MIT License.", "MIT"),
        (3, "er ing\n\nThis work is licensed under the GNU General Public License, version 3.\nly", "GPL-3.0"),
        (4, "Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
        (5, "Released under the Moonbase Private License; all rights reserved.", "unknown"),
    ]
    rows = [row(i, t) for i, t, _ in notices] + [row(6, None), row(7, ""), row(8, " \n "), row(None, "Released under the MIT License.")]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, rows), model).collect()}
    assert {i: got[i].family for i, _, _ in notices} == {i: f for i, _, f in notices}
    assert got[1].line == 2 and got[3].line == 3 and got[1].confirmed and got[None].family == "MIT"
    assert not {6, 7, 8} & set(got)
    assert licenses.scan(frame(spark, []), model).count() == 0


@pytest.mark.parametrize("texts", [[], [None, None], ["", " \n "], ["Released under the MIT License."] * 3])
def test_licences_learnt_from_hardly_any_text(spark, texts):
    docs = frame(spark, [row(i, t) for i, t in enumerate(texts)])
    model = licenses.fit(docs)
    rows = [row(1, "Released under the MIT License."), row(1, "Released under the MIT License."), row(2, "hello world"), row(None, None)]
    got = [(r.doc_id, r.family) for r in licenses.scan(frame(spark, rows), model).collect()]
    assert got == [(1, "MIT"), (1, "MIT")]
    assert licenses.scan(docs, model).count() == len([t for t in texts if t and "MIT" in t])


def test_very_long_paragraph(spark, scanner):
    _, model = scanner
    rng = random.Random(12)
    rows = [row(1, text(rng, "en", 20000) + " Released under the MIT License. " + text(rng, "en", 2000)), row(2, text(rng, "en", 20000))]
    assert {r.doc_id for r in licenses.scan(frame(spark, rows), model).collect()} <= {1}


MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:"
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:"
)
GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version."
)


def test_wrapped_licences(spark, scanner):
    """Licence texts at their usual width, in paragraphs of several lines."""
    _, model = scanner
    wrapped = {f: textwrap.wrap(x, 78) for f, x in (("MIT", MIT), ("BSD", BSD), ("GPL-3.0", GPL))}
    rows = [row(i, "\n".join(["th er", "", *x, " ", "ing ly"])) for i, x in enumerate(wrapped.values())]
    got = licenses.scan(frame(spark, rows + [row(9, "th er\ning ly\n\nou wh")]), model).collect()
    assert {(r.doc_id, r.family, r.line, r.last_line) for r in got} == {(i, f, 3, 2 + len(x)) for i, (f, x) in enumerate(wrapped.items())}
    assert len(got) == 3 and all(r.confirmed for r in got)


def test_fixed_url_rules(spark):
    cases = [
        ("http://Example.COM/en/1", "example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/x?q=1", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("https://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("https://a.example.com/de/#x", "a.example.com", "/de/", "com/", "allow"),
        ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
        ("http://x.net/es", "x.net", "/es", None, "allow"),
        ("http://notexample.com", "notexample.com", "", None, "allow"),
        ("http://x.org?a=http://y.com/", "x.org", "", None, "allow"),
        ("no host here", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("a://ÄB.net#/fr/", "Äb.net", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "h", "z") for i, c in enumerate(cases)], "page_id long, url string, html string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: tuple(r)[1:] for r in urls.judge(pages, labels).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}


def test_mined_url_rules(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        spam = i % 4 == 0
        host = rng.choice(("pills", "casino")) if spam else rng.choice(("blog", "news", "shop"))
        rows.append((i, f"http://{host}.site{rng.randrange(5)}.org/{'buy' if spam else 'read'}/{i}"))
        if i < 400:
            labels.append((i, 0 if spam else 1, 0))
    pages = spark.createDataFrame(rows + rows[:2] + [(None, rows[0][1])], "page_id long, url string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    mined = urls.mine(pages, marks)
    assert {tuple(r.tokens) for r in mined.collect()} == {("path=buy",), ("first=pills",), ("first=casino",)}
    got = urls.judge(pages, marks).collect()
    assert len(got) == 603
    assert all((r.verdict == "block") == ("/buy/" in r.path) for r in got)
    by_hand = {u for _, u in rows if "/buy/" in u}
    assert {r.url for r in urls.matched(pages, mined).collect()} == by_hand
    assert urls.judge(pages.limit(0), marks).count() == 0


def test_sums_of_whole_texts():
    data, at = K.utf8(pa.array(["abc", None, "", "de"]))
    assert at.tolist() == [0, 3, 3, 3, 5]
    assert language.has_letter(pa.array(["1é", None, "", "..."]), *K.utf8(pa.array(["1é", None, "", "..."]))).tolist() == [True, False, False, False]


def test_fold_is_crc32(spark):
    got = spark.range(50).select("id", language.fold(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 4 for r in got)
