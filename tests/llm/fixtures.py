"""Rows that operators must bear: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

CLASHES = {"n_words": "long", "_id": "string", "score": "string", "n_lines": "string", "_doc": "string", "component_id": "string"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{k}` {v}" for k, v in CLASHES.items())


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", len(text or ""), 7, "x", "y", "z", "w", "v")


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=1):
    """About 60 rows: random texts, exact and near copies, shared passages, short texts, odd ones."""
    rng = random.Random(seed)
    shared = prose(rng, 30)
    texts = []
    for i in range(20):
        body = prose(rng, rng.randrange(20, 90))
        if i % 3 == 0:
            body[5:5] = shared
        texts.append(" ".join(body))
    for i in range(12):  # near copies of the first
        body = texts[0].split()
        for _ in range(i % 4):
            body[rng.randrange(len(body))] = "changed"
        texts.append("  ".join(body))
    texts += [texts[1]] * 5 + [texts[2].upper(), texts[2] + " \n tail"]
    texts += ["", " \n\t ", None, "One", "one two three", "ONE two  three", "one two three four five six", "é ü ñ ö å ç", "▁ mark \x1c sep"]
    texts.append(" ".join(prose(rng, 6000)))
    texts.append("line one a\nline two b\nline three c\n" * 8)
    rows = [row(100 + i, t) for i, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    rows.append(row(None, texts[4]))
    return rows


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)
