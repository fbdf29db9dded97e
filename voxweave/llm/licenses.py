"""Licence scans: a trained paragraph classifier on DataFrame functions and Spark's own (JVM) learner.

A paragraph is a run of lines up to a blank one. It is judged whole and line by line: a wrapped licence text shows only
in the whole, a notice among other lines on its line. Its distinct words and word pairs, as far as the training rows have them ``LEAST_ROWS`` times, are
its sparse features; multinomial logistic regression tells licence families, ``unknown`` licence wording and ordinary
text apart. It is trained on the notices below, alone and inside
sampled paragraphs of the corpus, with sampled paragraphs as ordinary text (``SAMPLE`` of them, chosen by hash: a bounded
sample). A quarter of the rows is held out; on it a one-variable logistic regression (Platt) turns the odds of the best
family into a calibrated probability. A family below ``LEAST_PROBABILITY`` becomes ``unknown``; so does one of which no
notice is found in the paragraph by at least ``LEAST_SHARE`` of its word pairs.

Rows: null and empty texts and blank lines have no paragraphs. One result row for each line with licence wording
(``line`` = ``last_line``). A paragraph of several lines has one of its own if it is confirmed for a family that none of
its lines is, in place of its unknown lines, or if it has licence wording and none of its lines has. A null doc_id stays null. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxweave.session import cut_lineage

from .native import hold

FEATURES = 1 << 12
LEAST_ROWS = 4
SAMPLE = 3000
LEAST_PROBABILITY = 0.5
LEAST_SHARE = 0.6
UNKNOWN, ORDINARY = "unknown", "none"
# Short public notices of each family.
NOTICES = {
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3.", "You can redistribute it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", "SPDX-License-Identifier: Apache-2.0"),
    "BSD": ("Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0": ("Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software under the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.", "SPDX-License-Identifier: GPL-3.0-or-later"),
    "LGPL": ("Licensed under the GNU Lesser General Public License, version 3.", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License."),
    "MIT": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the Software without restriction.", "SPDX-License-Identifier: MIT"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.", "Licensed under the Mozilla Public License 2.0."),
    UNKNOWN: ("All rights reserved.", "This work is licensed under the Example Public License, version 1.", "Released under a custom license; see the license file.", "Licensed under the terms of our commercial license agreement.", "Distributed under the accompanying license terms.", "No part of this work may be reproduced without written permission of the copyright holder."),
}
_PLACE = ("doc_id", "_text", "_run", "line", "last_line")
CLASSES = [*sorted(NOTICES), ORDINARY]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _pairs(words: str) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def _termed(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``paragraph``) and ``pairs``, ``terms``."""
    rows = rows.withColumn("_words", _words(F.col("paragraph"))).where(F.size("_words") > 0)
    rows = rows.withColumn("pairs", _pairs("_words")).withColumn("terms", F.concat("_words", "pairs"))
    return rows.drop("_words")


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, _text, _run, line, last_line, paragraph) of every line that is not blank, and of every run of such lines.

    Lines count from 1; ``_text`` is a hash of the text and ``_run`` the first line of the run.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("_text"), F.split(text, "\n", -1).alias("_lines"))
    blank = F.filter(F.transform("_lines", lambda x, i: F.when(~x.rlike(r"[\p{L}\p{N}]"), i + 1)), lambda i: i.isNotNull())
    rows = rows.withColumn("_ends", F.concat(F.array(F.lit(0)), blank, F.array(F.size("_lines") + 1)))
    bounds = F.zip_with(F.slice("_ends", F.lit(1), F.size("_ends") - 1), F.slice("_ends", F.lit(2), F.size("_ends") - 1), lambda a, b: F.struct((a + 1).alias("a"), b.alias("b")))
    runs = F.transform(F.filter(bounds, lambda x: x["b"] > x["a"]), lambda x: F.struct(x["a"].alias("first"), F.slice("_lines", x["a"], x["b"] - x["a"]).alias("own")))
    rows = rows.select("doc_id", "_text", F.explode(runs).alias("r")).select("doc_id", "_text", F.col("r.first").alias("_run"), "r.own")
    one = F.transform("own", lambda x, i: F.struct((F.col("_run") + i).alias("line"), (F.col("_run") + i).alias("last_line"), x.alias("paragraph")))
    whole = F.struct(F.col("_run").alias("line"), (F.col("_run") + F.size("own") - 1).alias("last_line"), F.array_join("own", "\n").alias("paragraph"))
    rows = rows.select("doc_id", "_text", "_run", F.explode(F.when(F.size("own") > 1, F.concat(one, F.array(whole))).otherwise(one)).alias("p"))
    return rows.select("doc_id", "_text", "_run", "p.*")


def _training_rows(docs: DataFrame, sample: int) -> DataFrame:
    """(label, paragraph, i): notices alone, notices inside sampled paragraphs, and sampled paragraphs."""
    spark = docs.sparkSession
    n = docs.count()
    share = min(1.0, 2.0 * sample / max(1, n))
    near = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 31)) < F.lit(share * (1 << 31)))
    lines = paragraphs(near).where(F.length("paragraph").between(1, 2000))
    order = F.xxhash64("doc_id", "line", "paragraph")
    some = lines.select("paragraph", order.alias("i")).orderBy("i", "paragraph").limit(sample)
    notices = [(CLASSES.index(k), x) for k in sorted(NOTICES) for x in NOTICES[k]]
    table = spark.createDataFrame([(j, float(c), x) for j, (c, x) in enumerate(notices)], "j int, label double, notice string")
    held = reduce(lambda a, b: a | b, [F.lower("paragraph").contains(x.lower().rstrip(".")) for _, x in notices])
    some = cut_lineage(some.where(~held & ~F.lower("paragraph").rlike("licen[sc]e")))
    ordinary = some.select(F.lit(float(CLASSES.index(ORDINARY))).alias("label"), "paragraph", "i")
    words = F.split("paragraph", " ")
    context = some.withColumn("j", F.pmod("i", F.lit(len(notices))).cast("int")).join(F.broadcast(table), "j")
    cut = F.pmod(F.shiftright("i", 20), F.lit(12)).cast("int")
    inside = context.select(
        "label",
        F.concat_ws(" ", F.concat_ws(" ", F.slice(words, F.lit(1), cut)), "notice", F.concat_ws(" ", F.slice(words, cut + 1, cut))).alias("paragraph"),
        F.xxhash64("i").alias("i"),
    )
    alone = table.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(7)))).select("label", F.col("notice").alias("paragraph"), F.xxhash64("j", "k").alias("i"))
    return ordinary.unionAll(inside).unionAll(alone)


class Model:
    def __init__(self, terms: CountVectorizerModel, families: LogisticRegressionModel, slope: float, offset: float):
        self.terms, self.families, self.slope, self.offset = terms, families, slope, offset


def _best(scored: DataFrame) -> DataFrame:
    """Best licence class and the odds of its probability."""
    p = vector_to_array("probability")
    licence = F.slice(p, 1, len(CLASSES) - 1)
    top = F.array_max(licence)
    ordinary = F.coalesce(F.get(p, F.lit(len(CLASSES) - 1)), F.lit(0.0))  # a corpus without ordinary paragraphs trains no such class
    return scored.withColumn("_ordinary", ordinary).withColumn("_top", top).withColumn(
        "_class", F.array_position(licence, top).cast("int") - 1
    ).withColumn("_odds", F.log((F.col("_top") + 1e-9) / (1 - F.col("_top") + 1e-9)))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    rows = _termed(_training_rows(docs, sample)).select("label", "terms", (F.pmod("i", F.lit(4)) == 3).alias("held"))
    # A paragraph without a known term is ordinary, also where the corpus has no paragraph to learn that from.
    bare = docs.sparkSession.range(16).select(F.lit(float(CLASSES.index(ORDINARY))).alias("label"), F.array().cast("array<string>").alias("terms"), (F.col("id") % 4 == 3).alias("held"))
    rows = cut_lineage(rows.unionAll(bare).coalesce(4))
    terms = CountVectorizer(inputCol="terms", outputCol="features", vocabSize=FEATURES, minDF=LEAST_ROWS, binary=True).fit(rows)
    rows = cut_lineage(terms.transform(rows).drop("terms"))
    learner = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60)
    families = learner.fit(rows.where(~F.col("held")))
    checked = _best(families.transform(rows.where("held")))
    right = (F.col("_class") == F.col("label")).cast("double")
    odds = hold(checked.select("_odds", "_top", "_ordinary", "_class", "label")).where(F.col("_top") > F.col("_ordinary")).select("_odds", right.alias("label"))
    soft = docs.sparkSession.createDataFrame([(-3.0, 0.0), (-1.0, 0.0), (1.0, 1.0), (3.0, 1.0)], "_odds double, label double")
    single = VectorAssembler(inputCols=["_odds"], outputCol="features").transform(odds.unionAll(soft))
    platt = LogisticRegression(regParam=1e-2, maxIter=50).fit(cut_lineage(single))
    return Model(terms, families, float(platt.coefficients[0]), float(platt.intercept))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, line, family, probability, confirmed, last_line) of every paragraph with licence wording."""
    spark = docs.sparkSession
    scored = _best(model.families.transform(model.terms.transform(_termed(paragraphs(docs)))))
    scored = hold(scored.select(*_PLACE, "pairs", "_ordinary", "_top", "_class", "_odds")).where(F.col("_top") > F.col("_ordinary"))
    probability = 1 / (1 + F.exp(-(F.col("_odds") * model.slope + model.offset)))
    names = F.array(*[F.lit(c) for c in CLASSES])
    rows = scored.select(*_PLACE, "pairs", F.element_at(names, F.col("_class") + 1).alias("_family"), probability.alias("probability"))
    known = spark.createDataFrame([(k, x) for k in sorted(NOTICES) if k != UNKNOWN for x in NOTICES[k]], "_family string, notice string")
    known = known.withColumn("_w", _words(F.col("notice"))).select("_family", F.array_distinct(_pairs("_w")).alias("_notice"))
    known = known.groupBy("_family").agg(F.collect_list("_notice").alias("_notices"))
    rows = rows.join(F.broadcast(known), "_family", "left")
    share = F.array_max(F.transform("_notices", lambda n: F.size(F.array_intersect(n, F.col("pairs"))) / F.size(n)))
    confirmed = F.coalesce(share, F.lit(0.0)) >= LEAST_SHARE
    family = F.when(confirmed & (F.col("probability") >= LEAST_PROBABILITY), F.col("_family")).otherwise(F.lit(UNKNOWN))
    rows = rows.select(*_PLACE, family.alias("family"), "probability", confirmed.alias("confirmed"))
    run = Window.partitionBy("doc_id", "_text", "_run")
    line, known = F.col("line") == F.col("last_line"), F.col("family") != UNKNOWN
    rows = rows.withColumn("_named", F.collect_set(F.when(line & known, F.col("family"))).over(run)).withColumn("_found", F.max(line).over(run))
    told = ~line & F.when(known, ~F.array_contains("_named", F.col("family"))).otherwise(~F.col("_found"))
    rows = rows.withColumn("_told", told).withColumn("_whole", F.max(F.col("_told") & known).over(run))
    rows = rows.where(F.when(line, known | ~F.col("_whole")).otherwise(F.col("_told")))
    return rows.select("doc_id", "line", "family", "probability", "confirmed", "last_line")
