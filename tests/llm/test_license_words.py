"""Words and word pairs of licence paragraphs."""

from voxweave.llm import licenses as L


def test_words_and_pairs(spark):
    from pyspark.sql import functions as F

    data = [(0, ""), (1, " - "), (2, "One"), (3, "  a, B;c "), (4, "x x x")]
    rows = spark.createDataFrame(data, "id int, paragraph string").withColumn("w", L._words(F.col("paragraph")))
    got = {r.id: (r.w, r.p) for r in rows.select("id", "w", L._pairs("w").alias("p")).collect()}
    assert got == {0: ([], []), 1: ([], []), 2: (["one"], []), 3: (["a", "b", "c"], ["a b", "b c"]), 4: (["x"] * 3, ["x x"] * 2)}
