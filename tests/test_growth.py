"""Steps whose tasks must not grow with the input."""

from pyspark.sql import functions as F

from voxweave.operators import ordering as O
from voxweave.operators import sequences as S
from voxweave.plans import inputs as I
from voxweave.plans import storage_queries as Q


def test_a_cap_drops_rows_before_they_are_sent(spark):
    data = [(s, i // 3 if i % 10 else None, f"{s}{i}") for s in ("a", "b", None) for i in range(200)]
    rows = spark.createDataFrame(data, "source string, raw_index long, text string")
    capped = O.cap_per_source(rows, 25)
    assert "WindowGroupLimit" in capped._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r.source or "", r.raw_index) for r in capped.collect()))
    first = sorted((i for _, i, _ in data[:200]), key=lambda i: (i is None, i))[:25]
    assert got == sorted((s, i) for s in ("", "a", "b") for i in first)
    whole = O.cap_per_source(rows, 195).groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("raw_index").isNull()).alias("none"))
    assert {(r.n, r.none) for r in whole.collect()} == {(195, 15)}


def test_many_rows_go_into_more_parts(spark):
    rows = spark.range(0, 20_000, 1, 8).withColumnRenamed("id", "raw_index")
    dealt = Q._ranges(rows, 4)
    assert dealt.rdd.getNumPartitions() == 8 and Q._ranges(rows.where("raw_index >= 19900"), 1).rdd.getNumPartitions() == 1
    assert [r.raw_index for r in dealt.collect()] == list(range(20_000))


def test_a_stream_is_fed_with_more_files(spark):
    class Done:
        def awaitTermination(self):
            pass

    seen = []

    def run(folder, schema, checkpoint):
        names = spark.read.parquet(folder).select("raw_index", F.col("_metadata.file_name").alias("f"))
        seen.append((names.count(), names.select("f").distinct().count()))
        return Done()

    Q._in_two_runs(spark, None, "fed", run, spark.range(0, 8000, 1, 16).withColumnRenamed("id", "raw_index"))
    assert [n for n, _ in seen] == [4000, 8000] and seen[0][1] >= 8 and seen[1][1] >= 16


def test_text_of_masks_and_matrix_is_that_of_the_arrays(spark):
    data = [(i, i % 3, [10 + k for k in range(lt)], [[100 * t + q for q in range(16)] for t in range(lc)]) for i, (lt, lc) in enumerate((a, b) for a in range(3, 8) for b in range(4))]
    data += [(100, 1, None, [[1] * 16]), (101, 2, [1, 2, 3], None), (102, 0, [1, 2, 3], [[None] * 16, [5] * 16])]
    rows = spark.createDataFrame(data, "id int, batch int, text_ids array<int>, codes array<array<int>>")
    masks = ["attention_mask", "text_embedding_mask", "codec_embedding_mask", "codec_mask"]
    arrays = S.assemble_sequences(rows, "text_ids", "codes", ["batch"], {*masks, "code_matrix"})
    shown = arrays.select("id", *[I.show_flags(m).alias(m) for m in masks], I.show_rows("code_matrix").alias("code_matrix"))
    texts = S.assemble_sequences(rows, "text_ids", "codes", ["batch"], {*masks, "code_matrix"}, as_text=True).select(shown.columns)
    assert sorted(texts.collect(), key=lambda r: r.id) == sorted(shown.collect(), key=lambda r: r.id)
