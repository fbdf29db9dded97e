"""Legal input off the beaten path: nulls, ragged rows, repeated keys, sparse ids, session settings."""

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voxweave import jobs
from voxweave.operators import cleaning, clips, ordering, quantize, requests, resume, synthesis
from voxweave.sources import readers, writers


def test_encoder_and_decoder_run_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def encoder(batch: pd.DataFrame) -> list:
        calls.add(len(batch))
        return [None if i % 5 == 0 else [[1]] for i in range(len(batch))]

    rows = spark.range(100).select("id", F.array(F.lit(0.5), F.lit(0.1)).alias("samples"), F.lit(24000).alias("rate"))
    coded = synthesis.attach_codes(rows, encoder, inputs=["samples"])
    assert 0 < coded.count() < 100 and calls.value == 100
    plan = clips.decode_clips(clips.encode_clips(rows)).where(~F.col("undecodable"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("decoded(") == 1
    assert plan.count() == 100


def test_every_job_step_runs_once(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def encoder(batch: pd.DataFrame) -> list:
        calls.add(len(batch))
        return [[[len(s)]] for s in batch["samples"]]

    rows = spark.range(40).select("id", F.array(F.lit(0.5), F.lit(0.1)).cast("array<double>").alias("samples"), F.lit(16000).alias("rate"))
    heard = clips.encode_clips(rows).select("id", F.struct("bytes").alias("audio"))
    assert jobs.encoded(heard, encoder).count() == 40
    assert calls.value == 40


def test_second_run_encodes_nothing(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def encoder(batch: pd.DataFrame) -> list:
        calls.add(len(batch))
        return [None if len(batch) % 2 else [[1]] for _ in range(len(batch))]

    good = clips.encode_clips(spark.range(20).select(F.col("id").alias("raw_index"), F.array(F.lit(0.5), F.lit(0.1)).alias("samples"), F.lit(24000).alias("rate")))
    rows = good.select("raw_index", F.lit("s").alias("source"), F.lit(None).cast("string").alias("split"),
                       F.struct(F.when(F.col("raw_index") % 4 > 0, F.col("bytes")).otherwise(F.lit(b"broken")).alias("bytes")).alias("audio"))
    rows.write.parquet(folder)
    jobs.attach_codes(spark, folder, folder + "-out", encoder)
    first = calls.value
    assert first == 15
    n = spark.read.parquet(folder + "-out").count()
    assert n + spark.read.parquet(jobs.rejects_folder(folder + "-out")).count() == 20
    jobs.attach_codes(spark, folder, folder + "-out", encoder)
    assert calls.value == first and spark.read.parquet(folder + "-out").count() == n


def test_shards_keep_all_rows(spark, folder):
    rows = spark.range(100).select("id", F.lit("x" * 20).alias("t"))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
    try:
        names = writers.shard_by_size(rows, folder, "train", ["id"], limit_bytes=1000, block_rows=10)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert [r.id for n in names for r in spark.read.parquet(n).collect()] == list(range(100))
    with pytest.raises(FileExistsError):
        writers.shard_by_size(rows, folder, "train", ["id"])


def test_merge_by_bytes(spark, folder):
    rows = spark.range(100).select("id", F.lit("x" * 50).alias("t"))
    rows.repartition(5).write.parquet(folder)
    parts = readers.scan_parquet_parts(spark, folder)
    assert writers.merge_shards(parts, folder + "-out", bytes_per_file=2000) == 100
    merged = readers.with_global_row(readers.scan_parquet_parts(spark, folder + "-out"))
    want = [r.id for r in parts.orderBy("file_name", "row_index").collect()]
    assert [r.id for r in merged.orderBy("global_row").collect()] == want
    assert merged.select("file_name").distinct().count() > 1


@pytest.mark.parametrize("limit", [1 << 20, 1])
def test_decoding_ragged_rows(spark, limit):
    books = spark.createDataFrame([(s, c, [10.0**s * c, 1.0]) for s in range(3) for c in (1, 2)], "stage int, code int, vec array<double>")
    rows = spark.createDataFrame([(1, [1]), (2, [2, 1, 1]), (3, []), (4, None)], "id int, codes array<int>")
    got = {r.id: r.decoded for r in quantize.rvq_decode(rows, books, key=["id"], limit_bytes=limit).collect()}
    assert got == {1: [1.0, 1.0], 2: [112.0, 3.0], 3: [0.0, 0.0], 4: None}
    unknown = spark.createDataFrame([(1, [1, 7])], "id int, codes array<int>")
    with pytest.raises(PySparkException, match="has no word 7"):
        quantize.rvq_decode(unknown, books, key=["id"], limit_bytes=limit).collect()


@pytest.mark.parametrize("limit", [1 << 20, 1])
def test_null_vectors(spark, limit):
    book = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 1.0])], "code int, vec array<double>")
    rows = spark.createDataFrame([(1, [0.9, 0.9]), (2, None), (3, [0.1, 0.0])], "id int, vec array<double>")
    got = {r.id: r.nearest and r.nearest.code for r in quantize.nearest_codeword_join(rows, book, limit_bytes=limit).collect()}
    assert got == {1: 1, 2: None, 3: 0}
    coded = quantize.rvq_encode(rows, book.withColumn("stage", F.lit(0)), limit_bytes=limit)
    assert {r.id: r.codes for r in coded.collect()} == {1: [1], 2: None, 3: [0]}
    ragged = spark.createDataFrame([(1, [0.9, 0.9]), (2, [1.0])], "id int, vec array<double>").coalesce(1)
    with pytest.raises(PySparkException, match="unequal length"):
        quantize.nearest_codeword_join(ragged, book).collect()


def test_positions_with_nulls_and_sparse_ids(spark):
    rng = np.random.default_rng(1)
    ids = [int(x) for x in rng.integers(-(1 << 62), 1 << 62, 300)]
    rows = spark.createDataFrame([("a", i) for i in ids] + [("a", None), (None, 3), (None, 1)], "source string, raw_index long")
    got = ordering.fixed_batches(rows, 32).collect()
    assert len(got) == 303
    a = sorted((r.batch * 32 + r.slot, r.raw_index) for r in got if r.source == "a")
    assert [p for p, _ in a] == list(range(301)) and [i for _, i in a] == [*sorted(ids), None]
    assert sorted((r.slot, r.raw_index) for r in got if r.source is None) == [(0, 1), (1, 3)]


def test_user_parameters_pass(spark):
    user = spark.createDataFrame([(1, {"my_extra": "7"}), (2, None)], "request_id int, params map<string,string>")
    file = spark.createDataFrame([({"top_k": "5"},)], "defaults map<string,string>")
    got = {(r.request_id, r.name): r.value for r in requests.merge_defaults(user, file).collect()}
    assert got[1, "my_extra"] == "7" and (2, "my_extra") not in got


def test_repeated_preference_is_an_error(spark):
    rows = spark.createDataFrame([(1, True, "x", 1), (1, True, "y", 2), (1, False, "z", 3)], "k int, good boolean, t string, n int")
    with pytest.raises(PySparkException, match="more than one row"):
        requests.pair_preferences(rows, ["k"], "good", ["t", "n"]).collect()
    one = requests.pair_preferences(rows.where("t <> 'y'"), ["k"], "good", ["t", "n"]).first()
    assert (one.chosen_t, one.chosen_n, one.rejected_t, one.rejected_n) == ("x", 1, "z", 3)


def test_rate_zero(spark):
    rows = spark.createDataFrame([(1, 100, 0), (2, 100, 100)], "id int, frames int, rate int")
    assert [r.id for r in cleaning.filter_max_duration(rows, 5.0, "frames", "rate").collect()] == [2]
    heard = spark.createDataFrame([([0.1, 0.2], 0)], "samples array<double>, rate int")
    assert clips.clip_report(heard).first().seconds is None


def test_null_split_is_done_only_once(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", "train", 2), ("b", None, 3)], "source string, split string, raw_index int")
    assert resume.anti_join_done(rows, rows.limit(3), ["source", "split", "raw_index"]).count() == 0
