import glob
import os

import pytest
from pyspark.sql import functions as F

from voxweave.operators import reports as R
from voxweave.session import shared_folder
from voxweave.sources import readers as D
from voxweave.sources import writers as W
from voxweave.streaming import incremental as T

SCHEMA = "raw_index long, source string, text string"


def rows(spark, a, b):
    return spark.range(a, b).select(F.col("id").alias("raw_index"), F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("source"), F.lit("é x").alias("text"))


def test_sink_refuses_then_overwrites_and_appends(spark, folder):
    W.sink_parquet(rows(spark, 0, 5), folder)
    with pytest.raises(FileExistsError):
        W.sink_parquet(rows(spark, 0, 5), folder)
    W.sink_parquet(rows(spark, 5, 7), folder, append=True)
    assert spark.read.parquet(folder).count() == 7
    with pytest.raises(W.SchemaMismatch, match="text"):
        W.sink_parquet(rows(spark, 0, 1).withColumn("text", F.lit(1)), folder, append=True)
    with pytest.raises(W.SchemaMismatch):
        W.sink_parquet(rows(spark, 0, 1).withColumn("more", F.lit(1)), folder, append=True)
    W.sink_parquet(rows(spark, 0, 2), folder, overwrite=True)
    assert spark.read.parquet(folder).count() == 2


def test_jsonl(spark, folder):
    os.makedirs(folder)
    with open(f"{folder}/m.jsonl", "w") as f:
        f.write('{"audio": "a.wav", "text": "é", "ref_audio": "r.wav"}\n\n{"audio": "b.wav", "text": null, "language": "ja"}\n')
    got = D.scan_jsonl_manifest(spark, folder).orderBy("audio").collect()
    assert [(r.audio, r.text, r.language) for r in got] == [("a.wav", "é", "Auto"), ("b.wav", None, "ja")]
    with open(f"{folder}/z.jsonl", "w") as f:
        f.write('{"audio": "a.wav", \n')
    with pytest.raises(Exception):
        D.scan_jsonl_manifest(spark, folder).collect()
    W.sink_jsonl(rows(spark, 0, 1).withColumn("nothing", F.lit(None).cast("string")), folder + "-out")
    body = "".join(open(p, encoding="utf-8").read() for p in glob.glob(folder + "-out/part-*"))
    assert body == '{"raw_index":0,"source":"s0","text":"é x","nothing":null}\n'


def test_numbered_parts_and_global_rows(spark, folder):
    os.makedirs(folder)
    for n, (a, b) in {0: (0, 3), 7: (3, 4), 10: (4, 9)}.items():
        one = f"{folder}-{n}"
        rows(spark, a, b).coalesce(1).write.parquet(one)
        os.link(glob.glob(one + "/part-*.parquet")[0], f"{folder}/part-{n:05d}.parquet")
    os.link(glob.glob(f"{folder}-0/part-*.parquet")[0], f"{folder}/other.parquet")
    parts = D.scan_parquet_parts(spark, folder)
    got = D.with_global_row(parts).orderBy("global_row").collect()
    assert [r.raw_index for r in got] == list(range(9)) == [r.global_row for r in got]
    assert D.next_part(parts).first().next_part == 11
    assert D.next_part(parts.limit(0)).first().next_part == 0
    assert D.scan_parquet_parts(spark, folder, pattern=None).count() == 12
    expected = spark.createDataFrame([("part-00007.parquet",), ("absent",)], "file_name string")
    assert {r.file_name: r.n_rows for r in R.rows_per_file(parts, expected).collect()} == {"part-00007.parquet": 1, "absent": 0}


def test_shards_hold_all_rows_in_order(spark, folder):
    df = rows(spark, 0, 100).repartition(4)
    size = (F.lit(8) + 2 + 4).cast("long")
    total = sum(1 for _ in range(100))
    paths = W.shard_by_size(df, folder, "train", ["raw_index"], F.floor(F.col("raw_index") / 16), 300, 10)
    assert [os.path.basename(p) for p in paths] == [f"train-{i:05d}-of-{len(paths):05d}.parquet" for i in range(len(paths))]
    read = [[r.raw_index for r in spark.read.parquet(p).collect()] for p in paths]
    assert sum(read, []) == list(range(total))
    # A block of 10 rows weighs 140 bytes, so a shard closes after its third block.
    assert [len(x) for x in read] == [30, 30, 30, 10]
    plan = W.shard_plan(df, ["raw_index"], F.floor(F.col("raw_index") / 16), 280, 10, size)
    assert [r["count"] for r in plan.groupBy("shard").count().orderBy("shard").collect()] == [20] * 5
    huge = W.shard_plan(df, ["raw_index"], F.floor(F.col("raw_index") / 16), 1, 10, size)
    assert huge.select("shard").distinct().count() == 10


def test_no_rows_still_give_one_shard(spark, folder):
    paths = W.shard_by_size(rows(spark, 0, 0), folder, "train", ["raw_index"], None, 300, 10)
    assert [os.path.basename(p) for p in paths] == ["train-00000-of-00001.parquet"]
    assert spark.read.parquet(paths[0]).columns == ["raw_index", "source", "text"]


@pytest.mark.parametrize("per_file", [10, 1000])
def test_merge_keeps_order(spark, folder, per_file):
    rows(spark, 0, 57).repartitionByRange(5, "raw_index").sortWithinPartitions("raw_index").write.parquet(folder)
    out = folder + "-merged"
    assert W.merge_shards(D.scan_parquet_parts(spark, folder), out, per_file) == 57
    got = D.with_global_row(D.scan_parquet_parts(spark, out)).orderBy("global_row").collect()
    assert [r.raw_index for r in got] == list(range(57))
    assert (len(glob.glob(out + "/*.parquet")) == 1) == (per_file == 1000)


def test_binary_files(spark, folder):
    os.makedirs(folder + "/sub")
    open(folder + "/a.wav", "wb").write(b"1")
    open(folder + "/sub/b.wav", "wb").write(b"22")
    files = D.scan_binary_audio(spark, folder, "*.wav")
    df = spark.createDataFrame([(folder + "/a.wav",), (folder + "/gone.wav",), (folder + "/sub/b.wav",)], "path string")
    got = [r.bytes and bytes(r.bytes) for r in D.join_audio_bytes(df, files, "path").orderBy("path").collect()]
    assert got == [b"1", None, b"22"]


def upper(df):
    return df.withColumn("text", F.upper("text"))


def test_runs_of_a_stream_equal_one_run(spark, folder):
    out, state = folder + "-out", folder + "-state"
    schema = rows(spark, 0, 1).schema
    for k in range(3):
        rows(spark, 10 * k, 10 * k + 10).repartition(2).write.mode("append").parquet(folder)
        T.stream_prepare(T.new_rows(spark, folder, schema, 1), upper, out, state).awaitTermination()
    got = spark.read.schema(schema).parquet(out)
    assert sorted(r.raw_index for r in got.collect()) == list(range(30)) and got.first().text == "É X"


def test_a_failed_batch_is_neither_lost_nor_repeated(spark, folder):
    out, state, progress = folder + "-out", folder + "-state", folder + "-progress"
    schema = rows(spark, 0, 1).schema
    for k in range(4):
        rows(spark, 5 * k, 5 * k + 5).coalesce(1).write.mode("append").parquet(folder)
    seen = []

    def fails_once(df):
        seen.append(1)
        if len(seen) == 3:
            # The batch has already written part of its output when it stops.
            df.limit(2).write.mode("overwrite").parquet(f"{out}/batch_id=2")
            raise RuntimeError("stopped")
        return df

    def run():
        T.stream_exactly_once(T.new_rows(spark, folder, schema, 1), fails_once, out, state, progress).awaitTermination()

    with pytest.raises(Exception):
        run()
    run()
    assert sorted(r.raw_index for r in spark.read.parquet(out).collect()) == list(range(20))
    done = spark.read.parquet(progress).groupBy("source").agg(F.sum("n_rows").alias("n"), F.max("next_raw_index").alias("x"))
    assert {r.source: (r.n, r.x) for r in done.collect()} == {"s0": (10, 19), "s1": (10, 20)}


def test_progress_report(spark, folder):
    schema = rows(spark, 0, 1).schema
    for k in range(2):
        rows(spark, 5 * k, 5 * k + 5).coalesce(1).write.mode("append").parquet(folder)
        T.stream_progress(T.new_rows(spark, folder, schema, 1), folder + "-out", folder + "-state").awaitTermination()
    assert {r.source: r.n_rows for r in T.latest_report(spark, folder + "-out").collect()} == {"s0": 5, "s1": 5}


class Named:
    """The little of a session that the folder look-up reads."""

    def __init__(self, master, folder):
        self.conf, self.sparkContext, self.master, self.folder, self.applicationId = self, self, master, folder, master

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default

    def getConf(self):
        return self


def test_the_shared_folder_is_the_configured_one(spark):
    assert shared_folder(Named("yarn", "hdfs:///shared/work/")) == "hdfs:///shared/work"
    with pytest.raises(ValueError):
        shared_folder(Named("yarn", None))
    assert os.path.isdir(shared_folder(spark))


def test_tail_opens_the_newest_files_only(spark, folder):
    from voxweave.operators import resume as E

    rows(spark, 0, 40).repartitionByRange(4, "raw_index").sortWithinPartitions("raw_index").write.parquet(folder)
    parts = D.scan_parquet_parts(spark, folder)
    for n in (1, 7, 10, 11, 40, 99):
        tail = E.tail_rows(parts, n, ["raw_index"], newest_files=True)
        assert sorted(r.raw_index for r in tail.collect()) == list(range(max(0, 40 - n), 40))


def test_predicates_and_columns_reach_the_scan(spark, folder):
    from voxweave.operators import resume as E

    rows(spark, 0, 50).write.parquet(folder)
    df = E.resume_from_cursor(spark.read.parquet(folder), ["s0", "s1"], "s1", 30).select("raw_index")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(raw_index,30)" in plan and "text" not in plan.split("ReadSchema")[1]


def test_profile_cuts_long_values(spark):
    df = spark.createDataFrame([("f", 1, "b"), ("f", 0, "a" * 101), ("g", 0, None)], "file_name string, row_index long, v string")
    got = {r.file_name: (r.n_rows, r.first_value) for r in R.profile_dataset(df, ["v"]).collect()}
    assert got == {"f": (2, "a" * 100 + "..."), "g": (1, None)}
