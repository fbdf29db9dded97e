"""Numbered parts: commits, broken writes, footers, tails, concatenation, and the cursor in the jobs."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from voxweave import jobs
from voxweave.sources import parts as P
from voxweave.sources import readers as D
from voxweave.sources import writers as W


def numbers(spark, a, b, files=1):
    rows = spark.range(a, b).select(F.col("id").alias("raw_index"), F.concat(F.lit("t"), F.col("id")).alias("text"), F.array(F.col("id")).alias("codes"))
    return rows.repartitionByRange(files, "raw_index").sortWithinPartitions("raw_index")


def names(folder):
    return sorted(os.path.basename(p) for p in glob.glob(folder + "/*.parquet"))


def test_parts_go_on_after_the_last_number(spark, folder):
    W.sink_parquet(numbers(spark, 0, 30, 3), folder)
    W.sink_parquet(numbers(spark, 30, 50, 2), folder, append=True, note={"by": "x"})
    W.sink_parquet(numbers(spark, 50, 50), folder, append=True)  # no rows, no file
    W.sink_parquet(numbers(spark, 50, 57), folder, append=True, rows_per_file=3)
    assert names(folder) == [f"part-{k:05d}.parquet" for k in range(8)]
    got = D.with_global_row(D.scan_parquet_parts(spark, folder)).orderBy("global_row").collect()
    assert [r.raw_index for r in got] == list(range(57))
    kept = P.commits(spark, folder)
    assert [len(c["parts"]) for c in kept] == [3, 2, 0, 3] and kept[1]["note"] == {"by": "x"}
    assert [n for _, n in kept[3]["parts"]] == [3, 3, 1]


def test_no_rows_still_leave_a_schema(spark, folder):
    W.sink_parquet(numbers(spark, 0, 0), folder)
    assert names(folder) == ["part-00000.parquet"] and spark.read.parquet(folder).columns == ["raw_index", "text", "codes"]


def test_a_write_that_dies_shows_nothing(spark, folder, monkeypatch):
    W.sink_parquet(numbers(spark, 0, 5), folder)
    with pytest.raises(Exception):
        W.sink_parquet(numbers(spark, 5, 9).withColumn("text", F.raise_error(F.lit("stop")).cast("string")), folder, append=True)
    assert spark.read.parquet(folder).count() == 5

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(P, "commit", dies)  # after the files were written
    for replace in (False, True):
        with pytest.raises(KeyboardInterrupt):
            P.write_parts(numbers(spark, 5, 9), folder, replace)
    monkeypatch.undo()
    assert spark.read.parquet(folder).count() == 5 and names(folder) == ["part-00000.parquet"]
    W.sink_parquet(numbers(spark, 5, 6), folder, append=True)
    assert not glob.glob(folder + "/_staged-*") and D.scan_parquet_parts(spark, folder).count() == 6


@pytest.mark.parametrize("replace", [False, True])
@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_commit_that_breaks_off_is_carried_to_its_end(spark, folder, monkeypatch, moves, replace):
    W.sink_parquet(numbers(spark, 0, 5, 2), folder)
    done, move = [], P._Store.move

    def breaks(self, source, target):
        if target.startswith("part-"):
            if len(done) == moves:
                raise OSError("gone")
            done.append(target)
        move(self, source, target)

    monkeypatch.setattr(P._Store, "move", breaks)
    with pytest.raises(OSError):
        P.write_parts(numbers(spark, 5, 14, 3), folder, replace)
    monkeypatch.undo()
    got = sorted(r.raw_index for r in D.scan_parquet_parts(spark, folder).collect())  # a reader ends it
    assert got == list(range(5 if replace else 0, 14))
    assert names(folder) == [f"part-{k:05d}.parquet" for k in range(3 if replace else 5)]
    W.sink_parquet(numbers(spark, 14, 15), folder, append=True)
    assert len(P.commits(spark, folder)) == (2 if replace else 3)


def test_footers_and_equal_names_in_two_folders(spark, folder):
    for where, a, b in (("a", 0, 40), ("b", 40, 70)):
        numbers(spark, a, b, 2).write.option("parquet.block.size", 64).option("parquet.page.size", 64).parquet(f"{folder}/{where}x")
        W.sink_parquet(spark.read.parquet(f"{folder}/{where}x").coalesce(1).sortWithinPartitions("raw_index"), f"{folder}/p/{where}")
    listed = P.footers(spark, f"{folder}/p", recursive=True)
    want = {p: pq.ParquetFile(p).metadata for p in glob.glob(f"{folder}/p/*/*.parquet")}
    assert listed.agg(F.sum("n_rows")).first()[0] == 70 and listed.count() == sum(m.num_row_groups for m in want.values())
    rows = D.scan_parquet_parts(spark, f"{folder}/p", recursive=True)
    for source in (listed, None):
        got = D.with_global_row(rows, listed=source).orderBy("global_row").collect()
        assert [(r.raw_index, r.global_row) for r in got] == [(i, i) for i in range(70)]


def test_files_without_footers_in_tasks(spark, folder, monkeypatch):
    W.sink_parquet(numbers(spark, 0, 20, 2), folder)
    monkeypatch.setattr(P, "openable", lambda _: False)
    listed = P.footers(spark, folder).orderBy("part").collect()
    assert sum(r.n_rows for r in listed) == 20 and {r.row_group for r in listed} == {-1}
    assert [r.raw_index for r in P.tail_of_parts(spark, folder, 7, ["raw_index"]).collect()] == list(range(13, 20))
    assert W.merge_shards(folder, folder + "-out", rows_per_file=6) == 20


def grouped(spark, folder, files=4, rows=40):
    """Files of several row groups."""
    os.makedirs(folder)
    for k, part in enumerate(range(0, rows, rows // files)):
        table = numbers(spark, part, part + rows // files).toArrow()
        pq.write_table(table, f"{folder}/part-{k:05d}.parquet", row_group_size=3)


@pytest.mark.parametrize("n", [0, 1, 2, 11, 40, 99])
def test_tail_opens_the_last_row_groups_only(spark, folder, n):
    grouped(spark, folder)
    W.sink_parquet(numbers(spark, 40, 44), folder, append=True)
    listed = P.last_row_groups(P.footers(spark, folder), n).collect()
    assert sum(r.n_rows for r in listed) < n + 4 and sum(r.n_rows for r in listed) >= min(n, 44)
    if n == 2:  # older files may be unreadable
        for k in range(4):
            meta = pq.ParquetFile(f"{folder}/part-{k:05d}.parquet").metadata.row_group(0).column(0)
            with open(f"{folder}/part-{k:05d}.parquet", "r+b") as f:
                f.seek(meta.data_page_offset)
                f.write(b"\xff" * 8)
    got = P.tail_of_parts(spark, folder, n, ["raw_index", "codes", "absent"])
    assert got.columns == ["raw_index", "codes", "file_name", "row_index"]
    assert [(r.raw_index, r.codes) for r in got.collect()] == [(i, [i]) for i in range(max(0, 44 - n), 44)]


def test_concatenation_moves_no_rows(spark, folder, monkeypatch):
    grouped(spark, folder)
    plans = []
    write = P.write_parts
    monkeypatch.setattr(P, "write_parts", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **k))[1])
    assert W.merge_shards(folder, folder + "-out", rows_per_file=9) == 40
    below = plans[0].index("MapInArrow")
    assert "Exchange" not in plans[0][:below]  # only the list of row groups is dealt out
    out = D.with_global_row(D.scan_parquet_parts(spark, folder + "-out")).orderBy("global_row").collect()
    assert [r.raw_index for r in out] == list(range(40)) and len(names(folder + "-out")) == 5
    with pytest.raises(FileExistsError):
        W.merge_shards(folder, folder + "-out")
    with pytest.raises(FileExistsError):
        W.merge_shards(D.scan_parquet_parts(spark, folder), folder + "-out")
    os.makedirs(folder + "-none")
    W.sink_parquet(numbers(spark, 0, 0), folder + "-none")
    assert W.merge_shards(folder + "-none", folder + "-none-out") == 0


def plain(spark, n):
    rows = [(i, f"t {i}", "ja", f"s{i % 2}", bytearray(b"x"), "train", f"org/{i % 2}") for i in range(n)]
    df = spark.createDataFrame(rows, "raw_index long, text string, language string, speaker string, b binary, split string, source string")
    return df.withColumn("audio", F.struct(F.col("b").alias("bytes"), F.lit(None).cast("string").alias("path"))).drop("b")


def test_runs_read_on_from_the_cursor(spark, folder):
    stored = folder + "-in"
    for n in (6, 15, 15):
        plain(spark, n).write.mode("overwrite").parquet(stored)
        rows = spark.read.parquet(stored)
        rest = jobs.remaining(rows, folder)
        jobs._store(rest, rest, folder, None)
    assert sorted(r.raw_index for r in spark.read.parquet(folder).collect()) == list(range(15))
    assert jobs.cursor(spark, folder) == {("org/0", "train"): 15, ("org/1", "train"): 14}
    plan = jobs.remaining(spark.read.parquet(stored), folder)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "GreaterThanOrEqual(raw_i" in plan.split("PushedFilters")[1]


def test_rejects_are_retried_when_asked(spark, folder):
    rows = plain(spark, 10)
    done = rows.where("raw_index % 3 > 0")
    jobs._store(done, rows, folder, None)
    jobs.list_rejects(rows, folder, reason="out of memory")
    assert jobs.remaining(rows, folder).count() == 0 == jobs.remaining(rows, folder, whole=True).count()
    for whole in (False, True):
        again = jobs.remaining(rows, folder, whole=whole, retry=("out of memory",))
        assert sorted(r.raw_index for r in again.collect()) == [0, 3, 6, 9]
    assert jobs.remaining(rows, folder, retry=("other",)).count() == 0


def test_outputs_without_notes_are_compared_by_key(spark, folder):
    rows = plain(spark, 8)
    rows.where("raw_index in (1, 5)").write.parquet(folder)
    assert jobs.cursor(spark, folder) is None and jobs.remaining(rows, folder).count() == 6
    W.sink_parquet(rows.where("raw_index = 2"), folder, append=True)
    assert jobs.cursor(spark, folder) is None and jobs.remaining(rows, folder).count() == 5


def test_shards_of_stored_size(spark, folder):
    """Rows that compress well: shards are as large on disk as asked, not as large as estimated."""
    df = spark.range(0, 40000).select(F.col("id").alias("raw_index"), F.concat(F.lit("the same words again and again "), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    limit = 400_000
    for stored in (False, True):
        names = W.shard_by_size(df, f"{folder}-{stored}", "train", ["raw_index"], F.floor(F.col("raw_index") / 5000), limit, 500, stored=stored)
        sizes = [os.path.getsize(n) for n in names]
        assert all(0.85 * limit < x < 1.15 * limit for x in sizes[:-1]) == stored and len(sizes) > 2
        assert spark.read.parquet(*names).count() == 40000
    assert not glob.glob(f"{folder}-True/_*")
