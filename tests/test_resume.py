import json

import pytest
from pyspark.sql import functions as F

from voxweave.operators import requests as Q
from voxweave.operators import resume as E


def find(spark, anchor, keys):
    anchors = spark.createDataFrame([("s", k, i, len(anchor)) for i, k in enumerate(anchor)], "source string, key string, step int, steps int")
    rows = spark.createDataFrame([("s", i, k) for i, k in enumerate(keys)] + [("other", 0, anchor[0])], "source string, raw_index long, key string")
    return E.anchor_sequence_search(anchors, rows, span=4).first().resume_raw_index


@pytest.mark.parametrize(
    "anchor,keys,want",
    [
        ("AB", "XYZ", None),
        ("AB", "XABY", 3),
        ("AB", "ABXAB", 5),
        ("AAB", "AAAB", 4),
        ("AA", "AAA", 3),
        ("A", "BBA", 3),
        ("ABC", "ABAC", None),
        ("ABCDE", "ABCDEFGABCD", 5),
    ],
)
def test_anchor_search(spark, anchor, keys, want):
    assert find(spark, list(anchor), list(keys)) == want


def test_null_keys_do_not_interrupt_a_match(spark):
    assert find(spark, ["A", "B"], ["A", None, None, "B", "C"]) == 4


def test_tail_anchors_use_the_newest_source(spark):
    rows = [("a", "one", 0), ("b", "two", 1), ("b", "<x>", 2), ("b", "three", 3), ("b", None, 4)]
    df = spark.createDataFrame(rows, "source string, text string, row_index long").withColumns(
        {"speaker": F.lit(None).cast("string"), "language": F.lit("ja"), "file_name": F.lit("part-00000.parquet")}
    )
    tail = E.tail_rows(df, 4, ["source", "text", "transcript", "speaker", "language"])
    got = sorted((r.step, r.key, r.source, r.steps) for r in E.tail_anchors(tail, 5).collect())
    assert got == [(0, "two||||japanese", "b", 2), (1, "three||||japanese", "b", 2)]


def test_cursor(spark):
    df = spark.createDataFrame([(s, i) for s in "abcz" for i in range(4)], "source string, raw_index long")
    got = sorted((r.source, r.raw_index) for r in E.resume_from_cursor(df, ["b", "a", "c"], "a", 2).collect())
    assert got == [("a", 2), ("a", 3), ("c", 0), ("c", 1), ("c", 2), ("c", 3)]
    assert E.resume_from_cursor(df, ["b", "a", "c"], "gone", 2).count() == 12
    assert E.resume_from_cursor(df, ["a"], "a", 3, "test", "split", {"a": "train"}).count() == 4


def reconciled(spark, mode, state, rows):
    df = spark.createDataFrame([(mode, None if state is None else json.dumps(state), rows)], "mode string, state_json string, rows_on_disk long")
    r = E.reconcile_state(df).first()
    return r.resume_from, r.cursor_name, r.cursor_raw_index


CURSOR = {"name": "a", "split": "train", "raw_index": 7}


def test_reconcile(spark):
    same = {"rows_written": 10, "next_index": 12, "cursor": CURSOR}
    assert reconciled(spark, "dataset", same, 10) == (12, "a", 7)
    assert reconciled(spark, "file", same, 10) == (12, "a", 7)
    # State ahead of, or behind, what is on disk.
    assert reconciled(spark, "dataset", same, 8) == (12, None, None)
    assert reconciled(spark, "dataset", same, 15) == (15, None, None)
    assert reconciled(spark, "file", same, 8) == (8, None, None)
    assert reconciled(spark, "dataset", same, 0) == (0, None, None)
    assert reconciled(spark, "file", same, None) == (0, "a", 7)
    assert reconciled(spark, "dataset", None, 5) == (5, None, None)
    assert reconciled(spark, "dataset", {"dataset_cursor": CURSOR}, 5) == (5, "a", 7)
    assert reconciled(spark, "dataset", {"cursor": {"name": "a"}}, 5) == (5, None, None)
    assert reconciled(spark, "dataset", {"cursor": {"name": "", "split": "x"}}, 5) == (5, None, None)


def test_unknown_cursor_is_ignored(spark):
    df = spark.createDataFrame([("dataset", json.dumps({"cursor": CURSOR}), 5)], "mode string, state_json string, rows_on_disk long")
    valid = spark.createDataFrame([("a", "test")], "name string, split string")
    assert E.reconcile_state(df, valid).first().cursor_name is None


def test_done_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 1, None)], "source string, raw_index long, k string")
    done = df.where("raw_index = 1")
    assert [tuple(r)[:2] for r in E.anti_join_done(df, done, ["source", "raw_index"]).collect()] == [("a", 2)]
    assert E.anti_join_done(df, done, ["source", "raw_index"], hashed=True).count() == 1


def test_broadcast_scalars(spark):
    texts = spark.createDataFrame([(i, f"t{i}") for i in range(3)], "position long, text string")
    one = spark.createDataFrame([(0, "en")], "position long, language string")
    three = spark.createDataFrame([(i, f"l{i}") for i in range(3)], "position long, language string")
    assert [r.language for r in Q.broadcast_scalars(texts, one).orderBy("position").collect()] == ["en"] * 3
    assert [r.language for r in Q.broadcast_scalars(texts, three).orderBy("position").collect()] == ["l0", "l1", "l2"]
    with pytest.raises(Exception, match="batch size mismatch"):
        Q.broadcast_scalars(texts, three.limit(2)).collect()


def test_defaults_follow_the_key_not_the_value(spark):
    user = spark.createDataFrame([(1, {"top_k": "7", "top_p": None})], "request_id int, params map<string,string>")
    stored = spark.createDataFrame([({"top_p": "0.5", "temperature": None},)], "defaults map<string,string>")
    got = {r.name: r.value for r in Q.merge_defaults(user, stored).collect()}
    assert got["top_k"] == "7" and got["top_p"] == "0.5" and got["temperature"] is None and got["max_new_tokens"] == "2048"
    assert len(got) == 10


def test_reference_audio_small_and_salted(spark):
    items = spark.createDataFrame([(i, "hot" if i % 10 else "cold") for i in range(50)] + [(99, "gone")], "id long, ref_audio string")
    refs = spark.createDataFrame([("hot", b"12"), ("cold", b"1")], "ref_audio string, bytes binary")
    small = Q.join_reference_audio(items, refs)
    salted = Q.join_reference_audio(items, refs, limit_bytes=1, salt_by="id")
    key = lambda df: sorted((r.id, r.ref_audio, r.bytes and bytes(r.bytes)) for r in df.collect())
    assert key(small) == key(salted) and small.count() == 51


def test_pairs_need_both_sides(spark):
    df = spark.createDataFrame([(1, True, [1]), (1, False, [2]), (2, True, [3])], "prompt int, ok boolean, codes array<int>")
    got = Q.pair_preferences(df, ["prompt"], "ok", ["codes"]).collect()
    assert [(r.prompt, r.chosen_codes, r.rejected_codes) for r in got] == [(1, [1], [2])]


def test_fetch_plan_delays(spark):
    rows = spark.createDataFrame([(0, "http://h/a.wav"), (1, ""), (2, None), (3, "http://h/b.wav"), (4, "http://h/")], "index int, url string")
    have = spark.createDataFrame([("0_a.wav", 5), ("3_b.wav", 0)], "name string, size int")
    got = {r["index"]: r for r in E.fetch_plan(rows, have, 4, 1.5).collect()}
    assert sorted(got) == [3, 4] and got[3].delays == [1.5, 3.0, 6.0] and got[4].name == "4_arknights_4.wav"
    assert E.fetch_plan(rows, have, 0).first().attempts == 1


def test_fetch_retries(spark):
    from voxweave.operators.synthesis import fetch_files

    rows = spark.createDataFrame([(0, "http://h/a"), (1, "http://h/bad")], "index int, url string")
    have = spark.createDataFrame([], "name string, size int")

    def get(url):
        if "bad" in url:
            raise OSError("no")
        return b"ok"

    got = {r.name: r for r in fetch_files(E.fetch_plan(rows, have, 3, 0.0), get).collect()}
    assert bytes(got["0_a"].content) == b"ok" and got["0_a"].tries == 1
    assert got["1_bad"].content is None and got["1_bad"].tries == 3
