"""Ids of texts leave a Python task in bounded parts, whatever the Arrow batch holds."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from voxweave.functions import batches as B
from voxweave.llm import kernels as K
from voxweave.operators import sequences as S
from voxweave.operators import synthesis as Y
from voxweave.session import ARROW_BYTES, ARROW_LIMIT, small_batches

LONG = [None, "ab" * 300_000, "é\U0001f600" * 200_000, "", "x\0y", "z" * 700_000]


def test_slices_cover_all_rows():
    got = list(B.text_slices(pa.array(LONG), 1 << 20))
    assert len(got) > 1 and [i for a, n in got for i in range(a, a + n)] == list(range(len(LONG)))
    assert list(B.text_slices(pa.array([], pa.string()))) == []
    assert list(B.text_slices(pa.array([None, None], pa.string()))) == [(0, 2)]


def test_code_points_leave_in_parts():
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(LONG))), pa.array(LONG)], names=["id", "text"])
    out = list(S._code_points(1, "ids", np.array([1, 2], np.int32), np.array([3], np.int32))(iter([batch])))
    assert max(b.num_rows for b in out) < len(LONG)
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["id"] for r in rows] == list(range(len(LONG)))
    for r, text in zip(rows, LONG):
        assert r["ids"] == (None if text is None else [1, 2, *[ord(c) for c in text if c != "\0"], 3])


def test_batches_of_texts_end_by_bytes(spark, monkeypatch):
    def sizes(at, into, head, tail):
        def run(batches):
            for b in batches:
                ids = pa.array([[b.nbytes]] * b.num_rows, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*b.schema.names, into])

        return run

    monkeypatch.setattr(S, "_code_points", sizes)
    texts = spark.newSession().range(6000).select(F.repeat(F.lit("x"), 3000).alias("text")).coalesce(1)
    got = S.code_point_ids(texts, "text", "ids").select(F.col("ids")[0].alias("bytes")).collect()
    assert len(got) == 6000 and max(r.bytes for r in got) < 2 * ARROW_BYTES


def test_token_ids_leave_in_parts():
    out = list(Y._token_ids(Y.code_points)(iter([pa.array(LONG)])))
    assert len(out) > 1 and [x for part in out for x in part.to_pylist()] == [None if t is None else [ord(c) for c in t] for t in LONG]


def test_token_ids_stay_beside_their_rows(spark):
    data = [(i, None if i % 7 == 3 else chr(97 + i % 26) * (i % 5 * 60_000)) for i in range(60)]
    rows = spark.createDataFrame(data, "id int, text string").coalesce(1)
    got = rows.select("id", F.size(Y.tokenize_udf(Y.code_points)("text")).alias("n")).collect()
    size = {r.id: r.n for r in got}
    assert all((t is None and size[i] in (None, -1)) or size[i] == len(t) for i, t in data) and len(got) == 60


def test_arrow_batches_are_bounded_and_an_own_limit_stays(spark):
    own = spark.newSession()
    small_batches(own)
    assert int(own.conf.get(ARROW_LIMIT)) == ARROW_BYTES
    sizes = own.range(6000).select(F.repeat(F.lit("x"), 3000).alias("t")).coalesce(1).mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long"
    )
    assert max(r.n for r in sizes.collect()) < 2 * ARROW_BYTES
    own.conf.set(ARROW_LIMIT, "1m")
    small_batches(own)
    assert own.conf.get(ARROW_LIMIT) == "1m"


def test_given_back_tables_are_made_again():
    words = K.words(*K.utf8(pa.array(["one two three", "x" * (K.BLOCK + 5) + " y"])))
    assert K.cache()
    K.give_back()
    assert not K.cache()
    again = K.words(*K.utf8(pa.array(["one two three", "x" * (K.BLOCK + 5) + " y"])))
    assert (words.hash == again.hash).all()
