"""Training layouts for every text length 3..6 and frame count 0..3, written out position by position."""

import itertools
from pathlib import Path

from pyspark.sql import functions as F

from voxweave.functions import arrays as A
from voxweave.operators import sequences as S
from voxweave.session import CODEC

PAD, BOS, EOS = 151671, 151672, 151673
CASES = list(itertools.product(range(3, 7), range(0, 4)))
SCHEMA = "id int, batch int, text_ids array<int>, codes array<array<int>>"


def frame(t):
    return [100 * (t + 1) + q for q in range(16)]


def rows(spark):
    data = [(i, i % 3, [10 + k for k in range(lt)], [frame(t) for t in range(lc)]) for i, (lt, lc) in enumerate(CASES)]
    return spark.createDataFrame(data, SCHEMA)


def expected(lt, lc, width):
    n = lt + lc + 8
    text, codec, labels, matrix = [0] * width, [0] * width, [-100] * width, [[0] * 16 for _ in range(width)]
    for p in range(n):
        if p < 3:
            text[p] = 10 + p
        elif p < 7:
            text[p] = PAD
        elif p == 7:
            text[p] = BOS
        elif p < lt + 5:
            text[p] = 10 + p - 5
        elif p == lt + 5:
            text[p] = EOS
        else:
            text[p] = PAD
    fixed = {3: 4203, 4: 4204, 5: 4205, 6: 0, 7: 4196}
    for p in range(3, n):
        if p in fixed:
            codec[p] = fixed[p]
        elif p <= lt + 5:
            codec[p] = 4196
        elif p == lt + 6:
            codec[p] = 4197
        elif p < lt + 7 + lc:
            codec[p] = labels[p] = frame(p - lt - 7)[0]
            matrix[p] = frame(p - lt - 7)
        else:
            codec[p] = labels[p] = 4198
    att = [p < n for p in range(width)]
    emb = [3 <= p < n and p != 6 for p in range(width)]
    cod = [lt + 7 <= p < lt + 7 + lc for p in range(width)]
    return text, codec, labels, matrix, att, emb, cod


def test_layout(spark):
    out = S.assemble_sequences(rows(spark), "text_ids", "codes", ["batch"]).collect()
    assert len(out) == len(CASES)
    for r in out:
        lt, lc = CASES[r.id]
        width = max(a + b + 8 for i, (a, b) in enumerate(CASES) if i % 3 == r.batch)
        text, codec, labels, matrix, att, emb, cod = expected(lt, lc, width)
        assert r.text_channel == text and r.codec_channel == codec and r.labels == labels
        assert r.code_matrix == matrix and r.attention_mask == att and r.text_embedding_mask == att
        assert r.codec_embedding_mask == emb and r.codec_mask == cod


def test_gather_returns_the_frames(spark):
    laid = S.assemble_sequences(rows(spark), "text_ids", "codes", ["batch"])
    out = S.masked_frame_gather(laid, "id", "codec_mask", "code_matrix").orderBy("id", "position").collect()
    assert [(r.id, r.frame) for r in out] == [(i, frame(t)) for i, (_, lc) in enumerate(CASES) for t in range(lc)]


def test_shift_and_prefix(spark):
    df = spark.createDataFrame([(1, 0, [5, 6], None), (2, 0, [7], [9, 9, 9])], "id int, batch int, x array<int>, ids array<int>")
    padded = S.pad_left_batch(df, "x", ["batch"], 0).orderBy("id").collect()
    assert [r.x for r in padded] == [[5, 6], [0, 7]] and [r.mask for r in padded] == [[True, True], [False, True]]
    ins = S.instruct_pad_mask(df, "ids", ["batch"]).orderBy("id").collect()
    assert [r.ids for r in ins] == [[0, 0, 0], [9, 9, 9]] and ins[0].instruct_mask == [False] * 3
    none = S.instruct_pad_mask(df.where("id = 1"), "ids", ["batch"]).first()
    assert none.ids == [] and none.instruct_mask == []
    moved = S.shift_for_prediction(df, ["x"], []).orderBy("id").collect()
    assert [r.x for r in moved] == [[5], []]


def shown(c):
    return F.array_join(F.col(c).cast("array<string>"), ",").alias(c)


def test_channels_as_text_equal_the_arrays(spark):
    names = ["text_channel", "codec_channel", "labels"]
    odd = spark.createDataFrame([(90, 0, None, [frame(0)]), (91, 0, [1, 2, 3], None), (92, 1, [1, 2, 3], [[None] * 16])], SCHEMA)
    given = rows(spark).union(odd)
    arrays = S.assemble_sequences(given, "text_ids", "codes", ["batch"], set(names))
    texts = S.assemble_sequences(given, "text_ids", "codes", ["batch"], set(names), as_text=True)
    assert texts.orderBy("id").select("id", *names).collect() == arrays.orderBy("id").select("id", *map(shown, names)).collect()
    moved = S.shift_for_prediction(arrays, ["codec_channel"], ["labels"]).orderBy("id").select(shown("codec_channel"), shown("labels"))
    assert S.shift_for_prediction(texts, ["codec_channel"], ["labels"], True).orderBy("id").select("codec_channel", "labels").collect() == moved.collect()
    short = spark.createDataFrame([("7", "7"), ("", ""), (None, None), ("1,22,333", "1,22,333")], "x string, y string")
    got = S.shift_for_prediction(short, ["x"], ["y"], as_text=True).collect()
    assert [tuple(r) for r in got] == [("", ""), ("", ""), (None, None), ("1,22", "22,333")]


def test_instruct_prefix_as_text_equals_the_arrays(spark):
    flags, names = ["attention_mask", "codec_mask"], {"attention_mask", "codec_mask", "labels", "code_matrix"}
    ids = F.when(F.col("id") % 4 != 0, F.slice("text_ids", 1, F.col("id") % 3))
    given = S.instruct_pad_mask(rows(spark).withColumn("ids", ids), "ids", ["batch"])
    arrays = S.instruct_prefix(S.assemble_sequences(given, "text_ids", "codes", ["batch"], names)).orderBy("id")
    want = arrays.select(*[F.array_join(F.col(c).cast("array<int>").cast("array<string>"), "").alias(c) for c in flags], shown("labels"),
                         F.expr("array_join(transform(code_matrix, r -> array_join(r, ',')), ';')").alias("code_matrix"))
    texts = S.assemble_sequences(given, "text_ids", "codes", ["batch"], names, as_text=names)
    assert S.instruct_prefix(texts, as_text=names).orderBy("id").select(want.columns).collect() == want.collect()


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first().v


def lit(rows):
    return F.array(*[F.array(*[F.lit(x) for x in r]) for r in rows])


def test_parse_codes(spark):
    tall, wide, square = [[1] * 16] * 3, [[q] * 3 for q in range(16)], [[10 * r + c for c in range(16)] for r in range(16)]
    assert one(spark, A.parse_codes(lit(tall))) == tall
    assert one(spark, A.parse_codes(lit(wide))) == [list(range(16))] * 3
    assert one(spark, A.parse_codes(lit(square))) == square
    assert one(spark, A.parse_codes(lit([[7] * 16]))) == [[7] * 16]
    assert one(spark, A.parse_codes(lit([[1] * 15] * 3))) is None
    assert one(spark, A.parse_codes(A.column_codes(F.array(*[F.lit(i) for i in range(16)])))) == [list(range(16))]


def test_truncate_takes_the_first_end_id(spark):
    codes = [[5, 1], [4198, 2], [4198, 3]]
    assert one(spark, A.truncate_at_eos(lit(codes))) == [[5, 1]]
    assert one(spark, A.truncate_at_eos(lit([[5, 4198]]))) == [[5, 4198]]


def test_align(spark):
    text, codec = F.array(*[F.lit(i) for i in (1, 2, 3)]), F.array(F.lit(9))
    assert one(spark, A.aligned_text(text, codec)) == [1] and one(spark, A.remaining_text(text, codec)) == [2, 3]
    assert one(spark, A.aligned_text(codec, text)) == [9, PAD, PAD] and one(spark, A.remaining_text(codec, text)) == []


def test_chunks_tile_the_frames(spark):
    for n in (0, 1, 24, 25, 26, 299, 300, 301, 325, 900):
        plan = one(spark, A.chunk_plan(F.lit(n), 25, 25))
        assert [p.start for p in plan] == list(range(0, n, 25))
        assert sum(p.end - p.start for p in plan) == n
        assert all(p.context == (25 if p.start > 25 else p.start) for p in plan)


def test_padded_text_takes_little_room_on_disk(spark, folder):
    """Files of padded text are far smaller than the twentieth that snappy makes of a run; a codec of the session stays."""
    before = spark.conf.get(CODEC, None)
    spark.conf.unset(CODEC)
    try:
        width = 20_000
        made = S.assemble_sequences(rows(spark).withColumn("width", F.lit(width)), "text_ids", "codes", ["batch"], {"code_matrix"}, "width", as_text=True)
        made.select("id", "code_matrix").write.parquet(folder)
        got = spark.read.parquet(folder).agg(F.sum(F.length("code_matrix")), F.count("*")).first()
        assert got[0] >= got[1] * (32 * width - 1) and got[1] == len(CASES)
        on_disk = sum(p.stat().st_size for p in Path(folder.removeprefix("file://")).glob("*.parquet"))
        assert on_disk * 100 < got[0]
        spark.conf.set(CODEC, "gzip")
        S.assemble_sequences(rows(spark).withColumn("width", F.lit(9)), "text_ids", "codes", ["batch"], {"labels"}, "width", as_text=True)
        assert spark.conf.get(CODEC) == "gzip"
    finally:
        spark.conf.unset(CODEC) if before is None else spark.conf.set(CODEC, before)
