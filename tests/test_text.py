import base64

import pytest
from pyspark.sql import functions as F

from voxweave.functions import audio as U
from voxweave.functions import text as X
from voxweave.operators import cleaning as C
from voxweave.operators import validation as V


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {kind}")


def values(df, c):
    return [r[0] for r in df.orderBy("id").select(c).collect()]


BLANKS = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0        　"
TEXTS = [
    "plain", "a  b", "　a　　b\x1c", "<i>x</i> {note} y", "<a<b>c>", "open { brace", "<only><tags>", None, "", "  ",
    "{a}{b}", "a<b\nc>d", "é\n\nü", "x" + BLANKS + "y", BLANKS, BLANKS * 3 + "z", "<" + "t" * 40 + ">", "{<x}>a}",
]


def cleaned(t):
    """What cleaning leaves, said with the standard library."""
    import re

    if not t:
        return ""
    return " ".join(re.sub(r"\{[^}]*\}", "", re.sub(r"<[^>]*>", "", t)).split())


def test_clean_dialog_text(spark):
    df = column(spark, TEXTS)
    assert values(df, X.clean_dialog_text("v")) == [cleaned(t) for t in TEXTS]
    assert values(df, X.has_dialog_text("v")) == [cleaned(t) != "" for t in TEXTS]


def test_blank_strip_collapse(spark):
    df = column(spark, TEXTS)
    assert values(df, X.is_blank("v")) == [not (t or "").strip() for t in TEXTS]
    assert values(df, X.strip_spaces("v")) == [None if t is None else t.strip() for t in TEXTS]
    assert values(df, X.collapse_whitespace("v")) == [None if t is None else " ".join(t.split()) for t in TEXTS]


def test_normalize_language(spark):
    given = [" JA ", "jpn", "JP", "Japanese", "ja-JP", "ja_jp", "　ko", "KOR", "kr", "ko-kr", "ko_KR", "", "  ", None, "Klingon"]
    want = ["japanese"] * 6 + ["korean"] * 5 + ["", "", None, "klingon"]
    assert values(column(spark, given), X.normalize_language("v")) == want
    assert C.allowed_languages([" JA ", None, "kor", "EN"]) == ["en", "japanese", "korean"]


def test_match_key_keeps_separators(spark):
    df = spark.createDataFrame([(0, " a  b ", None, None), (1, "<x>", "s", "ja"), (2, "t", " s ", "ja")], "id int, t string, s string, l string")
    assert values(df, X.match_key("t", "s", "l")) == ["a b||||", None, "t||s||japanese"]


def test_existing_column_wins_even_when_null(spark):
    df = spark.createDataFrame([(1, None, "ja")], "id int, lang string, locale string")
    assert df.select(C.language_column(df)).first()[0] is None
    assert X.first_existing(["voice_language", "lang_id"], ["language", "lang_id", "voice_language"]) == "lang_id"
    with pytest.raises(ValueError):
        C.rejected_codes_column(df)
    with pytest.raises(ValueError):
        C.require_column(df, "instruct")


def test_payload_kinds(spark):
    given = ["http://h/a.wav", "HTTPS://h", "https:///x", "data:audio/wav;base64,AAAA", "A" * 256, "A" * 257, "a/" + "A" * 300, "a\\" + "A" * 300, "x.wav", None]
    want = ["url", "url", "path", "base64", "path", "base64", "path", "path", "path", None]
    assert values(column(spark, given), U.payload_kind("v")) == want


def test_payload_bytes(spark):
    body = base64.b64encode(b"hello").decode()
    df = column(spark, ["data:audio/wav;base64," + body, base64.b64encode(b"z" * 300).decode().rstrip("="), "not/base64"])
    got = values(df, U.payload_bytes("v"))
    assert bytes(got[0]) == b"hello" and bytes(got[1]) == b"z" * 300 and got[2] is None


def test_fetch_name(spark):
    given = ["http://h/a/b.wav?x=1#f", "http://h/a/", "http://h", "https://h/c.mp3"]
    assert values(column(spark, given), X.fetch_name("v", "id")) == ["0_b.wav", "1_arknights_1.wav", "2_arknights_2.wav", "3_c.mp3"]


def test_clean_requests_small_model(spark):
    df = spark.createDataFrame([(" hi ", " be kind "), ("  ", "x"), ("a", "  ")], "text string, instruct string")
    assert [tuple(r) for r in C.clean_requests(df).collect()] == [("hi", "be kind"), ("a", None)]
    assert [r.instruct for r in C.clean_requests(df, "0b6").collect()] == [None, None]
    assert [r.instruct for r in C.clean_requests(df, "b").collect()] == [None, None]
    assert C.clean_requests(df, "b", exact_size=True).first().instruct == "be kind"


def test_output_schemas(spark):
    df = spark.createDataFrame([(None, "t", "s", "sp", "ja")], "audio struct<bytes:binary,path:string>, text string, source string, speaker string, language string")
    assert C.output_rows(df).columns == ["audio", "text", "source", "speaker", "language"]
    assert C.output_rows(df, "minimal").columns == ["audio", "transcript", "speaker", "codes"]


def test_source_a_filters_before_cap(spark):
    audio = F.struct(F.lit(b"x").alias("bytes"), F.lit("p").alias("path"))
    rows = [(i, " " if i % 2 else f"t{i}", None if i == 4 else "ja", "s") for i in range(12)]
    df = spark.createDataFrame(rows, "raw_index long, transcription string, lang string, speaker string").withColumn("audio", audio)
    out = C.source_a(df, "a", ["ja"], cap=3, start=1)
    assert sorted(r.raw_index for r in out.collect()) == [2, 6, 8]
    assert out.first().language == "japanese"


def test_validation_rules(spark):
    names = spark.createDataFrame([("English",), ("x_dialect",)], "language string")
    users = V.user_languages(names)
    df = column(spark, ["ENGLISH", "auto", "x_dialect", None, "zz", ""]).withColumnRenamed("v", "language")
    assert sorted(r.id for r in V.validate_languages(df, users).collect()) == [2, 3, 4, 5]
    spk = names.withColumnRenamed("language", "speaker")
    df = df.withColumnRenamed("language", "speaker")
    assert sorted(r.id for r in V.validate_speakers(df, spk).collect()) == [1, 4]
    with pytest.raises(ValueError):
        V.reject_or_raise(V.validate_speakers(df, spk), "speakers", ["speaker"])
    with pytest.raises(ValueError):
        V.require_rows(df.limit(0), "prompts")
