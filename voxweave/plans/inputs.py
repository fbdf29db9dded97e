"""How the given tables stand in for raw sources, codes, clips and requests; in Spark and, the same, in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

SOURCES = ["src_0", "src_1", "src_2"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def show(c: Column | str) -> Column:
    """An array as comma-separated text (booleans as 0/1), so results compare as plain strings."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c.cast("array<string>"), ",")


def show_flags(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c.cast("array<int>").cast("array<string>"), "")


def show_rows(c: Column | str) -> Column:
    """A matrix as text, rows separated by semicolons."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(c, lambda r: F.array_join(r.cast("array<string>"), ",")), ";")


def sql_show(x: str) -> str:
    return f"coalesce(array_to_string({x}, ','), '')"


def sql_flags(x: str) -> str:
    return f"coalesce(array_to_string(list_transform({x}, lambda _f: CAST(_f AS INTEGER)), ''), '')"


def sql_rows(x: str) -> str:
    return f"coalesce(array_to_string(list_transform({x}, lambda _r: array_to_string(_r, ',')), ';'), '')"


def sql_rep(value: str, times: str) -> str:
    return f"list_transform(range(0, {times}), lambda _x: {value})"


# ---------------------------------------------------------------- raw sources


def raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Three logical sources with spelling variants of languages, tags, braces and blank texts."""
    d = F.col("doc_id")
    text = (
        F.when(d % 17 == 0, F.lit("  "))
        .when(d % 5 == 0, F.concat(F.lit("<i>"), F.col("text"), F.lit("</i>{note}")))
        .otherwise(F.col("text"))
    )
    language = (
        F.when(d % 6 == 0, "ja").when(d % 6 == 1, "JPN").when(d % 6 == 2, " kr ").when(d % 6 == 3, "ko_KR")
        .when(d % 6 == 4, F.col("lang"))
    )
    return table(spark, sf, "documents").select(
        d.alias("raw_index"),
        F.concat(F.lit("src_"), (d % 3).cast("string")).alias("source"),
        text.alias("transcription"),
        F.col("source").alias("speaker"),
        language.alias("language"),
        "n_chars",
    )


RAW = """raw AS (SELECT doc_id AS raw_index, 'src_' || (doc_id % 3) AS source,
 CASE WHEN doc_id % 17 = 0 THEN '  ' WHEN doc_id % 5 = 0 THEN '<i>' || text || '</i>{note}' ELSE text END AS transcription,
 source AS speaker,
 CASE doc_id % 6 WHEN 0 THEN 'ja' WHEN 1 THEN 'JPN' WHEN 2 THEN ' kr ' WHEN 3 THEN 'ko_KR' WHEN 4 THEN lang END AS language,
 n_chars FROM documents)"""


def sql_clean(x: str) -> str:
    bare = f"regexp_replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '\\{{[^}}]*\\}}', '', 'g')"
    return f"coalesce(trim(regexp_replace({bare}, '\\s+', ' ', 'g')), '')"


def sql_language(x: str) -> str:
    return (
        f"CASE WHEN lower(trim({x})) IN ('ja','jpn','jp','japanese','ja-jp','ja_jp') THEN 'japanese' "
        f"WHEN lower(trim({x})) IN ('ko','kor','kr','korean','ko-kr','ko_kr') THEN 'korean' ELSE lower(trim({x})) END"
    )


CLEANED = f"""{RAW}, cleaned AS (SELECT raw_index, source, {sql_clean('transcription')} AS text, speaker,
 {sql_language('language')} AS language, n_chars FROM raw), kept AS (SELECT * FROM cleaned WHERE text <> '')"""


def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned rows with text; the form most operators start from."""
    from ..functions import text as X

    raw = raw_rows(spark, sf)
    return raw.where(X.has_dialog_text("transcription")).select(
        "raw_index", "source", X.clean_dialog_text("transcription").alias("text"), "speaker",
        X.normalize_language("language").alias("language"), "n_chars",
    )


# ---------------------------------------------------------------- codes and text ids


def code_rows(spark: SparkSession, sf: str, with_end: bool = False, extra: tuple = (), rows: DataFrame | None = None) -> DataFrame:
    """Codes of ``n_chars / 40 + 1`` frames per document; optionally with an end id in the first code."""
    d = F.col("doc_id")

    def frame(t: Column) -> Column:
        def code(q: Column) -> Column:
            value = ((d * 31 + t * 17 + q * 7) % 2048).cast("int")
            return F.when((q == 0) & (t == d % 50), F.lit(4198)).otherwise(value) if with_end else value

        return F.transform(F.sequence(F.lit(0), F.lit(15)), code)

    frames = F.transform(F.sequence(F.lit(0), F.floor(F.col("n_chars") / 40).cast("int")), frame)
    rows = spread(table(spark, sf, "documents").select("doc_id", "n_chars", *extra)) if rows is None else rows
    return rows.select("doc_id", "n_chars", frames.alias("codes"), *extra)


def sql_codes(with_end: bool = False) -> str:
    value = "(doc_id * 31 + t * 17 + q * 7) % 2048"
    if with_end:
        value = f"CASE WHEN q = 0 AND t = doc_id % 50 THEN 4198 ELSE {value} END"
    return f"list_transform(range(0, n_chars // 40 + 1), lambda t: list_transform(range(0, 16), lambda q: {value}))"


HEAD, TAIL = (1, 2, 3), (4, 5, 6, 7, 8)


def with_text_ids(rows: DataFrame, into: str = "ids") -> DataFrame:
    """Template ids around the code points of ``text``."""
    from ..operators.sequences import code_point_ids

    return code_point_ids(rows, "text", into, HEAD, TAIL)


def sql_text_ids(x: str) -> str:
    return f"list_concat(list_concat([1,2,3], list_transform(string_split({x}, ''), lambda ch: unicode(ch))), [4,5,6,7,8])"


def layout_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Trimmed text ids and codes of every document, with its batch and the widths of the batch.

    Batches are planned on lengths; ids and codes are built beside their text, which does not move again.
    """
    from ..functions import arrays as A
    from ..operators import sequences as S

    source = F.concat(F.lit("src_"), (F.col("doc_id") % 3).cast("string")).alias("source")
    rows = table(spark, sf, "documents").select("doc_id", "n_chars", "text", source)
    text, frames = F.char_length("text") + len(HEAD), F.floor(F.col("n_chars") / 40) + 1
    plan = S.plan_batches(rows, "doc_id", {"width": text + frames + 8, "code_width": frames})
    rows = S.with_plan(spread(rows), plan, "doc_id")
    rows = with_text_ids(rows, "text_ids").withColumn("text_ids", A.drop_ends("text_ids", 0, 5))
    return code_rows(spark, sf, extra=("source", "batch", "width", "code_width", "text_ids"), rows=rows)


LAYOUT = f"""docs AS (SELECT doc_id, 'src_' || (doc_id % 3) AS source, {sql_codes()} AS codes,
 {sql_text_ids('text')} AS all_ids FROM documents),
 lay0 AS (SELECT doc_id, source, codes, all_ids[1:len(all_ids)-5] AS text_ids,
 (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 32 AS batch FROM docs),
 lay AS (SELECT *, len(text_ids) AS lt, len(codes) AS lc, list_transform(codes, lambda f: f[1]) AS c0,
 max(len(text_ids) + len(codes) + 8) OVER (PARTITION BY source, batch) AS width FROM lay0)"""


# ---------------------------------------------------------------- vectors and clips


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"), "label"
    )


VECTORS = "vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"


def clips(spark: SparkSession, sf: str) -> DataFrame:
    """Each 64-value embedding as a short clip, at 16 or 24 kHz."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("clip_id"),
        F.concat(F.lit("src_"), (F.col("label") % 3).cast("string")).alias("source"),
        F.col("embedding").alias("samples"),
        F.when(F.col("vec_id") % 2 == 0, 16000).otherwise(24000).alias("rate"),
    )


CLIPS = """clips AS (SELECT vec_id AS clip_id, 'src_' || (label % 3) AS source, CAST(embedding AS DOUBLE[]) AS samples,
 CASE WHEN vec_id % 2 = 0 THEN 16000 ELSE 24000 END AS rate FROM embeddings)"""


def long_clips(spark: SparkSession, sf: str, repeats: int = 20) -> DataFrame:
    """Clips long enough for a spectrogram: every embedding repeated to 64 * ``repeats`` samples."""
    return clips(spark, sf).withColumn("samples", F.flatten(F.array_repeat("samples", repeats)))


def codebook(spark: SparkSession, sf: str, size: int = 16) -> DataFrame:
    """A codebook of the first vectors."""
    return vectors(spark, sf).where(F.col("vec_id") < size).select(F.col("vec_id").cast("int").alias("code"), "vec")


def sql_codebook(size: int = 16) -> str:
    return f"book AS (SELECT CAST(vec_id AS INTEGER) AS code, vec FROM vectors WHERE vec_id < {size})"


# ---------------------------------------------------------------- requests and dimensions


def languages(spark: SparkSession, sf: str) -> DataFrame:
    """Language dimension: the languages of the documents plus two dialects, with ids from their names."""
    seen = table(spark, sf, "documents").select(F.col("lang").alias("language")).distinct()
    more = table(spark, sf, "nation").where(F.col("n_nationkey") < 2).select(
        F.concat(F.lower("n_name"), F.lit("_dialect")).alias("language")
    )
    zh = table(spark, sf, "nation").where(F.col("n_nationkey") == 2).select(F.lit("chinese").alias("language"))
    every = seen.union(more).union(zh)
    return every.select("language", (F.ascii("language") * 10 + F.length("language")).cast("int").alias("language_id"))


LANGUAGES = """languages AS (SELECT language, CAST(ascii(language) * 10 + length(language) AS INTEGER) AS language_id FROM (
 SELECT DISTINCT lang AS language FROM documents
 UNION ALL SELECT lower(n_name) || '_dialect' FROM nation WHERE n_nationkey < 2
 UNION ALL SELECT 'chinese' FROM nation WHERE n_nationkey = 2))"""


def speakers(spark: SparkSession, sf: str) -> DataFrame:
    """Speaker dimension: suppliers; every fourth one speaks a dialect."""
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.lower("s_name").alias("speaker"), key.cast("int").alias("speaker_id"),
        F.when(key % 4 == 0, F.concat(F.lit("nation_"), (key % 2 + key % 8 / 4).cast("int").cast("string"), F.lit("_dialect"))).alias("dialect"),
    )


SPEAKERS = """speakers AS (SELECT lower(s_name) AS speaker, CAST(s_suppkey AS INTEGER) AS speaker_id,
 CASE WHEN s_suppkey % 4 = 0 THEN 'nation_' || CAST(floor(s_suppkey % 2 + (s_suppkey % 8) / 4) AS INTEGER) || '_dialect' END AS dialect
 FROM supplier)"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Synthesis requests: one per document, with a language in mixed case and a speaker."""
    d = F.col("doc_id")
    language = (
        F.when(d % 7 == 0, "Auto").when(d % 7 == 1, "Chinese").when(d % 7 == 2, "Klingon")
        .when(d % 7 == 3, F.lit(None)).otherwise(F.initcap("lang"))
    )
    speaker = (
        F.when(d % 5 == 0, F.lit(None)).when(d % 5 == 1, "")
        .when(d % 5 == 2, F.concat(F.lit("Nobody"), (d % 10).cast("string")))
        .otherwise(F.concat(F.lit("Supplier#"), F.lpad((d % 20).cast("string"), 9, "0")))
    )
    return table(spark, sf, "documents").select(
        d.alias("request_id"), "text", language.alias("language"), speaker.alias("speaker")
    )


REQUESTS = """requests AS (SELECT doc_id AS request_id, text,
 CASE doc_id % 7 WHEN 0 THEN 'Auto' WHEN 1 THEN 'Chinese' WHEN 2 THEN 'Klingon' WHEN 3 THEN NULL
  ELSE upper(lang[1]) || lower(lang[2:]) END AS language,
 CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Nobody' || (doc_id % 10)
  ELSE 'Supplier#' || lpad(CAST(doc_id % 20 AS VARCHAR), 9, '0') END AS speaker FROM documents)"""
