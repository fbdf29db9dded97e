"""Corpus preparation: cleaning, filters, caps, batches, reports, limits and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import audio as U
from ..functions import text as X
from ..operators import cleaning as C
from ..operators import ordering as O
from ..operators import reports as R
from ..operators import validation as V
from . import inputs as I
from .registry import query

ALLOWED = [" JA ", "kor", None, "en"]
ALLOWED_SQL = "('en', 'japanese', 'korean')"


# ---------------------------------------------------------------- projections


@query(
    "clean_requests",
    """WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '  ' || text || chr(10) WHEN turn % 5 = 0 THEN ' ' ELSE text END AS text,
 CASE WHEN turn % 2 = 0 THEN '  ' ELSE ' ' || role || ' ' END AS instruct FROM conversations)
 SELECT conv_id, turn, trim(text, ' ' || chr(10)) AS text, nullif(trim(instruct), '') AS instruct FROM t WHERE trim(text, ' ' || chr(10)) <> ''""",
)
def clean_requests(spark, sf):
    turn = F.col("turn")
    text = F.when(turn % 3 == 0, F.concat(F.lit("  "), "text", F.lit("\n"))).when(turn % 5 == 0, " ").otherwise(F.col("text"))
    instruct = F.when(turn % 2 == 0, "  ").otherwise(F.concat(F.lit(" "), "role", F.lit(" ")))
    rows = I.table(spark, sf, "conversations").select("conv_id", "turn", text.alias("text"), instruct.alias("instruct"))
    return C.clean_requests(rows, "1b7")


PAYLOADS = """payloads AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN 'data:audio/wav;base64,' || to_base64(encode(url))
 WHEN 2 THEN replace(to_base64(encode(url || url || url || url || url || url || url || url || url || url)), '/', '+')
 WHEN 3 THEN 'clips/' || page_id || '.wav' WHEN 4 THEN 'https:///' || page_id ELSE 'short' END AS payload FROM pages)"""


def _payloads(spark, sf):
    p, url = F.col("page_id"), F.col("url")
    long = F.translate(F.base64(F.encode(F.repeat(url, 10), "utf-8")), "/\r\n", "+")
    payload = (
        F.when(p % 6 == 0, url)
        .when(p % 6 == 1, F.concat(F.lit("data:audio/wav;base64,"), F.translate(F.base64(F.encode(url, "utf-8")), "\r\n", "")))
        .when(p % 6 == 2, long)
        .when(p % 6 == 3, F.concat(F.lit("clips/"), p.cast("string"), F.lit(".wav")))
        .when(p % 6 == 4, F.concat(F.lit("https:///"), p.cast("string")))
        .otherwise("short")
    )
    return I.table(spark, sf, "pages").select("page_id", payload.alias("payload"))


@query(
    "audio_payload",
    f"""WITH {PAYLOADS}, k AS (SELECT *, CASE WHEN regexp_matches(payload, '^https?://[^/?#]+') THEN 'url'
 WHEN payload LIKE 'data:audio%' OR (payload NOT LIKE '%/%' AND payload NOT LIKE '%\\%' AND length(payload) > 256) THEN 'base64'
 ELSE 'path' END AS kind FROM payloads)
 SELECT page_id, kind, CASE WHEN kind = 'base64' THEN octet_length(from_base64(regexp_replace(payload, '^data:[^,]*,', ''))) END AS n_bytes,
 CASE WHEN kind = 'base64' THEN md5(from_base64(regexp_replace(payload, '^data:[^,]*,', ''))) END AS digest FROM k""",
)
def audio_payload(spark, sf):
    found = U.payload_bytes("payload")
    return _payloads(spark, sf).select(
        "page_id", U.payload_kind("payload").alias("kind"), F.octet_length(found).cast("long").alias("n_bytes"), F.md5(found).alias("digest")
    )


@query(
    "resolve_language_column",
    f"WITH {I.RAW} SELECT raw_index, language AS raw_language, CAST(NULL AS VARCHAR) AS no_column FROM raw",
)
def resolve_language_column(spark, sf):
    # ``lang`` holds a value in every row, but ``language`` exists and comes first, so its nulls stay.
    raw = I.raw_rows(spark, sf).withColumn("lang", F.lit("en"))
    return raw.select(
        "raw_index", C.language_column(raw).alias("raw_language"), C.language_column(raw.select("speaker")).alias("no_column")
    )


@query(
    "normalize_language",
    f"WITH {I.RAW} SELECT raw_index, {I.sql_language('language')} AS language FROM raw",
)
def normalize_language(spark, sf):
    return I.raw_rows(spark, sf).select("raw_index", X.normalize_language("language").alias("language"))


@query("clean_dialog_text", f"WITH {I.CLEANED} SELECT raw_index, text FROM cleaned")
def clean_dialog_text(spark, sf):
    return I.raw_rows(spark, sf).select("raw_index", X.clean_dialog_text("transcription").alias("text"))


@query(
    "collapse_whitespace",
    "SELECT page_id, trim(regexp_replace(html, '\\s+', ' ', 'g')) AS text FROM pages",
)
def collapse_whitespace(spark, sf):
    return I.table(spark, sf, "pages").select("page_id", X.collapse_whitespace("html").alias("text"))


@query(
    "match_key",
    f"""WITH {I.CLEANED} SELECT raw_index, CASE WHEN text <> '' THEN text || '||' || coalesce(trim(speaker), '') || '||'
 || coalesce(language, '') END AS match_key FROM cleaned""",
)
def match_key(spark, sf):
    return I.raw_rows(spark, sf).select("raw_index", X.match_key("transcription", "speaker", "language").alias("match_key"))


CANONICAL = f"""{I.CLEANED}, canonical AS (SELECT raw_index, source, text, speaker, nullif(language, '') AS language,
 encode(text) AS audio_bytes, 'clips/' || raw_index || '.wav' AS audio_path FROM kept)"""


def canonical(spark, sf):
    """Cleaned rows in canonical form; the text's bytes stand in for the clip."""
    rows = I.clean_rows(spark, sf).withColumn(
        "audio",
        F.struct(
            F.encode("text", "utf-8").alias("bytes"),
            F.concat(F.lit("clips/"), F.col("raw_index").cast("string"), F.lit(".wav")).alias("path"),
        ),
    )
    return C.canonical_row(rows, F.col("source"), ["raw_index"])


@query(
    "canonical_row",
    f"WITH {CANONICAL} SELECT raw_index, text, source, speaker, language, audio_path, md5(audio_bytes) AS audio_digest FROM canonical",
)
def canonical_row(spark, sf):
    return canonical(spark, sf).select(
        "raw_index", "text", "source", "speaker", "language", F.col("audio.path").alias("audio_path"),
        F.md5("audio.bytes").alias("audio_digest"),
    )


@query(
    "output_schema_train_minimal",
    f"""WITH {CANONICAL} SELECT audio_path, text AS transcript, speaker, CAST(raw_index % 16 AS INTEGER) AS first_code,
 'audio,text,source,speaker,language,audio_codes' AS train_columns FROM canonical""",
)
def output_schema_train_minimal(spark, sf):
    rows = canonical(spark, sf).withColumn("encoded", F.array(F.array((F.col("raw_index") % 16).cast("int"))))
    train = C.output_rows(rows, "train", "encoded")
    minimal = C.output_rows(rows, "minimal", "encoded")
    return minimal.select(
        F.col("audio.path").alias("audio_path"), "transcript", "speaker", F.col("codes")[0][0].alias("first_code"),
        F.lit(",".join(train.columns)).alias("train_columns"),
    )


# ---------------------------------------------------------------- filters


@query("filter_has_text", f"WITH {I.CLEANED} SELECT raw_index, source, text FROM kept")
def filter_has_text(spark, sf):
    rows = C.filter_has_text(I.raw_rows(spark, sf), "transcription")
    return rows.select("raw_index", "source", "text")


@query(
    "filter_language_allowed",
    f"WITH {I.CLEANED} SELECT raw_index, source, language FROM cleaned WHERE language IN {ALLOWED_SQL}",
)
def filter_language_allowed(spark, sf):
    rows = I.raw_rows(spark, sf).select("raw_index", "source", X.normalize_language("language").alias("language"))
    return C.filter_language_allowed(rows, C.allowed_languages(ALLOWED))


@query(
    "filter_has_audio",
    f"WITH {CANONICAL} SELECT raw_index, audio_path FROM canonical WHERE raw_index % 3 <> 1",
)
def filter_has_audio(spark, sf):
    rows = canonical(spark, sf).withColumn(
        "audio",
        F.when(F.col("raw_index") % 3 == 1, F.struct(F.lit(None).cast("binary").alias("bytes"), F.col("audio.path").alias("path")))
        .otherwise(F.col("audio")),
    )
    return C.filter_has_audio(rows).select("raw_index", F.col("audio.path").alias("audio_path"))


@query(
    "filter_max_duration",
    "SELECT doc_id, n_chars * 240 AS frames FROM documents WHERE n_chars * 240 / 24000.0 <= 12.5",
)
def filter_max_duration(spark, sf):
    rows = I.table(spark, sf, "documents").select("doc_id", (F.col("n_chars") * 240).alias("frames"), F.lit(24000).alias("rate"))
    return C.filter_max_duration(rows, 12.5, "frames", "rate").drop("rate")


@query(
    "validate_languages",
    f"""WITH {I.LANGUAGES}, {I.REQUESTS} SELECT request_id, language FROM requests
 WHERE language IS NULL OR lower(language) NOT IN (SELECT language FROM languages WHERE language NOT LIKE '%dialect%' UNION ALL SELECT 'auto')""",
)
def validate_languages(spark, sf):
    known = V.user_languages(I.languages(spark, sf))
    return V.validate_languages(I.requests(spark, sf), known).select("request_id", "language")


@query(
    "validate_speakers",
    f"""WITH {I.SPEAKERS}, {I.REQUESTS} SELECT request_id, speaker FROM requests
 WHERE speaker IS NOT NULL AND speaker <> '' AND lower(speaker) NOT IN (SELECT speaker FROM speakers)""",
)
def validate_speakers(spark, sf):
    return V.validate_speakers(I.requests(spark, sf), I.speakers(spark, sf)).select("request_id", "speaker")


@query(
    "validate_model_kind",
    """WITH models AS (SELECT n_name AS model, CASE n_nationkey % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'voice_design' ELSE 'custom_voice' END AS kind FROM nation),
 req AS (SELECT o_orderkey AS request_id, 'NATION_' || (o_orderkey % 27) AS model,
 CASE o_orderkey % 4 WHEN 0 THEN 'base' WHEN 1 THEN 'voice_design' ELSE 'custom_voice' END AS kind FROM orders)
 SELECT request_id, model, kind FROM req r WHERE NOT EXISTS (SELECT 1 FROM models m WHERE m.model = r.model AND m.kind = r.kind)""",
)
def validate_model_kind(spark, sf):
    def kind(n, mod):
        return F.when(n % mod == 0, "base").when(n % mod == 1, "voice_design").otherwise("custom_voice")

    models = I.table(spark, sf, "nation").select(F.col("n_name").alias("model"), kind(F.col("n_nationkey"), 3).alias("kind"))
    key = F.col("o_orderkey")
    rows = I.table(spark, sf, "orders").select(
        key.alias("request_id"), F.concat(F.lit("NATION_"), (key % 27).cast("string")).alias("model"), kind(key, 4).alias("kind")
    )
    return V.validate_model_kind(rows, models).select("request_id", "model", "kind")


@query(
    "validate_code_shape",
    "SELECT doc_id, doc_id % 9 <> 0 AS valid FROM documents",
)
def validate_code_shape(spark, sf):
    rows = I.code_rows(spark, sf)
    broken = F.when(F.col("doc_id") % 9 == 0, F.transform("codes", lambda f: F.slice(f, 1, 15))).otherwise(F.col("codes"))
    return rows.withColumn("codes", broken).select("doc_id", V.code_shape(rows, "codes").alias("valid"))


@query(
    "filter_special_codes",
    f"""WITH c AS (SELECT doc_id, list_transform({I.sql_codes()}, lambda f: f[1]) AS c0 FROM documents)
 SELECT doc_id, {I.sql_show("list_filter(c0, lambda x: NOT (x >= 1024 AND x < 2048 AND x <> 1500))")} AS c0 FROM c""",
)
def filter_special_codes(spark, sf):
    from ..functions.arrays import first_codes

    rows = I.code_rows(spark, sf).select("doc_id", first_codes("codes").alias("c0"))
    return V.filter_special_codes(rows, "c0", 2048, 1024, 1500).withColumn("c0", I.show("c0"))


# ---------------------------------------------------------------- sources, unions, order


@query(
    "scan_source_a",
    f"""WITH {CANONICAL}, a AS (SELECT * FROM canonical WHERE raw_index % 3 = 0 AND language IN {ALLOWED_SQL})
 SELECT raw_index, text, 'src_0' AS source, speaker, language, audio_path FROM a""",
)
def scan_source_a(spark, sf):
    raw = _with_audio(I.raw_rows(spark, sf)).where(F.col("source") == "src_0")
    rows = C.source_a(raw, "src_0", ALLOWED)
    return rows.select("raw_index", "text", "source", "speaker", "language", F.col("audio.path").alias("audio_path"))


def _with_audio(raw):
    return raw.withColumn(
        "audio",
        F.struct(
            F.encode("transcription", "utf-8").alias("bytes"),
            F.concat(F.lit("clips/"), F.col("raw_index").cast("string"), F.lit(".wav")).alias("path"),
        ),
    )


@query(
    "scan_source_b",
    """WITH b AS (SELECT page_id AS raw_index, trim(regexp_replace(html, '\\s+', ' ', 'g')) AS text, CAST(page_id % 11 AS VARCHAR) AS speaker
 FROM pages WHERE page_id % 4 <> 0 AND page_id % 5 <> 0)
 SELECT raw_index, text, 'src_b' AS source, speaker, 'korean' AS language FROM b""",
)
def scan_source_b(spark, sf):
    p = F.col("page_id")
    rows = I.table(spark, sf, "pages").select(
        p.alias("raw_index"), F.col("html").alias("voice_text"), F.when(p % 4 != 0, F.col("url")).alias("file_url"),
        (p % 11).alias("char_id"),
        F.struct(F.when(p % 5 != 0, F.encode("url", "utf-8")).alias("bytes"), F.col("url").alias("path")).alias("audio"),
    )
    return C.source_b(rows, "src_b").select("raw_index", "text", "source", "speaker", "language")


@query(
    "union_sources",
    f"""WITH {I.CLEANED} SELECT raw_index, source, text, language, 0 AS source_order FROM kept
 UNION ALL SELECT page_id, 'pages', html, NULL, 1 FROM pages UNION ALL SELECT item_id, 'benchmark', text, 'en', 2 FROM benchmark""",
)
def union_sources(spark, sf):
    first = I.clean_rows(spark, sf).select("raw_index", "source", "text", "language")
    pages = I.table(spark, sf, "pages").select(F.col("page_id").alias("raw_index"), F.lit("pages").alias("source"), F.col("html").alias("text"))
    items = I.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("raw_index"), F.lit("benchmark").alias("source"), "text", F.lit("en").alias("language")
    )
    return C.union_sources([first, pages, items])


@query(
    "assign_global_index",
    f"""WITH {I.CLEANED} SELECT source, raw_index, row_number() OVER (ORDER BY CASE source WHEN 'src_2' THEN 0 WHEN 'src_0' THEN 1 ELSE 2 END, raw_index) - 1
 AS global_index FROM kept""",
)
def assign_global_index(spark, sf):
    rows = I.clean_rows(spark, sf).select("source", "raw_index")
    return O.assign_global_index(rows, ["src_2", "src_0", "src_1"])


@query(
    "cap_per_source",
    f"""WITH {I.CLEANED}, n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY raw_index) AS rn FROM kept)
 SELECT source, raw_index, text FROM n WHERE rn <= 100""",
)
def cap_per_source(spark, sf):
    # Capped on the raw rows that will survive, then cleaned.
    rows = I.raw_rows(spark, sf).where(X.has_dialog_text("transcription")).select("source", "raw_index", "transcription")
    return O.cap_per_source(rows, 100).select("source", "raw_index", X.clean_dialog_text("transcription").alias("text"))


@query(
    "fixed_batches",
    f"""WITH {I.CLEANED}, n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY raw_index) - 1 AS rn FROM kept)
 SELECT source, raw_index, rn // 32 AS batch, rn % 32 AS slot FROM n""",
)
def fixed_batches(spark, sf):
    return O.fixed_batches(I.clean_rows(spark, sf).select("source", "raw_index"))


HASHED_SQL = "('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT"


@query(
    "fixed_batches_hashed",
    f"""WITH h AS (SELECT doc_id, source, CASE WHEN doc_id % 11 > 0 THEN {HASHED_SQL} END AS hashed FROM documents),
 n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY hashed NULLS LAST, doc_id) - 1 AS rn FROM h)
 SELECT source, doc_id, rn // 32 AS batch, rn % 32 AS slot FROM n WHERE hashed IS NOT NULL
 UNION ALL SELECT source, NULL, rn // 32, rn % 32 FROM n WHERE hashed IS NULL""",
)
def fixed_batches_hashed(spark, sf):
    """Order values are 60-bit hashes, and every eleventh row has none: spans are even all the same.

    Rows without an order value follow the others in any order, so their ids are not shown.
    """
    rows = I.table(spark, sf, "documents").select("source", "doc_id")
    hashed = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 15), 16, 10).cast("long")
    rows = rows.withColumn("hashed", F.when(F.col("doc_id") % 11 > 0, hashed))
    placed = O.fixed_batches(rows, raw_index="hashed", even=16)
    return placed.select("source", F.when(F.col("hashed").isNotNull(), F.col("doc_id")).alias("doc_id"), "batch", "slot")


@query(
    "length_ratio_batches",
    f"""WITH RECURSIVE {I.CLEANED}, n AS (SELECT source, raw_index, n_chars AS len, row_number() OVER (PARTITION BY source ORDER BY raw_index) AS rn FROM kept),
 f AS (SELECT source, raw_index, rn, CAST(len AS DOUBLE) AS top, 1 AS filled, CAST(0 AS BIGINT) AS batch FROM n WHERE rn = 1
 UNION ALL SELECT n.source, n.raw_index, n.rn,
 CASE WHEN n.len > 4.0 * f.top OR f.filled = 32 THEN n.len ELSE greatest(f.top, n.len) END,
 CASE WHEN n.len > 4.0 * f.top OR f.filled = 32 THEN 1 ELSE f.filled + 1 END,
 CASE WHEN n.len > 4.0 * f.top OR f.filled = 32 THEN f.batch + 1 ELSE f.batch END
 FROM f JOIN n ON n.source = f.source AND n.rn = f.rn + 1)
 SELECT source, raw_index, batch FROM f""",
)
def length_ratio_batches(spark, sf):
    rows = I.clean_rows(spark, sf).select("source", "raw_index", F.col("n_chars").alias("length"))
    return O.length_ratio_batches(rows).select("source", "raw_index", "batch")


@query(
    "take_limit",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber, l_quantity LIMIT 5000",
)
def take_limit(spark, sf):
    # Order keys repeat in this table, so the order covers every selected column.
    rows = I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return O.take_limit(rows, 5000, ["l_orderkey", "l_linenumber", "l_quantity"], O.span_of("l_orderkey", 1 << 12))


@query(
    "epoch_shuffle",
    """SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':3:7'), doc_id) - 1 AS shuffled_at FROM documents""",
)
def epoch_shuffle(spark, sf):
    return O.epoch_shuffle(I.table(spark, sf, "documents").select("doc_id"), "doc_id", 3, 7)


@query(
    "sample_vectors",
    """SELECT vec_id, CAST(row_number() OVER (ORDER BY md5(vec_id || ':0:5'), vec_id) - 1 AS INTEGER) AS draw FROM embeddings
 QUALIFY row_number() OVER (ORDER BY md5(vec_id || ':0:5'), vec_id) <= 64""",
)
def sample_vectors(spark, sf):
    return O.sample_vectors(I.table(spark, sf, "embeddings").select("vec_id"), 64, "vec_id", 5)


# ---------------------------------------------------------------- reports


@query(
    "drop_reason_counts",
    f"""WITH {I.RAW}, r AS (SELECT source, CASE WHEN trim(transcription) = '' THEN 'no_text' WHEN language IS NULL THEN 'no_language'
 WHEN raw_index % 13 = 0 THEN 'no_audio' ELSE 'kept' END AS reason FROM raw) SELECT source, reason, count(*) AS n_rows FROM r GROUP BY ALL""",
)
def drop_reason_counts(spark, sf):
    rows = I.raw_rows(spark, sf)
    reasons = [
        ("no_text", X.is_blank("transcription")),
        ("no_language", F.col("language").isNull()),
        ("no_audio", F.col("raw_index") % 13 == 0),
    ]
    return R.drop_reason_counts(rows, reasons)


@query(
    "source_language_summary",
    f"""WITH {I.CLEANED} SELECT source, language, count(*) AS n_rows, count(DISTINCT speaker) AS n_speakers
 FROM kept WHERE language IN {ALLOWED_SQL} GROUP BY ALL""",
)
def source_language_summary(spark, sf):
    raw = I.raw_rows(spark, sf)
    rows = raw.withColumn("language", X.normalize_language(C.language_column(raw)))
    rows = C.filter_language_allowed(rows, C.allowed_languages(ALLOWED))
    rows = C.filter_has_text(rows, "transcription")
    return R.source_language_summary(rows.select("source", "language", "speaker"))


@query(
    "distinct_sample_rates",
    f"""WITH {I.CLIPS}, b AS (SELECT clip_id // 8 AS batch, CASE WHEN (clip_id // 8) % 3 = 0 THEN 24000 ELSE rate END AS rate FROM clips)
 SELECT batch, count(DISTINCT rate) AS n_rates, CASE WHEN count(DISTINCT rate) = 1 THEN 1 ELSE count(*) END AS encode_calls FROM b GROUP BY batch""",
)
def distinct_sample_rates(spark, sf):
    batch = F.floor(F.col("clip_id") / 8)
    rows = I.clips(spark, sf).select(batch.alias("batch"), F.when(batch % 3 == 0, 24000).otherwise(F.col("rate")).alias("rate"))
    return R.distinct_sample_rates(rows)


@query(
    "codebook_usage",
    f"""WITH c AS (SELECT unnest({I.sql_codes()}) AS f FROM documents) SELECT count(DISTINCT f[1]) AS active_codes, count(*) AS tokens FROM c""",
)
def codebook_usage(spark, sf):
    rows = I.code_rows(spark, sf).select(F.explode("codes").alias("f")).select(F.col("f")[0].alias("code"))
    return R.codebook_usage(rows)
