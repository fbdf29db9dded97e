"""Request tables, dimension look-ups, resume joins, preference metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as X
from ..operators import preferences as P
from ..operators import requests as Q
from ..operators import resume as E
from ..operators import validation as V
from . import inputs as I
from .registry import query

LOOKUP = f"""{I.LANGUAGES}, {I.REQUESTS}, ids AS (SELECT request_id, r.language, speaker, CASE WHEN lower(r.language) = 'auto' THEN NULL ELSE language_id END AS language_id,
 coalesce(lower(r.language) <> 'auto', true) AND language_id IS NULL AS language_error FROM requests r LEFT JOIN languages l ON lower(r.language) = l.language)"""


@query("join_language_id", f"WITH {LOOKUP} SELECT request_id, language, language_id, language_error FROM ids")
def join_language_id(spark, sf):
    rows = Q.join_language_id(I.requests(spark, sf), I.languages(spark, sf))
    return rows.select("request_id", "language", "language_id", "language_error")


@query(
    "join_speaker_dialect",
    f"""WITH {LOOKUP}, {I.SPEAKERS} SELECT request_id, i.language, i.speaker,
 CASE WHEN lower(i.language) IN ('chinese', 'auto') AND d.language_id IS NOT NULL THEN d.language_id ELSE i.language_id END AS language_id
 FROM ids i LEFT JOIN speakers s ON lower(i.speaker) = s.speaker LEFT JOIN languages d ON d.language = s.dialect""",
)
def join_speaker_dialect(spark, sf):
    languages = I.languages(spark, sf)
    rows = Q.join_language_id(I.requests(spark, sf), languages)
    return Q.join_speaker_dialect(rows, I.speakers(spark, sf), languages).select("request_id", "language", "speaker", "language_id")


@query(
    "broadcast_scalars",
    """WITH t AS (SELECT conv_id, turn AS position, text FROM conversations),
 v AS (SELECT conv_id, turn AS position, role AS voice FROM conversations WHERE conv_id % 2 = 1 OR turn = 0)
 SELECT t.conv_id, t.position, t.text, CASE WHEN t.conv_id % 2 = 1 THEN v.voice ELSE o.voice END AS voice FROM t
 LEFT JOIN v ON v.conv_id = t.conv_id AND v.position = t.position
 LEFT JOIN v o ON o.conv_id = t.conv_id AND o.position = 0""",
)
def broadcast_scalars(spark, sf):
    rows = I.table(spark, sf, "conversations").withColumnRenamed("turn", "position")
    # Even conversations bring one value for all their turns, odd ones a value per turn.
    values = rows.where((F.col("conv_id") % 2 == 1) | (F.col("position") == 0)).select(
        "conv_id", "position", F.col("role").alias("voice")
    )
    return Q.broadcast_scalars(rows.select("conv_id", "position", "text"), values, "position", "conv_id")


NAMES_SQL = ", ".join(f"('{k}', '{v}')" for k, v in K.GENERATION_DEFAULTS.items())


@query(
    "merge_defaults",
    f"""WITH fixed(name, value) AS (VALUES {NAMES_SQL}), file AS (SELECT CAST(max(n_nationkey) AS VARCHAR) AS top_k FROM nation)
 SELECT o_orderkey AS request_id, name, CASE WHEN name = 'temperature' AND o_orderkey % 3 = 0 THEN CAST(o_orderkey % 10 AS VARCHAR)
 WHEN name = 'max_new_tokens' AND o_orderkey % 4 = 1 THEN '512' WHEN name = 'top_k' THEN (SELECT top_k FROM file)
 WHEN name = 'top_p' THEN NULL ELSE value END AS value FROM orders CROSS JOIN fixed""",
)
def merge_defaults(spark, sf):
    key = F.col("o_orderkey")
    none = F.lit(None).cast("string")
    params = F.create_map(
        F.lit("temperature"), F.when(key % 3 == 0, (key % 10).cast("string")).otherwise(none),
        F.lit("max_new_tokens"), F.when(key % 4 == 1, "512").otherwise(none),
    )
    users = I.table(spark, sf, "orders").select(key.alias("request_id"), params.alias("params"))
    stored = I.table(spark, sf, "nation").agg(F.max("n_nationkey").cast("string").alias("k"))
    stored = stored.select(F.create_map(F.lit("top_k"), "k", F.lit("top_p"), none).alias("defaults"))
    return Q.merge_defaults(users, stored)


@query(
    "validate_prompt_rows",
    """WITH p AS (SELECT doc_id, CASE WHEN doc_id % 6 <> 0 THEN [CAST(n_chars AS DOUBLE)] END AS emb,
 CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS xv, CASE WHEN doc_id % 4 = 0 THEN false END AS icl,
 CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN NULL ELSE source END AS ref_text FROM documents),
 f AS (SELECT *, coalesce(xv, false) AS x FROM p)
 SELECT doc_id, x AS x_vector_only_mode, coalesce(icl, NOT x) AS icl_mode, CASE WHEN emb IS NULL THEN 'missing speaker vector'
 WHEN NOT x AND coalesce(ref_text, '') = '' THEN 'reference text required' END AS problem FROM f""",
)
def validate_prompt_rows(spark, sf):
    d = F.col("doc_id")
    prompts = I.table(spark, sf, "documents").select(
        "doc_id", F.when(d % 6 != 0, F.array(F.col("n_chars").cast("double"))).alias("ref_spk_embedding"),
        F.when(d % 3 == 0, True).when(d % 3 == 1, False).alias("x_vector_only_mode"),
        F.when(d % 4 == 0, False).alias("icl_mode"),
        F.when(d % 5 == 0, "").when(d % 5 == 1, F.lit(None)).otherwise(F.col("source")).alias("ref_text"),
    )
    return V.validate_prompt_rows(prompts).select("doc_id", "x_vector_only_mode", "icl_mode", "problem")


@query(
    "join_codes_by_row",
    f"""WITH c AS (SELECT doc_id, {I.sql_codes()} AS codes FROM documents WHERE n_chars % 7 <> 0)
 SELECT d.doc_id AS sample_id, d.lang, {I.sql_rows('codes')} AS codes FROM documents d JOIN c ON c.doc_id = d.doc_id""",
)
def join_codes_by_row(spark, sf):
    rows = I.table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), "lang")
    codes = I.code_rows(spark, sf).where(F.col("n_chars") % 7 != 0).select(F.col("doc_id").alias("sample_id"), I.show_rows("codes").alias("codes"))
    return Q.join_codes_by_row(rows, codes)


@query(
    "join_reference_audio",
    """SELECT doc_id, ref_audio, octet_length(b) AS ref_bytes FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Supplier#000000000'
 ELSE 'Supplier#' || lpad(CAST(doc_id % 120 AS VARCHAR), 9, '0') END AS ref_audio FROM documents) i
 LEFT JOIN (SELECT s_name, encode(s_name || s_acctbal) AS b FROM supplier) r ON r.s_name = i.ref_audio""",
)
def join_reference_audio(spark, sf):
    d = F.col("doc_id")
    name = F.when(d % 3 == 0, "Supplier#000000000").otherwise(F.concat(F.lit("Supplier#"), F.lpad((d % 120).cast("string"), 9, "0")))
    items = I.table(spark, sf, "documents").select("doc_id", name.alias("ref_audio"))
    clips = I.table(spark, sf, "supplier").select(
        F.col("s_name").alias("ref_audio"), F.encode(F.concat("s_name", F.col("s_acctbal").cast("string")), "utf-8").alias("bytes")
    )
    out = Q.join_reference_audio(items, clips, salt_by="doc_id")
    return out.select("doc_id", "ref_audio", F.octet_length("bytes").cast("long").alias("ref_bytes"))


# ---------------------------------------------------------------- resume


@query(
    "resume_from_cursor",
    f"WITH {I.CLEANED} SELECT source, raw_index, text FROM kept WHERE source = 'src_2' OR (source = 'src_1' AND raw_index >= 301)",
)
def resume_from_cursor(spark, sf):
    rows = I.clean_rows(spark, sf).select("source", "raw_index", "text")
    return E.resume_from_cursor(rows, I.SOURCES, "src_1", 301)


@query(
    "last_cursor",
    f"WITH {I.CLEANED} SELECT source, speaker AS split, max(raw_index) + 1 AS next_raw_index FROM kept GROUP BY ALL",
)
def last_cursor(spark, sf):
    rows = I.clean_rows(spark, sf).withColumnRenamed("speaker", "split")
    return E.last_cursor(rows)


@query(
    "anti_join_done",
    f"""WITH {I.CLEANED}, k AS (SELECT raw_index, text || '||' || coalesce(trim(speaker), '') || '||' || coalesce(language, '') AS match_key FROM kept)
 SELECT raw_index, match_key FROM k WHERE match_key NOT IN (SELECT match_key FROM k WHERE raw_index % 7 < 3)""",
)
def anti_join_done(spark, sf):
    keyed = I.raw_rows(spark, sf).select("raw_index", X.match_key("transcription", "speaker", "language").alias("match_key"))
    keyed = keyed.where(F.col("match_key").isNotNull())
    return E.anti_join_done(keyed, keyed.where(F.col("raw_index") % 7 < 3), ["match_key"], hashed=True)


ANCHOR_SQL = f"""WITH {I.CLEANED}, keyed AS (SELECT source, raw_index, CASE WHEN text <> '' THEN text || '||' || coalesce(trim(speaker), '') || '||' || coalesce(language, '') END AS key FROM cleaned),
 written AS (SELECT *, row_number() OVER (ORDER BY source, raw_index) AS rn FROM keyed WHERE key IS NOT NULL AND (source = 'src_0' OR (source = 'src_1' AND raw_index <= (SELECT max(doc_id) // 2 FROM documents)))),
 tail AS (SELECT * FROM written ORDER BY rn DESC LIMIT 200), newest AS (SELECT source FROM tail ORDER BY rn DESC LIMIT 1),
 anchors AS (SELECT list(key ORDER BY rn) AS keys FROM (SELECT * FROM tail WHERE source = (SELECT source FROM newest) ORDER BY rn DESC LIMIT 5)),
 runs AS (SELECT source, raw_index, list(key) OVER (PARTITION BY source ORDER BY raw_index ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS keys FROM keyed WHERE key IS NOT NULL)
 SELECT n.source, (SELECT max(raw_index) + 1 FROM runs r, anchors a WHERE r.source = n.source AND r.keys = a.keys) AS resume_raw_index FROM newest n"""


@query("anchor_sequence_search", ANCHOR_SQL)
def anchor_sequence_search(spark, sf):
    raw = I.raw_rows(spark, sf)
    rows = raw.select(
        "source", "raw_index", X.match_key("transcription", "speaker", "language").alias("key"),
        X.has_dialog_text("transcription").alias("has_key"),
    )
    half = I.table(spark, sf, "documents").agg(F.floor(F.max("doc_id") / 2)).scalar()
    written = raw.where(X.has_dialog_text("transcription")).where(
        (F.col("source") == "src_0") | ((F.col("source") == "src_1") & (F.col("raw_index") <= half))
    )
    written = written.select(
        F.col("transcription").alias("text"), "speaker", "language", "source", F.col("source").alias("file_name"),
        F.col("raw_index").alias("row_index"),
    )
    tail = E.tail_rows(written, K.TAIL_ROWS, ["source", "text", "transcript", "speaker", "language"])
    return E.anchor_sequence_search(E.tail_anchors(tail), rows, F.col("has_key"))


@query(
    "reconcile_state",
    """WITH disk AS (SELECT source, count(*) AS rows_on_disk FROM documents GROUP BY source),
 s AS (SELECT source, CAST(substr(source, 4) AS INTEGER) AS k, CASE WHEN CAST(substr(source, 4) AS INTEGER) % 5 = 4 THEN 0 ELSE rows_on_disk END AS r, rows_on_disk AS full_rows FROM disk),
 t AS (SELECT source, k, r, CASE WHEN k % 2 = 0 THEN 'dataset' ELSE 'file' END AS mode, k % 7 <> 6 AS has_state,
 CASE WHEN k % 3 = 0 THEN full_rows - 1 ELSE full_rows END AS written, full_rows + k AS nxt,
 CASE WHEN k % 11 = 10 THEN 'gone' ELSE source END AS cname FROM s),
 u AS (SELECT *, CASE WHEN has_state AND r > 0 AND (mode = 'dataset' OR written = r) THEN greatest(nxt, r) ELSE r END AS resume_from,
 has_state AND cname <> 'gone' AND CASE WHEN r > 0 THEN written = r ELSE mode <> 'dataset' END AS keep FROM t)
 SELECT source, mode, resume_from, CASE WHEN keep THEN cname END AS cursor_name, CAST(CASE WHEN keep THEN k * 10 END AS BIGINT) AS cursor_raw_index FROM u""",
)
def reconcile_state(spark, sf):
    k = F.substring("source", 4, 10).cast("int")
    disk = I.table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    cursor = F.struct(
        F.when(k % 11 == 10, "gone").otherwise(F.col("source")).alias("name"), F.lit("train").alias("split"), (k * 10).cast("long").alias("raw_index")
    )
    state = F.to_json(F.struct(
        F.when(k % 3 == 0, F.col("n") - 1).otherwise(F.col("n")).alias("rows_written"), (F.col("n") + k).alias("next_index"),
        F.when(k % 2 == 0, cursor).alias("cursor"), F.when(k % 2 == 1, cursor).alias("dataset_cursor"),
    ))
    outputs = disk.select(
        "source", F.when(k % 2 == 0, "dataset").otherwise("file").alias("mode"), F.when(k % 7 != 6, state).alias("state_json"),
        F.when(k % 5 != 4, F.col("n")).alias("rows_on_disk"),
    )
    valid = disk.select(F.col("source").alias("name"), F.lit("train").alias("split"))
    return E.reconcile_state(outputs, valid).select("source", "mode", "resume_from", "cursor_name", "cursor_raw_index")


@query(
    "fetch_plan",
    """WITH n AS (SELECT page_id, url, regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1) AS last FROM pages WHERE page_id % 10 <> 9),
 m AS (SELECT page_id, url, page_id || '_' || CASE WHEN last <> '' THEN last ELSE 'arknights_' || page_id || '.wav' END AS name FROM n)
 SELECT page_id AS index, url, name, 4 AS attempts, '0.5,1.0,2.0' AS delays FROM m WHERE NOT (page_id % 4 = 0 AND page_id % 8 = 0)""",
)
def fetch_plan(spark, sf):
    p = F.col("page_id")
    rows = I.table(spark, sf, "pages").select(p.alias("index"), F.when(p % 10 != 9, F.col("url")).alias("url"))
    # Every fourth file exists already, half of those empty.
    inventory = rows.where((F.col("index") % 4 == 0) & F.col("url").isNotNull()).select(
        X.fetch_name("url", "index").alias("name"), F.when(F.col("index") % 8 == 0, 10).otherwise(0).alias("size")
    )
    return E.fetch_plan(rows, inventory, 4, 0.5).withColumn("delays", I.show("delays"))


# ---------------------------------------------------------------- preferences


PAIRS = """docs AS (SELECT d.doc_id, d.source, d.n_chars, l.quality, row_number() OVER (PARTITION BY d.source, l.quality ORDER BY d.doc_id) AS rank
 FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
 pairs AS (SELECT c.source, c.rank, c.doc_id AS chosen_doc_id, r.doc_id AS rejected_doc_id, c.n_chars AS chosen_n_chars, r.n_chars AS rejected_n_chars
 FROM docs c JOIN docs r ON c.source = r.source AND c.rank = r.rank AND c.quality = 1 AND r.quality = 0)"""


def _pairs(spark, sf):
    from ..operators.ordering import dense_position

    docs = I.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    rows = docs.join(I.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    ranked = dense_position(rows, ["source", "quality"], ["doc_id"], name="rank").withColumn("rank", F.col("rank") + 1)
    ranked = ranked.withColumn("chosen", F.col("quality") == 1)
    return Q.pair_preferences(ranked, ["source", "rank"], "chosen", ["doc_id", "n_chars"])


@query("pair_preferences", f"WITH {PAIRS} SELECT source, rank, chosen_doc_id, rejected_doc_id, chosen_n_chars, rejected_n_chars FROM pairs")
def pair_preferences(spark, sf):
    return _pairs(spark, sf)


LOGP = f"""{PAIRS}, lp AS (SELECT source, -chosen_n_chars / 100.0 AS pc, -rejected_n_chars / 90.0 AS pr, -chosen_n_chars / 110.0 AS rc, -rejected_n_chars / 100.0 AS rr FROM pairs)"""


def _logps(spark, sf):
    return _pairs(spark, sf).select(
        "source", (-F.col("chosen_n_chars") / 100).alias("policy_chosen"), (-F.col("rejected_n_chars") / 90).alias("policy_rejected"),
        (-F.col("chosen_n_chars") / 110).alias("ref_chosen"), (-F.col("rejected_n_chars") / 100).alias("ref_rejected"),
    )


def _sql_ls(z: str) -> str:
    return f"(least({z}, 0) - ln(1 + exp(-abs({z}))))"


@query(
    "preference_loss",
    f"""WITH {LOGP}, z AS (SELECT source, CAST((pc - pr) - (rc - rr) AS DOUBLE) AS z FROM lp)
 SELECT source, round(avg(-{_sql_ls('0.1 * z')} * 0.9 - {_sql_ls('-0.1 * z')} * 0.1), 6) AS loss FROM z GROUP BY source""",
)
def preference_loss(spark, sf):
    return P.preference_loss(_logps(spark, sf), 0.1, 0.1, ["source"]).withColumn("loss", F.round("loss", 6))


@query(
    "reward_metrics",
    f"""WITH {LOGP} SELECT source, round(avg(0.1 * (pc - rc) - 0.1 * (pr - rr)), 6) AS reward_margin,
 round(avg(CASE WHEN 0.1 * (pc - rc) > 0.1 * (pr - rr) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM lp GROUP BY source""",
)
def reward_metrics(spark, sf):
    out = P.reward_metrics(_logps(spark, sf), 0.1, ["source"])
    return out.select("source", F.round("reward_margin", 6).alias("reward_margin"), F.round("accuracy", 6).alias("accuracy"))


@query(
    "epoch_loss_summary",
    """WITH e AS (SELECT DISTINCT event_id % 4 AS epoch FROM events) SELECT e.epoch, count(value) AS steps,
 round(coalesce(sum(value), 0) / greatest(count(value), 1), 6) AS mean_loss FROM e LEFT JOIN (SELECT event_id % 3 AS epoch, value FROM events) l ON l.epoch = e.epoch GROUP BY e.epoch""",
)
def epoch_loss_summary(spark, sf):
    events = I.table(spark, sf, "events")
    log = events.select((F.col("event_id") % 3).alias("epoch"), F.col("value").alias("loss"))
    epochs = events.select((F.col("event_id") % 4).alias("epoch")).distinct()
    return P.epoch_loss_summary(log, epochs).withColumn("mean_loss", F.round("mean_loss", 6))


@query(
    "sequence_logprobs",
    f"""WITH {I.VECTORS}, tok AS (SELECT label AS seq, vec AS logits, CASE WHEN vec_id % 7 = 0 THEN -100 ELSE vec_id % 64 END AS lab FROM vectors WHERE label <> 9),
 sub0 AS (SELECT label AS seq, vec_id, vec, unnest(range(0, 15)) AS k FROM vectors WHERE label <> 9 AND vec_id % 7 <> 0),
 sub AS (SELECT seq, vec[k * 4 + 1 : k * 4 + 4] AS logits, (vec_id + k) % 4 AS lab FROM sub0),
 lp AS (SELECT seq, logits[lab + 1] - list_max(logits) - ln(list_sum(list_transform(logits, lambda x: exp(x - list_max(logits))))) AS p
 FROM (SELECT * FROM tok WHERE lab <> -100 UNION ALL SELECT * FROM sub))
 SELECT s.seq, round(coalesce(sum(p), 0), 6) AS logprob FROM (SELECT DISTINCT label AS seq FROM vectors) s LEFT JOIN lp ON lp.seq = s.seq GROUP BY s.seq""",
)
def sequence_logprobs(spark, sf):
    v = I.vectors(spark, sf)
    used = v.where(F.col("label") != 9).withColumnRenamed("label", "seq")
    tokens = used.select(
        "seq", F.col("vec").alias("logits"), F.when(F.col("vec_id") % 7 == 0, K.LABEL_IGNORE).otherwise(F.col("vec_id") % 64).alias("label")
    )
    frames = used.where(F.col("vec_id") % 7 != 0)
    subcodes = frames.select("seq", "vec_id", "vec", F.explode(F.sequence(F.lit(0), F.lit(14))).alias("k")).select(
        "seq", F.slice("vec", F.col("k") * 4 + 1, 4).alias("logits"), ((F.col("vec_id") + F.col("k")) % 4).alias("label")
    )
    sequences = v.select(F.col("label").alias("seq")).distinct()
    return P.sequence_logprobs(sequences, tokens, subcodes).withColumn("logprob", F.round("logprob", 6))
