"""Token sequences: parsing, cutting, training layouts, padding, chunks, lengths, templates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import audio as U
from ..functions import text as X
from ..operators import sequences as S
from ..session import spread
from . import inputs as I
from .registry import query

FRAMES = "frames"
CODES = f"c AS (SELECT doc_id, n_chars, {I.sql_codes()} AS codes FROM documents)"
END_CODES = f"c AS (SELECT doc_id, n_chars, {I.sql_codes(True)} AS codes FROM documents)"
BATCH = ["source", "batch"]


@query(
    "parse_codes",
    f"""WITH {CODES}, p AS (SELECT doc_id, CASE WHEN doc_id % 4 <> 3 THEN codes
 WHEN len(codes) = 16 THEN list_transform(range(1, 16), lambda q: list_transform(codes, lambda f: f[q])) END AS codes FROM c)
 SELECT doc_id, CASE WHEN codes IS NOT NULL THEN {I.sql_rows('codes')} END AS codes,
 CASE WHEN codes IS NOT NULL THEN {I.sql_show('list_transform(codes, lambda f: f[1])')} END AS c0 FROM p""",
)
def parse_codes(spark, sf):
    rows = I.code_rows(spark, sf)
    turned = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda q: F.transform("codes", lambda f: F.get(f, q)))
    flat = F.transform("codes", lambda f: F.slice(f, 1, 15))
    # A 16-frame document is square when turned, so it is left upright. Frames of 15 codes are an error, except
    # that 16 of them read as a turned matrix.
    shape = F.when((F.col("doc_id") % 4 == 1) & (F.size("codes") != 16), turned).when(F.col("doc_id") % 4 == 3, flat)
    given = rows.withColumn("codes", F.coalesce(shape, "codes"))
    parsed = given.withColumn("codes", A.parse_codes("codes"))
    return parsed.select("doc_id", I.show_rows("codes").alias("codes"), I.show(A.first_codes("codes")).alias("c0"))


@query(
    "truncate_at_eos",
    f"""WITH {END_CODES}, p AS (SELECT *, coalesce(list_position(list_transform(codes, lambda f: f[1]), 4198), 0) AS stop FROM c)
 SELECT doc_id, {I.sql_rows('CASE WHEN stop > 0 THEN codes[1:stop-1] ELSE codes END')} AS codes FROM p""",
)
def truncate_at_eos(spark, sf):
    rows = I.code_rows(spark, sf, True)
    return rows.select("doc_id", I.show_rows(A.truncate_at_eos("codes")).alias("codes"))


@query(
    "prepend_reference_codes",
    f"""WITH {CODES} SELECT doc_id, {I.sql_rows('CASE WHEN doc_id % 3 = 0 THEN codes ELSE list_concat(codes[1:doc_id % 5], codes) END')} AS codes FROM c""",
)
def prepend_reference_codes(spark, sf):
    rows = I.code_rows(spark, sf)
    reference = F.when(F.col("doc_id") % 3 != 0, F.slice("codes", 1, (F.col("doc_id") % 5).cast("int")))
    return rows.select("doc_id", I.show_rows(A.prepend_codes(reference, "codes")).alias("codes"))


@query(
    "trim_template_ids",
    f"""WITH t AS (SELECT doc_id, {I.sql_text_ids('text')} AS ids FROM documents) SELECT doc_id, {I.sql_show('ids[1:len(ids)-5]')} AS text_ids,
 {I.sql_show('ids[4:len(ids)-2]')} AS reference_ids, {I.sql_show('ids[4:len(ids)-5]')} AS body_ids FROM t""",
)
def trim_template_ids(spark, sf):
    rows = I.with_text_ids(spread(I.table(spark, sf, "documents").select("doc_id", "text")))
    return rows.select(
        "doc_id", I.show(A.drop_ends("ids", 0, 5)).alias("text_ids"), I.show(A.drop_ends("ids", 3, 2)).alias("reference_ids"),
        I.show(A.drop_ends("ids", 3, 5)).alias("body_ids"),
    )


def _cat(*parts: str) -> str:
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


SQL_TEXT_CHANNEL = _cat("text_ids[1:3]", "[151671,151671,151671,151671,151672]", "text_ids[4:]", "[151673]", I.sql_rep("151671", "lc + 2"))
SQL_CODEC_CHANNEL = _cat("[0,0,0,4203,4204,4205,0,4196]", I.sql_rep("4196", "lt - 2"), "[4197]", "c0", "[4198]")
SQL_LABELS = _cat(I.sql_rep("-100", "lt + 7"), "c0", "[4198]")
SQL_ZERO = "[0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0]"
SQL_MATRIX = _cat(I.sql_rep(SQL_ZERO, "lt + 7"), "codes", f"[{SQL_ZERO}]")


def _padded(x: str, fill: str, extra: str = "width - (lt + lc + 8)") -> str:
    return _cat(x, I.sql_rep(fill, extra))


def _layout(spark, sf, name):
    return S.assemble_sequences(I.layout_rows(spark, sf), "text_ids", "codes", BATCH, {name}, "width", as_text=True)


@query("sequence_text_channel", f"WITH {I.LAYOUT} SELECT doc_id, {I.sql_show(_padded(SQL_TEXT_CHANNEL, '0'))} AS ids FROM lay")
def sequence_text_channel(spark, sf):
    return _layout(spark, sf, "text_channel").select("doc_id", F.col("text_channel").alias("ids"))


@query("sequence_codec_channel", f"WITH {I.LAYOUT} SELECT doc_id, {I.sql_show(_padded(SQL_CODEC_CHANNEL, '0'))} AS ids FROM lay")
def sequence_codec_channel(spark, sf):
    return _layout(spark, sf, "codec_channel").select("doc_id", F.col("codec_channel").alias("ids"))


@query("sequence_labels", f"WITH {I.LAYOUT} SELECT doc_id, {I.sql_show(_padded(SQL_LABELS, '-100'))} AS labels FROM lay")
def sequence_labels(spark, sf):
    return _layout(spark, sf, "labels").select("doc_id", "labels")


@query("sequence_code_matrix", f"WITH {I.LAYOUT} SELECT doc_id, {I.sql_rows(_padded(SQL_MATRIX, SQL_ZERO))} AS code_matrix FROM lay")
def sequence_code_matrix(spark, sf):
    return _layout(spark, sf, "code_matrix").select("doc_id", "code_matrix")


def _sql_mask(test: str, width: str = "width") -> str:
    return I.sql_flags(f"list_transform(range(0, {width}), lambda i: {test})")


@query(
    "sequence_masks",
    f"""WITH {I.LAYOUT} SELECT doc_id, {_sql_mask('i < lt + lc + 8')} AS attention_mask, {_sql_mask('i < lt + lc + 8')} AS text_embedding_mask,
 {_sql_mask('i >= 3 AND i < lt + lc + 8 AND i <> 6')} AS codec_embedding_mask, {_sql_mask('i >= lt + 7 AND i < lt + 7 + lc')} AS codec_mask FROM lay""",
)
def sequence_masks(spark, sf):
    names = ["attention_mask", "text_embedding_mask", "codec_embedding_mask", "codec_mask"]
    rows = S.assemble_sequences(I.layout_rows(spark, sf), "text_ids", "codes", BATCH, set(names), "width", as_text=True)
    return rows.select("doc_id", *names)


@query(
    "pad_right_batch",
    f"""WITH {I.LAYOUT}, w AS (SELECT *, max(lc) OVER (PARTITION BY source, batch) AS cw FROM lay)
 SELECT doc_id, {I.sql_show(_padded('c0', '-100', 'cw - lc'))} AS c0, {_sql_mask('i < lc', 'cw')} AS mask FROM w""",
)
def pad_right_batch(spark, sf):
    rows = I.layout_rows(spark, sf).withColumn("c0", A.first_codes("codes"))
    return S.pad_right_batch(rows, "c0", BATCH, -100, width="code_width").select("doc_id", I.show("c0").alias("c0"), I.show_flags("mask").alias("mask"))


@query(
    "pad_left_batch",
    f"""WITH {I.LAYOUT}, w AS (SELECT *, max(lc) OVER (PARTITION BY source, batch) AS cw FROM lay)
 SELECT doc_id, {I.sql_show(_cat(I.sql_rep('0', 'cw - lc'), 'c0'))} AS c0, {_sql_mask('i >= cw - lc', 'cw')} AS mask FROM w""",
)
def pad_left_batch(spark, sf):
    rows = I.layout_rows(spark, sf).withColumn("c0", A.first_codes("codes"))
    return S.pad_left_batch(rows, "c0", BATCH, 0, width="code_width").select("doc_id", I.show("c0").alias("c0"), I.show_flags("mask").alias("mask"))


INSTRUCT = f"""{I.LAYOUT}, ins0 AS (SELECT *, CASE WHEN doc_id % 3 = 0 OR batch % 4 = 1 THEN [] ELSE text_ids[4:3 + doc_id % 7] END AS ids FROM lay),
 ins AS (SELECT *, len(ids) AS li, max(len(ids)) OVER (PARTITION BY source, batch) AS iw FROM ins0)"""


def _instruct(spark, sf):
    none = (F.col("doc_id") % 3 == 0) | (F.col("batch") % 4 == 1)
    ids = F.when(~none, F.slice("text_ids", 4, (F.col("doc_id") % 7).cast("int")))
    return S.instruct_pad_mask(I.layout_rows(spark, sf).withColumn("ids", ids), "ids", BATCH)


@query(
    "instruct_pad_mask",
    f"WITH {INSTRUCT} SELECT doc_id, {I.sql_show(_cat('ids', I.sql_rep('0', 'iw - li')))} AS ids, {_sql_mask('i < li', 'iw')} AS mask FROM ins",
)
def instruct_pad_mask(spark, sf):
    return _instruct(spark, sf).select("doc_id", I.show("ids").alias("ids"), I.show_flags("instruct_mask").alias("mask"))


@query(
    "instruct_prefix",
    f"""WITH {INSTRUCT} SELECT doc_id, {_sql_mask('i < li', 'iw')} || {_sql_mask('i < lt + lc + 8')} AS attention_mask,
 {_sql_mask('false', 'iw')} || {_sql_mask('i >= lt + 7 AND i < lt + 7 + lc')} AS codec_mask,
 {I.sql_show(_cat(I.sql_rep('-100', 'iw'), _padded(SQL_LABELS, '-100')))} AS labels,
 iw + width AS code_rows FROM ins""",
)
def instruct_prefix(spark, sf):
    shown = {"attention_mask", "codec_mask", "labels"}
    rows = S.assemble_sequences(_instruct(spark, sf), "text_ids", "codes", BATCH, {*shown, "code_matrix"}, "width", shown)
    return S.instruct_prefix(rows, as_text=shown).select(
        "doc_id", "attention_mask", "codec_mask", "labels", F.size("code_matrix").cast("long").alias("code_rows")
    )


@query(
    "shift_for_prediction",
    f"""WITH {I.LAYOUT}, s AS (SELECT doc_id, {_padded(SQL_CODEC_CHANNEL, '0')} AS inputs, {_padded(SQL_LABELS, '-100')} AS labels FROM lay)
 SELECT doc_id, {I.sql_show('inputs[1:len(inputs)-1]')} AS inputs, {I.sql_show('labels[2:]')} AS labels FROM s""",
)
def shift_for_prediction(spark, sf):
    rows = S.assemble_sequences(I.layout_rows(spark, sf), "text_ids", "codes", BATCH, {"codec_channel", "labels"}, "width", as_text=True)
    rows = S.shift_for_prediction(rows, ["codec_channel"], ["labels"], as_text=True)
    return rows.select("doc_id", F.col("codec_channel").alias("inputs"), "labels")


@query(
    "masked_frame_gather",
    f"""WITH {I.LAYOUT}, g AS (SELECT doc_id, lt, unnest(codes) AS frame, generate_subscripts(codes, 1) AS k FROM lay)
 SELECT doc_id, CAST(lt + 6 + k AS INTEGER) AS position, {I.sql_show('frame')} AS frame FROM g""",
)
def masked_frame_gather(spark, sf):
    rows = S.frames_by_offset(I.layout_rows(spark, sf), "doc_id", "codes", F.size("text_ids") + 7)
    return rows.withColumn("frame", I.show("frame"))


@query(
    "subcode_inputs_labels",
    f"""WITH {CODES}, g AS (SELECT doc_id, unnest(codes) AS frame, CAST(generate_subscripts(codes, 1) - 1 AS INTEGER) AS t FROM c)
 SELECT doc_id, t, {I.sql_show('frame[1:15]')} AS inputs, {I.sql_show('frame[2:16]')} AS labels FROM g""",
)
def subcode_inputs_labels(spark, sf):
    rows = I.code_rows(spark, sf).select("doc_id", F.posexplode("codes").alias("t", "frame"))
    rows = S.subcode_inputs_labels(rows)
    return rows.select("doc_id", "t", I.show("inputs").alias("inputs"), I.show("labels").alias("labels"))


@query(
    "align_text_codec",
    f"""WITH {I.LAYOUT}, a AS (SELECT doc_id, text_ids, c0, lt, lc FROM lay)
 SELECT doc_id, {I.sql_show(_cat('text_ids[1:lc]', I.sql_rep('151671', 'lc - lt')))} AS text_side, {I.sql_show('c0')} AS codec_side,
 {I.sql_show('text_ids[lc + 1:]')} AS remainder FROM a""",
)
def align_text_codec(spark, sf):
    rows = I.with_text_ids(I.code_rows(spark, sf, extra=("text",)), "text_ids").withColumn("text_ids", A.drop_ends("text_ids", 0, 5))
    rows = rows.withColumn("c0", A.first_codes("codes"))
    return rows.select(
        "doc_id", I.show(A.aligned_text("text_ids", "c0")).alias("text_side"), I.show("c0").alias("codec_side"),
        I.show(A.remaining_text("text_ids", "c0")).alias("remainder"),
    )


@query(
    "codec_prefill",
    f"""WITH {I.LANGUAGES}, {I.SPEAKERS}, {I.REQUESTS}, j AS (SELECT request_id, CASE WHEN lower(r.language) = 'auto' THEN NULL ELSE language_id END AS lid, speaker_id AS sid
 FROM requests r LEFT JOIN languages l ON lower(r.language) = l.language LEFT JOIN speakers s ON lower(r.speaker) = s.speaker)
 SELECT request_id, {I.sql_show(_cat('CASE WHEN lid IS NULL THEN [4203,4204,4205] ELSE [4202,4204,lid,4205] END', 'CASE WHEN sid IS NULL THEN [] ELSE [sid] END', '[4196,4197]'))} AS ids FROM j""",
)
def codec_prefill(spark, sf):
    from ..operators.requests import join_language_id

    rows = join_language_id(I.requests(spark, sf), I.languages(spark, sf)).withColumn("speaker", F.lower("speaker"))
    rows = rows.join(I.speakers(spark, sf).select("speaker", "speaker_id"), "speaker", "left")
    return rows.select("request_id", I.show(A.codec_prefill(F.col("language_id"), F.col("speaker_id"))).alias("ids"))


@query(
    "context_chunks",
    """WITH s AS (SELECT doc_id, n_chars AS t, unnest(range(0, n_chars, 300)) AS start FROM documents),
 e AS (SELECT doc_id, start, least(start + 300, t) AS "end", CASE WHEN start - 25 > 0 THEN 25 ELSE start END AS context FROM s)
 SELECT doc_id, start, "end", context, "end" - start + context AS n_frames, (doc_id + start - context) % 2048 AS first_code FROM e""",
)
def context_chunks(spark, sf):
    code = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_chars") - 1), lambda t: (F.col("doc_id") + t) % 2048)
    rows = I.table(spark, sf, "documents").select("doc_id", code.alias("codes"))
    out = S.context_chunks(rows, "codes", ["doc_id"])
    return out.select(
        "doc_id", "start", "end", "context", F.size("frames").cast("long").alias("n_frames"), F.col("frames")[0].alias("first_code")
    )


@query(
    "code_durations",
    f"""WITH {CODES}, v AS (SELECT doc_id, len(codes) AS total, len(list_filter(codes, lambda f: f[1] > 0)) * 1920 AS samples,
 len(list_filter(codes, lambda f: f[1] <= 0)) AS zero_frames FROM c)
 SELECT doc_id, samples, zero_frames, CAST(floor(CAST(doc_id % 10 AS DOUBLE) / greatest(total, 1) * samples) AS BIGINT) AS cut FROM v""",
)
def code_durations(spark, sf):
    rows = I.code_rows(spark, sf).withColumn("c0", A.first_codes("codes"))
    rows = rows.withColumns({"samples": U.voiced_samples("c0"), "zero_frames": U.zero_code_frames("c0").cast("long")})
    return rows.select(
        "doc_id", "samples", "zero_frames", U.reference_cut(F.col("doc_id") % 10, F.size("codes"), "samples").alias("cut")
    )


@query(
    "clip_lengths",
    """WITH n AS (SELECT doc_id, n_chars * 37 AS frames, CASE doc_id % 3 WHEN 0 THEN 16000 WHEN 1 THEN 24000 ELSE 0 END AS rate FROM documents),
 m AS (SELECT *, CAST(ceil(frames / 640.0) AS BIGINT) * 4 AS mel2, CAST(ceil(frames / 320.0) AS BIGINT) * 2 AS mel1 FROM n)
 SELECT doc_id, CASE WHEN frames > 0 AND rate > 0 THEN CAST(floor(frames * (CAST(24000 AS DOUBLE) / rate)) AS BIGINT) END AS resampled,
 CAST(ceil(frames / 1920.0) AS BIGINT) AS code_frames, CASE WHEN frames >= 256 THEN frames // 256 ELSE 0 END AS mel_frames,
 CASE WHEN frames >= 160 THEN frames // 160 ELSE 0 END AS mel_frames_16k,
 (mel1 + 1) // 2 AS asr_codes, ((mel2 + 1) // 2) // 2 AS asr_codes_half FROM m""",
)
def clip_lengths(spark, sf):
    d = F.col("doc_id")
    rate = F.when(d % 3 == 0, 16000).when(d % 3 == 1, 24000).otherwise(0)
    rows = I.table(spark, sf, "documents").select("doc_id", (F.col("n_chars") * 37).alias("frames"), rate.alias("rate"))
    return rows.select(
        "doc_id", U.resampled_length("frames", "rate").alias("resampled"), U.code_frames("frames").alias("code_frames"),
        U.mel_frames("frames").alias("mel_frames"), U.mel_frames("frames", 1024, 160).alias("mel_frames_16k"),
        U.asr_code_length("frames").alias("asr_codes"), U.asr_code_length("frames", 2).alias("asr_codes_half"),
    )


@query(
    "chat_templates",
    """SELECT doc_id, '<|im_start|>assistant' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS assistant,
 '<|im_start|>assistant' || chr(10) || text || '<|im_end|>' || chr(10) AS reference,
 CASE WHEN doc_id % 3 = 2 THEN '<|im_start|>user' || chr(10) || source || '<|im_end|>' || chr(10) END AS instruct FROM documents""",
)
def chat_templates(spark, sf):
    rows = I.table(spark, sf, "documents")
    instruct = F.when(F.col("doc_id") % 3 == 1, "").when(F.col("doc_id") % 3 == 2, F.col("source"))
    return rows.select(
        "doc_id", X.assistant_prompt("text").alias("assistant"), X.reference_prompt("text").alias("reference"),
        X.instruct_prompt(instruct).alias("instruct"),
    )
