"""Clip tables and user-callable jobs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import audio as U
from ..operators import cleaning as C
from ..operators import clips as A
from ..operators import synthesis as Y
from . import inputs as I
from .registry import query

# 16-bit samples of a clip, as SQL.
PCM = "list_transform(samples, lambda x: least(32767, greatest(-32768, floor(x * 32768))))"


@query(
    "encode_clips",
    f"""WITH {I.CLIPS}, p AS (SELECT clip_id, rate, {PCM} AS pcm FROM clips)
 SELECT clip_id, 44 + 2 * len(pcm) AS n_bytes, rate,
 array_to_string(list_transform(pcm, lambda x: printf('%02X%02X', CAST(x AS INTEGER) & 255, (CAST(x AS INTEGER) >> 8) & 255)), '') AS body FROM p""",
)
def encode_clips(spark, sf):
    rows = A.encode_clips(I.clips(spark, sf))
    return rows.select(
        "clip_id", F.octet_length("bytes").cast("long").alias("n_bytes"), "rate", F.hex(F.substring("bytes", 45, 1 << 30)).alias("body")
    )


@query(
    "decode_clips",
    f"""WITH {I.CLIPS}, p AS (SELECT clip_id, rate, {PCM} AS pcm FROM clips)
 SELECT clip_id, CASE WHEN clip_id % 9 <> 4 THEN rate END AS rate, CASE WHEN clip_id % 9 <> 4 THEN len(pcm) END AS n_samples,
 CASE WHEN clip_id % 9 <> 4 THEN round(list_sum(list_transform(pcm, lambda x: x / 32768.0)), 5) END AS total, clip_id % 9 = 4 AS undecodable FROM p""",
)
def decode_clips(spark, sf):
    rows = A.encode_clips(I.clips(spark, sf)).drop("samples", "rate")
    broken = F.when(F.col("clip_id") % 9 == 4, F.encode(F.lit("no clip"), "utf-8")).otherwise(F.col("bytes"))
    out = A.decode_clips(rows.withColumn("bytes", broken))
    total = F.aggregate(F.col("samples").cast("array<double>"), F.lit(0.0), lambda s, x: s + x)
    return out.select(
        "clip_id", "rate", F.when(~F.col("undecodable"), F.size("samples").cast("long")).alias("n_samples"),
        F.round(total, 5).alias("total"), "undecodable",
    )


@query(
    "clip_report",
    f"""WITH {I.CLIPS}, r AS (SELECT source, len(samples) / CAST(rate AS DOUBLE) AS seconds, floor(len(samples) * (CAST(24000 AS DOUBLE) / rate)) AS n,
 list_min(samples) < -0.3 OR list_max(samples) > 0.3 AS loud FROM clips)
 SELECT source, count(*) AS clips, round(sum(seconds), 6) AS seconds, CAST(sum(ceil(n / 1920)) AS BIGINT) AS code_frames, count(*) FILTER (WHERE loud) AS out_of_range FROM r GROUP BY source""",
)
def clip_report(spark, sf):
    # Scaled so that what was above 0.3 leaves [-1, 1].
    loud = I.clips(spark, sf).withColumn("samples", F.transform(F.col("samples").cast("array<double>"), lambda x: x / 0.3))
    return A.clip_totals(A.clip_report(loud)).withColumn("seconds", F.round("seconds", 6))


@query(
    "pcm_normalize",
    f"""WITH {I.CLIPS}, p AS (SELECT clip_id, list_transform(samples, lambda x: floor(x * 100)) AS i8, list_transform(samples, lambda x: x * 4) AS f, list_max(list_transform(samples, lambda x: abs(x * 4))) AS peak FROM clips)
 SELECT clip_id, array_to_string(list_transform(i8, lambda x: printf('%.6f', round(x / 128.0, 6) + 0.0)), ',') AS signed8,
 array_to_string(list_transform(i8, lambda x: printf('%.6f', round((x + 128 - 128.0) / 128.0, 6) + 0.0)), ',') AS unsigned8,
 array_to_string(list_transform(f, lambda x: printf('%.6f', round(greatest(-1.0, least(1.0, x / CASE WHEN peak <= 1 + 1e-6 THEN 1.0 ELSE peak + 1e-12 END)), 6) + 0.0)), ',') AS floats FROM p""",
)
def pcm_normalize(spark, sf):
    from .vector_queries import _round

    doubles = F.col("samples").cast("array<double>")
    eight = F.transform(doubles, lambda x: F.floor(x * 100).cast("int"))
    rows = I.clips(spark, sf).withColumns(
        {"i8": eight, "u8": F.transform(eight, lambda x: x + 128), "f": F.transform(doubles, lambda x: x * 4)}
    )
    return rows.select(
        "clip_id", _round(U.integer_pcm("i8", 8)).alias("signed8"), _round(U.integer_pcm("u8", 8, False)).alias("unsigned8"),
        _round(U.float_pcm("f")).alias("floats"),
    )


@query(
    "frame_signal",
    f"""WITH {I.CLIPS}, p AS (SELECT clip_id, list_concat(list_concat(list_reverse(samples[2:13]), samples), list_reverse(samples[52:63])) AS w FROM clips),
 f AS (SELECT clip_id, w, unnest(range(0, len(w) - 32 + 1, 8)) AS s, generate_subscripts(range(0, len(w) - 32 + 1, 8), 1) - 1 AS frame FROM p)
 SELECT clip_id, CAST(frame AS INTEGER) AS frame, round(list_sum(w[s + 1 : s + 32]), 5) AS total, round(w[s + 1], 6) AS first_value FROM f""",
)
def frame_signal(spark, sf):
    rows = I.clips(spark, sf).withColumn("samples", F.col("samples").cast("array<double>"))
    out = A.frame_signal(rows, ["clip_id"], 32, 8)
    total = F.aggregate("window", F.lit(0.0), lambda s, x: s + x)
    return out.select("clip_id", "frame", F.round(total, 5).alias("total"), F.round(F.col("window")[0], 6).alias("first_value"))


def _stats(rows, name):
    flat = F.flatten(name).cast("array<double>")
    mean = F.aggregate(flat, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.size(flat), F.lit(1))
    return rows.select(
        "clip_id", F.size(name).alias("n_frames"), F.size(F.get(F.col(name), F.lit(0))).alias("n_bins"), F.round(mean, 4).alias("mean"),
        F.round(F.array_max(flat), 4).alias("top"), F.round(F.array_min(flat), 4).alias("low"),
    )


# Spectra, resampling and model calls are checked against brute force in tests/, not in SQL.


@query("log_mel_features")
def log_mel_features(spark, sf):
    return _stats(A.log_mel_features(I.long_clips(spark, sf)), "mel")


@query("asr_log_mel")
def asr_log_mel(spark, sf):
    return _stats(A.asr_log_mel(I.long_clips(spark, sf), 80), "mel")


@query("resample_clips")
def resample_clips(spark, sf):
    out = A.resample_clips(I.long_clips(spark, sf))
    doubles = F.col("samples").cast("array<double>")
    energy = F.aggregate(doubles, F.lit(0.0), lambda s, x: s + x * x)
    return out.select("clip_id", "rate", F.size("samples").alias("n_samples"), F.round(energy, 4).alias("energy"))


@query(
    "audio_value_unify",
    f"""WITH {I.CLIPS}, p AS (SELECT clip_id, rate, {PCM} AS pcm FROM clips)
 SELECT clip_id, CASE clip_id % 5 WHEN 0 THEN 'Supplier#' || lpad(CAST(clip_id % 200 AS VARCHAR), 9, '0') WHEN 1 THEN 'own.wav' WHEN 2 THEN 'voices_' || clip_id || '.wav'
 WHEN 3 THEN 'Supplier#000000003' END AS path, CASE clip_id % 5 WHEN 0 THEN (SELECT octet_length(encode('s' || s_suppkey)) FROM supplier WHERE s_suppkey = clip_id % 200)
 WHEN 1 THEN octet_length(encode(source)) WHEN 2 THEN 44 + 2 * len(pcm) WHEN 3 THEN 2 END AS n_bytes FROM p JOIN (SELECT clip_id, source FROM clips) USING (clip_id)""",
)
def audio_value_unify(spark, sf):
    c = F.col("clip_id")
    kind = c % 5
    text, none = F.lit(None).cast("string"), F.lit(None)
    audio = F.struct(
        F.when(kind == 1, F.encode("source", "utf-8")).otherwise(none).alias("bytes"),
        F.when(kind == 1, "own.wav").otherwise(text).alias("path"),
        F.when(kind == 3, "Supplier#000000003").otherwise(text).alias("filename"),
        F.when(kind == 2, F.col("samples")).alias("samples"),
        F.when(kind == 2, F.col("rate")).alias("rate"),
    )
    rows = I.clips(spark, sf).select(
        "clip_id", "source", audio.alias("audio"),
        F.when(kind == 0, F.concat(F.lit("Supplier#"), F.lpad((c % 200).cast("string"), 9, "0"))).alias("audio_path"),
    )
    files = I.table(spark, sf, "supplier").select(
        F.col("s_name").alias("path"), F.encode(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), "utf-8").alias("content")
    )
    out = C.audio_value_unify(rows, "some/voices", "clip_id", files)
    return out.select("clip_id", F.col("audio_value.path").alias("path"), F.octet_length("audio_value.bytes").cast("long").alias("n_bytes"))


# ---------------------------------------------------------------- user callables


def parity_encoder(batch: pd.DataFrame) -> list:
    """Stand-in encoder: 16 codes per frame of 8 samples, from scaled sums."""
    out = []
    for wave in batch["samples"]:
        sums = [int(sum(float(v) * 1000 // 1 for v in wave[at : at + 8])) for at in range(0, len(wave), 8)]
        out.append([[(s + q) % 2048 for q in range(16)] for s in sums])
    return out


ENCODED = f"""{I.CLIPS}, s AS (SELECT clip_id, list_transform(range(0, 8), lambda k: CAST(list_sum(list_transform(samples[k * 8 + 1 : k * 8 + 8], lambda x: floor(x * 1000))) AS BIGINT)) AS sums FROM clips),
 e AS (SELECT clip_id, list_transform(sums, lambda v: list_transform(range(0, 16), lambda q: ((v + q) % 2048 + 2048) % 2048)) AS codes FROM s)"""


@query("batch_encoder_udf", f"WITH {ENCODED} SELECT clip_id, {I.sql_rows('codes')} AS codes FROM e")
def batch_encoder_udf(spark, sf):
    out = Y.batch_encoder_udf(I.clips(spark, sf), parity_encoder, inputs=["clip_id", "samples"])
    return out.select("clip_id", I.show_rows("audio_codes").alias("codes"))


def tight_encoder(batch: pd.DataFrame) -> list:
    """Runs out of memory on more than five clips, and on every clip divisible by 17."""
    if len(batch) > 5 or (batch["clip_id"] % 17 == 0).any():
        raise RuntimeError("CUDA out of memory")
    return parity_encoder(batch)


@query("bisect_on_error", f"WITH {ENCODED} SELECT clip_id, {I.sql_rows('codes')} AS codes FROM e WHERE clip_id % 17 <> 0")
def bisect_on_error(spark, sf):
    out = Y.attach_codes(I.clips(spark, sf), tight_encoder, inputs=["clip_id", "samples"])
    return out.select("clip_id", I.show_rows("audio_codes").alias("codes"))


@query(
    "tokenize_udf",
    "SELECT doc_id, array_to_string(list_transform(string_split(text, ''), lambda ch: unicode(ch)), ',') AS ids FROM documents",
)
def tokenize_udf(spark, sf):
    ids = Y.tokenize_udf(Y.code_points)
    return I.table(spark, sf, "documents").select("doc_id", I.show(ids("text")).alias("ids"))


@query(
    "build_clone_prompts",
    f"""WITH {ENCODED} SELECT clip_id, CASE WHEN clip_id % 3 <> 0 THEN {I.sql_rows('codes')} END AS ref_code, clip_id % 3 = 0 AS x_vector_only_mode,
 clip_id % 3 <> 0 AS icl_mode, 'text ' || clip_id AS ref_text, round(list_sum(c.samples), 5) AS vector_total FROM e JOIN clips c USING (clip_id)""",
)
def build_clone_prompts(spark, sf):
    clips = I.clips(spark, sf).withColumns(
        {"x_vector_only_mode": F.when(F.col("clip_id") % 3 == 0, True), "ref_text": F.concat(F.lit("text "), F.col("clip_id").cast("string"))}
    )
    coded = Y.batch_encoder_udf(clips, parity_encoder, inputs=["clip_id", "samples"])
    out = Y.build_clone_prompts(coded, F.col("samples").cast("array<double>"), F.col("audio_codes"), ["clip_id"])
    total = F.aggregate("ref_spk_embedding", F.lit(0.0), lambda s, x: s + x)
    return out.select(
        "clip_id", I.show_rows("ref_code").alias("ref_code"), "x_vector_only_mode", "icl_mode", "ref_text", F.round(total, 5).alias("vector_total")
    )


def echo_model(batch: pd.DataFrame) -> list:
    """Stand-in model: prompt length and language id."""
    return [[len(p), -1 if pd.isna(i) else int(i)] for p, i in zip(batch["prompt"], batch["language_id"])]


@query(
    "batch_synthesis_job",
    f"""WITH {I.LANGUAGES}, {I.REQUESTS} SELECT request_id, CASE WHEN r.language IS NULL OR (lower(r.language) <> 'auto' AND l.language IS NULL) THEN NULL
 ELSE (length(text) + 55) || ',' || coalesce(CASE WHEN lower(r.language) <> 'auto' THEN language_id END, -1) END AS codes,
 CASE WHEN r.language IS NULL OR (lower(r.language) <> 'auto' AND l.language IS NULL) THEN 'unsupported language' END AS error
 FROM requests r LEFT JOIN languages l ON lower(r.language) = l.language""",
)
def batch_synthesis_job(spark, sf):
    out = Y.batch_synthesis_job(I.requests(spark, sf), echo_model, I.languages(spark, sf))
    return out.select("request_id", I.show("codes").alias("codes"), "error")
