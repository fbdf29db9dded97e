"""Source rows to canonical rows: names, cleaning, filters, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import text as X
from ..session import join_small_or_salted
from .ordering import cap_per_source

AUDIO = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())])
CODES = T.ArrayType(T.ArrayType(T.IntegerType()))


def language_column(df: DataFrame) -> Column:
    """Raw language of a row: the first candidate column that exists, null when none does."""
    name = X.first_existing(df.columns, K.LANGUAGE_COLUMNS)
    return F.col(name) if name else F.lit(None).cast("string")


def rejected_codes_column(df: DataFrame) -> Column:
    name = X.first_existing(df.columns, K.REJECTED_CODE_COLUMNS)
    if name is None:
        raise ValueError("none of the rejected-code columns exists: " + ", ".join(K.REJECTED_CODE_COLUMNS))
    return F.col(name)


def require_column(df: DataFrame, name: str) -> Column:
    """A column that has to exist; its values may be null."""
    if name not in df.columns:
        raise ValueError(f"missing required column {name}")
    return F.col(name)


def allowed_languages(names: list[str | None]) -> list[str]:
    """Allow-list in normal form: trimmed, lower-cased, variants folded, nulls dropped."""
    fold = {v: name for name, variants in K.LANGUAGE_ALIASES.items() for v in variants}
    plain = [n.strip().lower() for n in names if n is not None]
    return sorted({fold.get(n, n) for n in plain})


def filter_language_allowed(df: DataFrame, allowed: list[str], language: str = "language") -> DataFrame:
    """Keep rows whose normalised language is listed; an empty list keeps everything."""
    return df.where(F.col(language).isin(*allowed)) if allowed else df


def filter_has_text(df: DataFrame, raw: str, markup: bool = True, into: str = "text") -> DataFrame:
    """Drop rows that are blank before cleaning or empty after it, and clean the rest.

    With ``markup`` tags and braces are removed; without, blanks are collapsed only.
    """
    if markup:
        return df.where(X.has_dialog_text(raw)).withColumn(into, X.clean_dialog_text(raw))
    return df.where(~X.is_blank(raw)).withColumn(into, X.collapse_whitespace(raw))


def filter_has_audio(df: DataFrame, audio: str = "audio") -> DataFrame:
    return df.where(F.col(audio)["bytes"].isNotNull())


def filter_max_duration(df: DataFrame, seconds: float | None, frames: str, rate: str) -> DataFrame:
    """Drop clips longer than ``seconds``; null means no limit. A clip at rate 0 has no duration and is dropped."""
    if seconds is None:
        return df
    return df.where(F.try_divide(F.col(frames), F.col(rate)) <= seconds)


def canonical_row(df: DataFrame, source: Column, extra: list[str] | None = None) -> DataFrame:
    """The canonical columns: audio struct, text, source, speaker as string, language or null when empty."""
    return df.select(
        *(extra or []),
        F.col("audio"),
        F.col("text"),
        source.alias("source"),
        F.col("speaker").cast("string").alias("speaker"),
        F.when(F.col("language") != "", F.col("language")).alias("language"),
    )


def output_rows(df: DataFrame, schema: str = "train", codes: str | None = None) -> DataFrame:
    """``train`` keeps the canonical row (plus codes); ``minimal`` is audio, transcript, speaker, codes."""
    found = F.col(codes) if codes else F.lit(None).cast(CODES)
    if schema == "minimal":
        return df.select("audio", F.col("text").alias("transcript"), "speaker", found.alias("codes"))
    if schema != "train":
        raise ValueError(f"unknown output schema {schema}")
    row = df.select("audio", "text", "source", "speaker", "language", found.alias("audio_codes"))
    return row if codes else row.drop("audio_codes")


def source_a(
    df: DataFrame, name: str, allowed: list[str] | None = None, cap: int | None = None, start: int = 0,
    raw_index: str = "raw_index",
) -> DataFrame:
    """Transcribed source: language from the first existing column, tags and braces removed, audio required.

    Text and language predicates come before the audio one, so clips of dropped rows are never read; text is
    cleaned after the cap, so only for rows that stay.
    """
    rows = df.where(F.col(raw_index) >= start) if start else df
    # The language column is resolved before the result column of the same name is added.
    rows = rows.withColumn("language", X.normalize_language(language_column(rows)))
    rows = filter_language_allowed(rows, allowed_languages(allowed or []))
    rows = filter_has_audio(rows.where(X.has_dialog_text("transcription"))).withColumn("source", F.lit(name))
    rows = cap_per_source(rows, cap, raw_index=raw_index)
    rows = rows.withColumn("text", X.clean_dialog_text("transcription"))
    return canonical_row(rows, F.lit(name), [raw_index])


def source_b(
    df: DataFrame, name: str, cap: int | None = None, start: int = 0, raw_index: str = "raw_index",
    allowed: list[str] | None = None,
) -> DataFrame:
    """URL-voice source: blanks collapsed only, fixed language, a URL and fetched bytes required.

    The allow-list is not applied unless given, because this source's language is known.
    """
    rows = df.where(F.col(raw_index) >= start) if start else df
    rows = rows.where(F.coalesce(F.col("file_url") != "", F.lit(False)))
    rows = filter_has_audio(rows.where(~X.is_blank("voice_text"))).withColumns(
        {"language": F.lit(K.SOURCE_B_LANGUAGE), "speaker": F.col("char_id").cast("string"), "source": F.lit(name)}
    )
    rows = filter_language_allowed(rows, allowed_languages(allowed or []))
    rows = cap_per_source(rows, cap, raw_index=raw_index)
    rows = rows.withColumn("text", X.collapse_whitespace("voice_text"))
    return canonical_row(rows, F.lit(name), [raw_index])


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Concatenate sources in order; columns a source lacks become null; ``source_order`` keeps the order."""
    numbered = [df.withColumn("source_order", F.lit(i)) for i, df in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def clean_requests(df: DataFrame, model_size: str | None = None, exact_size: bool = False) -> DataFrame:
    """Drop requests with blank text, trim text, turn blank instructions into null.

    The smallest model takes no instruction. Its size name is matched as a substring of ``0b6`` (so ``""`` and
    ``"b"`` match too) unless ``exact_size`` asks for equality.
    """
    instruct = X.strip_spaces("instruct")
    out = df.where(~X.is_blank("text")).withColumns(
        {"text": X.strip_spaces("text"), "instruct": F.when(instruct != "", instruct)}
    )
    if model_size is None:
        return out
    small = model_size == "0b6" if exact_size else model_size in "0b6"
    return out.withColumn("instruct", F.lit(None).cast("string")) if small else out


def audio_value_unify(
    df: DataFrame, dataset: str, index: str = "raw_index", files: DataFrame | None = None,
) -> DataFrame:
    """One (bytes, path) struct for every audio form.

    Looked at in order: plain path, embedded bytes, samples with a rate (WAV), path to a file. Input columns:
    ``audio_path`` (plain string form) and ``audio`` struct<bytes, path, filename, samples, rate>. ``files`` is a
    (path, content) table; paths that are not in it give null bytes. Rows that need no file bypass that join, and paths
    that very many rows share are joined by themselves.
    """
    from .clips import wav_bytes

    inner = F.col("audio")
    named = F.when(inner["path"] != "", inner["path"]).otherwise(F.when(inner["filename"] != "", inner["filename"]))
    short = dataset.rsplit("/", 1)[-1]
    made = F.concat(F.lit(short + "_"), F.col(index).cast("string"), F.lit(".wav"))
    has_wave = inner["samples"].isNotNull() & inner["rate"].isNotNull()
    plain = F.col("audio_path").isNotNull()
    rows = df.withColumn("_lookup", F.when(plain, F.col("audio_path")).otherwise(named))
    need = plain | (inner["bytes"].isNull() & ~has_wave)
    rows = rows.withColumn("_lookup", F.when(need, F.col("_lookup")))
    if files is not None:
        size = files.agg(F.sum("length")).first()[0] or 0 if "length" in files.columns else None
        found = files.select(F.col("path").alias("_lookup"), F.col("content").alias("_content"))
        rows = join_small_or_salted(rows, found, "_lookup", "left", "_content", size=size)
    else:
        rows = rows.withColumn("_content", F.lit(None).cast("binary"))
    wave = F.when(has_wave & ~plain & inner["bytes"].isNull(), wav_bytes(inner["samples"], inner["rate"]))
    value = (
        F.when(plain, F.struct(F.col("_content").alias("bytes"), F.col("audio_path").alias("path")))
        .when(inner["bytes"].isNotNull(), F.struct(inner["bytes"].alias("bytes"), named.alias("path")))
        .when(has_wave, F.struct(wave.alias("bytes"), F.coalesce(named, made).alias("path")))
        .otherwise(F.struct(F.col("_content").alias("bytes"), named.alias("path")))
    )
    return rows.withColumn("audio_value", value).drop("_lookup", "_content")
