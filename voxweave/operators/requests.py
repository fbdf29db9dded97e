"""Request tables: dimensions, defaults, length-1 broadcasting, preference pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import join_small_or_salted, measured


def join_codes_by_row(rows: DataFrame, codes: DataFrame, on: str = "sample_id") -> DataFrame:
    """Rows with their encoder output; rows the encoder dropped disappear."""
    return rows.join(codes, on)


def join_reference_audio(items: DataFrame, references: DataFrame, on: str = "ref_audio", limit_bytes: int | None = None,
                         salt_by: str | None = None) -> DataFrame:
    """Every item with its reference clip. One clip often serves the whole table, hence the salted way."""
    extra = {} if limit_bytes is None else {"limit_bytes": limit_bytes}
    return join_small_or_salted(items, references, on, "left", "bytes", salt_by=salt_by, **extra)


def join_language_id(requests: DataFrame, languages: DataFrame, column: str = "language") -> DataFrame:
    """Codec language id, null for ``auto``; ``language_error`` marks an unknown or missing language.

    ``languages`` is (language, language_id) with lower-case names.
    """
    ids = measured(languages.select(F.lower("language").alias("_language"), "language_id"))
    out = requests.withColumn("_language", F.lower(column)).join(ids, "_language", "left")
    auto = F.coalesce(F.col("_language") == "auto", F.lit(False))
    return out.withColumns(
        {
            "language_id": F.when(~auto, F.col("language_id")),
            "language_error": ~auto & F.col("language_id").isNull(),
        }
    ).drop("_language")


def join_speaker_dialect(requests: DataFrame, speakers: DataFrame, languages: DataFrame) -> DataFrame:
    """A dialect speaker asked for Chinese or auto gets the dialect's language id.

    ``speakers`` is (speaker, dialect) with a null dialect for none; ``requests`` already has ``language_id``.
    """
    dialects = speakers.select(F.lower("speaker").alias("_speaker"), F.lower("dialect").alias("_dialect"))
    ids = languages.select(F.lower("language").alias("_dialect"), F.col("language_id").alias("_dialect_id"))
    out = requests.withColumn("_speaker", F.lower("speaker"))
    # Only dialect speakers matter; they are looked up once, against a table of speakers.
    with_ids = dialects.where(F.col("_dialect").isNotNull()).join(ids, "_dialect").drop("_dialect")
    out = out.join(measured(with_ids), "_speaker", "left")
    applies = F.lower("language").isin("chinese", "auto") & F.col("_dialect_id").isNotNull()
    return out.withColumn(
        "language_id", F.when(applies, F.col("_dialect_id")).otherwise(F.col("language_id"))
    ).drop("_speaker", "_dialect_id")


def broadcast_scalars(texts: DataFrame, values: DataFrame, position: str = "position", group: str | None = None) -> DataFrame:
    """Give every text its value: a single value is repeated, otherwise values pair up by position.

    With ``group`` many requests are done at once. A group whose value count is neither 1 nor its text count
    raises, when the result is computed.
    """
    key = [group] if group else []
    texts_ = texts if group else texts.withColumn("_one", F.lit(1))
    values_ = values if group else values.withColumn("_one", F.lit(1))
    key = key or ["_one"]
    others = [c for c in values.columns if c not in (position, group)]
    sizes = texts_.groupBy(*key).agg(F.count(F.lit(1)).alias("_texts"))
    counted = values_.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_values"), *[F.min_by(c, position).alias("_only_" + c) for c in others]
    )
    shape = sizes.join(counted, key, "left")
    wrong = ~(F.coalesce("_values", F.lit(0)).isin(1) | (F.col("_values") == F.col("_texts")))
    message = F.concat(F.lit("batch size mismatch: texts="), F.col("_texts").cast("string"))
    shape = shape.withColumn(
        "_repeat", F.when(F.coalesce(wrong, F.lit(True)), F.raise_error(message).cast("boolean")).otherwise(F.col("_values") == 1)
    )
    shape = shape.drop("_texts", "_values")
    # Without groups the shape is a single row; with groups a hot one is split by adaptive skew handling.
    out = texts_.join(shape if group else F.broadcast(shape), key).join(
        values_.select(*key, position, *[F.col(c).alias("_own_" + c) for c in others]), [*key, position], "left"
    )
    picked = {c: F.when(F.col("_repeat"), F.col("_only_" + c)).otherwise(F.col("_own_" + c)) for c in others}
    return out.withColumns(picked).select(*texts.columns, *others)


def merge_defaults(user: DataFrame, file_defaults: DataFrame, request: str = "request_id") -> DataFrame:
    """Final generation parameters per request: the user's value, else the file's, else the fixed default.

    ``user`` is (request, params map<string,string>), ``file_defaults`` one row with a ``defaults`` map. A key that
    the file holds with a null value gives null, because what counts is that the key exists. Parameters of the user
    beyond the fixed names are passed on as they are.
    """
    file_map = file_defaults.agg(F.first("defaults")).scalar()
    fixed = F.create_map(*[F.lit(x) for pair in K.GENERATION_DEFAULTS.items() for x in pair])
    known = F.array(*[F.lit(n) for n in K.GENERATION_DEFAULTS])
    names = F.array_union(known, F.coalesce(F.map_keys("params"), F.array().cast("array<string>")))
    rows = user.select(
        request, "params", F.explode(names).alias("name")
    ).withColumns({"_file": file_map, "_fixed": fixed})
    own = F.try_element_at("params", F.col("name"))
    fallback = F.when(
        F.map_contains_key("_file", F.col("name")), F.try_element_at("_file", F.col("name"))
    ).otherwise(F.try_element_at("_fixed", F.col("name")))
    return rows.select(request, "name", F.coalesce(own, fallback).alias("value"))


def pair_preferences(rows: DataFrame, on: list[str], verdict: str, carry: list[str]) -> DataFrame:
    """Chosen and rejected answer of one prompt side by side.

    ``verdict`` is true for the chosen row. The key is unique per verdict (a prompt, or a prompt and a rank), so
    both land in one aggregation buffer and the rows are shuffled once instead of twice for a self-join. A key with
    two rows of one verdict, in a pair, is an error when the result is computed.
    """
    sides = ("chosen", F.col(verdict)), ("rejected", ~F.col(verdict))
    counts = [F.count_if(own).alias(f"_n_{label}") for label, own in sides]
    taken = [F.any_value(F.when(own, F.struct(*carry)), True).alias(f"_{label}") for label, own in sides]
    out = rows.groupBy(*on).agg(*counts, *taken).where("_n_chosen > 0 and _n_rejected > 0")
    twice = F.greatest("_n_chosen", "_n_rejected") > 1
    message = F.concat(F.lit("more than one row of a verdict for key "), F.to_json(F.struct(*on)))
    picked = [F.col(f"_{label}")[c].alias(f"{label}_{c}") for label, _ in sides for c in carry]
    checked = F.when(twice, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return out.where(checked).select(*on, *picked)
