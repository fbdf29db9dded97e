"""Checks on request, prompt and code tables. Each returns the offending rows, so a job can count or store them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..session import measured


def reject_or_raise(rejects: DataFrame, what: str, show: list[str], limit: int = 20) -> None:
    """Stop with the first offending rows, for callers that want an error instead of a table."""
    bad = rejects.select(*show).limit(limit).collect()
    if bad:
        raise ValueError(f"unsupported {what}: {[tuple(r) for r in bad]}")


def unsupported(df: DataFrame, column: str, supported: DataFrame, name: str, null_is_bad: bool) -> DataFrame:
    """Rows whose value is not a supported name, compared without case."""
    # A few languages cover the whole table, so the names are measured and broadcast rather than shuffled against.
    names = measured(supported.select(F.lower(name).alias("_name")).distinct())
    checked = df if null_is_bad else df.where(F.coalesce(F.col(column) != "", F.lit(False)))
    return checked.withColumn("_name", F.lower(column)).join(names, "_name", "left_anti").drop("_name")


def user_languages(languages: DataFrame, name: str = "language") -> DataFrame:
    """Names a user may ask for: ``auto`` and every language that is no dialect."""
    spark = languages.sparkSession
    visible = languages.where(~F.col(name).contains("dialect")).select(F.lower(name).alias(name))
    return visible.union(spark.range(1).select(F.lit("auto").alias(name)))


def validate_languages(df: DataFrame, languages: DataFrame, column: str = "language", name: str = "language") -> DataFrame:
    """Rejected rows; a null language is one of them."""
    return unsupported(df, column, languages, name, null_is_bad=True)


def validate_speakers(df: DataFrame, speakers: DataFrame, column: str = "speaker", name: str = "speaker") -> DataFrame:
    """Rejected rows; null and empty speakers are not checked."""
    return unsupported(df, column, speakers, name, null_is_bad=False)


def validate_model_kind(requests: DataFrame, models: DataFrame) -> DataFrame:
    """Requests whose kind differs from the kind of the model they name (or whose model does not exist)."""
    return requests.join(measured(models.select("model", "kind").distinct()), ["model", "kind"], "left_anti")


def validate_prompt_rows(prompts: DataFrame) -> DataFrame:
    """Prompts with defaults filled in and a ``problem`` column, null for a usable prompt.

    ``x_vector_only_mode`` defaults to false and ``icl_mode`` to its opposite.
    """
    only_vector = F.coalesce("x_vector_only_mode", F.lit(False))
    rows = prompts.withColumn("x_vector_only_mode", only_vector)
    rows = rows.withColumn("icl_mode", F.coalesce("icl_mode", ~F.col("x_vector_only_mode")))
    problem = F.when(F.col("ref_spk_embedding").isNull(), "missing speaker vector").when(
        ~F.col("x_vector_only_mode") & (F.coalesce("ref_text", F.lit("")) == ""), "reference text required"
    )
    return rows.withColumn("problem", problem)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"empty {what}")
    return df


def code_shape(df: DataFrame, codes: str, width: int = 16) -> Column:
    return A.has_code_shape(codes, width)


def filter_special_codes(df: DataFrame, codes: str, vocab: int, reserved: int, end_id: int) -> DataFrame:
    """Remove reserved ids (all but the end id) from an ``array<int>`` column."""
    kept = F.filter(codes, lambda c: ~A.is_reserved_code(c, vocab, reserved, end_id))
    return df.withColumn(codes, kept)
