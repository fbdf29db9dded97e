"""Counts, summaries and profiles. Everything is combined on the map side before it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_per_file(parts: DataFrame, expected: DataFrame | None = None, file: str = "file_name") -> DataFrame:
    """Row count of every file; an expected file that is missing counts 0."""
    counts = parts.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"))
    if expected is None:
        return counts
    return expected.select(file).join(counts, file, "left").fillna(0, ["n_rows"])


def profile_dataset(parts: DataFrame, columns: list[str], file: str = "file_name", row: str = "row_index", width: int = 100) -> DataFrame:
    """Per file and column: rows, type, and the first row's value cut to ``width`` characters plus ``...``.

    One aggregate per file; columns become rows only afterwards, when there is one row per file.
    """
    firsts = []
    for c in columns:
        # Text is cut before it is aggregated, so long values never travel.
        shown = F.col(c).cast("string")
        cut = F.when(F.length(shown) > width, F.concat(F.substring(shown, 1, width), F.lit("..."))).otherwise(shown)
        firsts.append(F.min_by(cut, row).alias("_v_" + c))
    stats = parts.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"), *firsts)
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(parts.schema[c].dataType.simpleString()).alias("column_type"),
            F.col("_v_" + c).alias("first_value"),
        )
        for c in columns
    ]
    return stats.select(file, "n_rows", F.explode(F.array(*cells)).alias("_cell")).select(file, "n_rows", "_cell.*")


def first_reason(reasons: list[tuple[str, Column]], kept: str = "kept") -> Column:
    """Name of the first failing check, ``kept`` when all pass."""
    out = F.lit(kept)
    for name, failed in reversed(reasons):
        out = F.when(F.coalesce(failed, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def drop_reason_counts(df: DataFrame, reasons: list[tuple[str, Column]], source: str = "source") -> DataFrame:
    """Rows per source and first failing check, in one pass."""
    return df.groupBy(source, first_reason(reasons).alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"))


def source_language_summary(df: DataFrame, source: str = "source", language: str = "language", speaker: str = "speaker") -> DataFrame:
    """Rows and distinct speakers per source and language.

    Rows are first counted per speaker, so a source that dominates the table is shuffled as a few speaker rows.
    """
    per_speaker = df.groupBy(source, language, speaker).agg(F.count(F.lit(1)).alias("_n"))
    return per_speaker.groupBy(source, language).agg(
        F.sum("_n").alias("n_rows"), F.count(speaker).alias("n_speakers")
    )


def distinct_sample_rates(clips: DataFrame, batch: str = "batch", rate: str = "rate") -> DataFrame:
    """Per batch: distinct rates and the encode calls they need (one for a single rate, else one per row)."""
    per_rate = clips.groupBy(batch, rate).agg(F.count(F.lit(1)).alias("_n"))
    out = per_rate.groupBy(batch).agg(F.count(rate).alias("n_rates"), F.sum("_n").alias("_rows"))
    calls = F.when(F.col("n_rates") == 1, F.lit(1).cast("long")).otherwise(F.col("_rows"))
    return out.select(batch, "n_rates", calls.alias("encode_calls"))


def codebook_usage(codes: DataFrame, code: str = "code", by: list[str] | None = None) -> DataFrame:
    """Active codes and tokens, from one count per code."""
    keys = by or []
    per_code = codes.groupBy(*keys, code).agg(F.count(F.lit(1)).alias("_n"))
    return per_code.groupBy(*keys).agg(F.count(code).alias("active_codes"), F.sum("_n").alias("tokens"))
