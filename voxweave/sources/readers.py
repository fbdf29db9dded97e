"""Readers. Schemas are declared, never inferred; positions come from file metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import BROADCAST_BYTES, join_small_or_salted, measured
from . import parts as P
from .parts import PART_NAME

CODES = T.ArrayType(T.ArrayType(T.IntegerType()))
MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in ("audio", "text", "ref_audio", "language")])
MANIFEST_WITH_CODES = T.StructType([*MANIFEST.fields, T.StructField("audio_codes", CODES)])
VOICE_DESIGN_MANIFEST = T.StructType([*MANIFEST_WITH_CODES.fields, T.StructField("instruct", T.StringType())])
PREFERENCE_MANIFEST = T.StructType([*VOICE_DESIGN_MANIFEST.fields, T.StructField("dispreferred_audio_codes", CODES)])


def scan_jsonl_manifest(spark: SparkSession, path: str, schema: T.StructType = MANIFEST) -> DataFrame:
    """One JSON object per line; a malformed line stops the job, an empty line is skipped.

    A missing language reads as ``Auto``.
    """
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if "language" not in rows.columns:
        return rows
    return rows.withColumn("language", F.coalesce("language", F.lit("Auto")))


def scan_binary_audio(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, name, content) of every file below ``folder``; ``path`` has no URI scheme or authority."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    plain = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?/+", "/")
    return files.select(plain.alias("path"), F.regexp_extract(plain, r"([^/]*)$", 1).alias("name"), "content", "length")


def join_audio_bytes(rows: DataFrame, files: DataFrame, on: str, into: str = "bytes", key: str = "path",
                     limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Bytes for a path column; a path without a file, and a null one, gives null.

    One clip may serve half of all rows, so frequent paths are joined by themselves. File sizes come from the listing.
    """
    size = files.agg(F.sum("length")).first()[0] or 0 if "length" in files.columns else None
    found = files.select(F.col(key).alias(on), F.col("content").alias(into))
    joined = join_small_or_salted(rows, found, on, "left", into, limit_bytes=limit_bytes, size=size)
    return joined.select(on, *[c for c in rows.columns if c != on], into)


def scan_parquet_parts(spark: SparkSession, folder: str, schema: T.StructType | None = None, pattern: str | None = PART_NAME,
                       recursive: bool = False) -> DataFrame:
    """Rows of a folder of parts with ``file_name``, ``file_path``, ``row_index`` and, for numbered parts, ``part``.

    ``pattern=None`` takes every ``*.parquet`` file; ``recursive`` looks below sub-folders as well. A commit that was
    broken off is carried to its end first.
    """
    P.recover(spark, folder)
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.parquet(folder)
    meta = F.col("_metadata")
    rows = rows.select("*", meta["file_name"].alias("file_name"), meta["file_path"].alias("file_path"), meta["row_index"].alias("row_index"))
    if pattern is None:
        return rows
    return rows.where(F.col("file_name").rlike(pattern)).withColumn(
        "part", F.regexp_extract("file_name", pattern, 1).cast("int")
    )


def next_part(parts: DataFrame) -> DataFrame:
    """One row: the number of the next part, 0 when there is none."""
    return parts.agg(F.coalesce(F.max("part") + 1, F.lit(0)).alias("next_part"))


def with_global_row(parts: DataFrame, into: str = "global_row", listed: DataFrame | None = None) -> DataFrame:
    """Position over all files: the rows of the files before plus the row's place inside its file.

    Files go by folder, part number and name, and are told apart by their whole path. ``listed`` takes the row counts from
    footers (``parts.footers``); without it they are counted by a scan without columns. Only the list of files is
    ordered, so the rows themselves are not shuffled.
    """
    if listed is None:
        listed = P._numbered(parts.groupBy("file_path", "file_name").agg(F.count(F.lit(1)).alias("n_rows")), None)
        listed = listed.withColumn("row_group", F.lit(0))
    offsets = P.offsets(listed).groupBy("file_path").agg(F.min("before").alias("_before"))
    return parts.join(measured(offsets), "file_path").withColumn(into, F.col("_before") + F.col("row_index")).drop("_before")
