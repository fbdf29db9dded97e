"""Corpus pipeline over ``documents``: language, repeated lines, near duplicates, benchmark leaks, then piece ids.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; ``run`` writes each stage's rows
as Parquet to the shared folder and reads them again, so a lost executor never repeats an earlier stage. All but the last
return the columns of their input. ``n_chars`` follows the text where a stage changes it.

Rows: a null text goes at the first stage; a text that loses all its lines stays as an empty one. A null id is an id like
any other: rows without one are a group by themselves. Rows that share an id are told apart by their texts where lines
are removed and where benchmark items are looked for. An empty table gives no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxweave.llm import decontaminate, jaccard, language, lines, pieces
from voxweave.llm.native import shielded
from voxweave.session import work_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is rejected: no letter, or a score below the calibrated one."""
    rows, names = shielded(docs, "text")
    named = language.identify(rows, language.fit(_table(spark, sf_dir, "documents")))
    return named.where(~F.col("rejected")).select(*names).toDF(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes chunks of lines that occur earlier out of the texts; every document stays."""
    rows, names = shielded(docs, "doc_id", "text", "n_chars")
    cleaned = lines.drop_repeated_chunks(rows)
    if "n_chars" in names:
        length = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*names).toDF(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one with the smallest id.

    Rows that share this id all stay, copies included: the join speaks of documents, and an id is one document.
    """
    found = jaccard.jaccard_components(docs.select("doc_id", "text"))
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item or its template."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every document that is left."""
    return pieces.tokenize(docs, pieces.load())


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("jaccard_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("sentencepiece", piece_ids),
]

# Language identification and the piece model have no SQL; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
