"""Restartable incremental jobs: the checkpoint is the cursor, so nothing is lost or repeated after a stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

Transform = Callable[[DataFrame], DataFrame]


def new_rows(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the Parquet files that appear in a folder; the schema is declared."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def stream_prepare(rows: DataFrame, transform: Transform, out: str, checkpoint: str) -> StreamingQuery:
    """Row-wise preparation into a Parquet folder; the sink's commit log makes the output exactly-once."""
    return (
        transform(rows)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_exactly_once(rows: DataFrame, transform: Transform, out: str, checkpoint: str, progress: str | None = None) -> StreamingQuery:
    """Each micro-batch overwrites its own ``batch_id=`` folder, so a repeated batch replaces itself.

    With ``progress`` every batch also stores, per source, its row count and the raw index to read next.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        done = transform(batch)
        target = f"{out}/batch_id={batch_id}"
        done.write.mode("overwrite").parquet(target)
        if progress:
            written = batch.sparkSession.read.schema(done.schema).parquet(target)
            counts = written.groupBy("source").agg(
                F.count(F.lit(1)).alias("n_rows"), (F.max("raw_index") + 1).alias("next_raw_index")
            )
            counts.write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}")

    return (
        rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_attach_codes(rows: DataFrame, encode: Transform, out: str, checkpoint: str) -> StreamingQuery:
    """Codes for the rows of an existing dataset as it grows; earlier output is never rewritten."""
    return stream_prepare(rows, encode, out, checkpoint)


def stream_progress(rows: DataFrame, out: str, checkpoint: str, source: str = "source") -> StreamingQuery:
    """Live row count per source: the state keeps one number per source, and each batch replaces the report."""
    counts = rows.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"))

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("as_of", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/as_of_batch={batch_id}")

    return (
        counts.writeStream.outputMode("complete").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_report(spark: SparkSession, out: str) -> DataFrame:
    """Rows of the newest progress report."""
    rows = spark.read.option("basePath", out).parquet(f"{out}/as_of_batch=*")
    return rows.where(F.col("as_of") == rows.agg(F.max("as_of")).scalar()).drop("as_of", "as_of_batch")
