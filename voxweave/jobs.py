"""The two batch jobs a corpus goes through, put together from the operators. Both can be stopped and run again.

What is done is part of the output itself: every stored row keeps its (source, split, raw_index), and every commit notes
how far it got in each source. Rows and progress are therefore committed by the same write, so a stopped run neither
loses nor repeats rows. The next run reads a source from its cursor on; outputs without a noted cursor are compared key
by key. Rows that a run tried and could not use are listed by key in a folder beside the output, with the reason, so
that the next run does not try them again unless it is asked to (``retry``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import constants as K
from .operators import cleaning, clips, resume, synthesis
from .sources import parts, writers

KEYS = ["source", "split", "raw_index"]
Encoder = Callable[[pd.DataFrame], list]


def cursor(spark: SparkSession, out: str) -> dict[tuple[str, str], int] | None:
    """(source, split) -> raw index to read next, as the commits of the output note it; None if one of them has no note.

    A commit that went over everything (a first run, or a comparison of keys) starts the count anew.
    """
    found: dict[tuple[str, str], int] = {}
    for one in parts.commits(spark, out):
        if "cursor" not in one["note"]:
            return None
        for source, split, following in one["note"]["cursor"]:
            found[source, split] = max(following, found.get((source, split), 0))
    return found or None


def remaining(rows: DataFrame, out: str, keys: list[str] = KEYS, whole: bool = False, retry: tuple[str, ...] = ()) -> DataFrame:
    """Rows that are neither in the output folder nor among its rejects.

    With a noted cursor only rows from it on are read: literals, so the predicate reaches the scan and the output is not
    opened. ``whole`` (or an output without notes, or other keys) compares the key columns of everything instead, which
    also finds rows that a wider filter lets through now. Rejects whose reason is in ``retry`` count as never tried.
    """
    spark = rows.sparkSession
    parts.recover(spark, out)
    rejects = rejects_folder(out)
    known = cursor(spark, out) if keys == KEYS and not whole else None
    lost = spark.read.parquet(rejects) if writers.exists(spark, rejects) else None
    if known is None:
        done = spark.read.parquet(out) if writers.exists(spark, out) else None
        for keyed in (done, lost if lost is None else lost.where(~F.col("reason").isin(*retry))):
            if keyed is not None:
                rows = resume.anti_join_done(rows, keyed.select(*keys), keys)
        return rows
    index = F.col("raw_index")
    seen = [F.col("source").eqNullSafe(F.lit(s)) & F.col("split").eqNullSafe(F.lit(p)) for s, p in known]
    fresh = reduce(or_, [mine & ((index >= n) | index.isNull()) for mine, n in zip(seen, known.values())]) | ~reduce(or_, seen)
    if lost is None:
        return rows.where(fresh)
    again = lost.where(F.col("reason").isin(*retry)).select(*keys).distinct() if retry else None
    rest = resume.anti_join_done(rows.where(fresh), lost.select(*keys), keys)
    if again is None:
        return rest
    done = resume.anti_join_done(again, spark.read.parquet(out).select(*keys), keys)
    return rest.unionByName(rows.join(F.broadcast(done) if parts_small(done) else done, keys, "left_semi"))


def parts_small(keys: DataFrame, rows: int = 200_000) -> bool:
    return keys.limit(rows + 1).count() <= rows


def rejects_folder(out: str) -> str:
    return out.rstrip("/") + "_rejects"


def list_rejects(tried: DataFrame, out: str, keys: list[str] = KEYS, reason: str = "no codes") -> None:
    """Append the keys of tried rows that did not reach the output. Only keys are read; nothing is encoded again."""
    spark = tried.sparkSession
    lost = resume.anti_join_done(tried.select(*keys), spark.read.parquet(out).select(*keys), keys)
    writers.sink_parquet(lost.withColumn("reason", F.lit(reason)), rejects_folder(out), append=True)


def _store(done: DataFrame, tried: DataFrame, out: str, rows_per_file: int | None) -> None:
    """Append ``done`` with a note of how far ``tried`` goes in each source; one narrow pass over the tried keys."""
    spark = done.sparkSession
    at = resume.last_cursor(tried.where(F.col("raw_index").isNotNull())).collect()  # one row a configured source and split
    earlier = cursor(spark, out) or {}
    note = {"cursor": [[r["source"], r["split"], max(r["next_raw_index"], earlier.get((r["source"], r["split"]), 0))] for r in at]}
    writers.sink_parquet(done, out, append=True, rows_per_file=rows_per_file, note=note)


def encoded(rows: DataFrame, encoder: Encoder, size: int = K.ENCODE_BATCH, target: int = K.CODEC_RATE) -> DataFrame:
    """Codes for rows with an ``audio`` struct; rows that cannot be decoded or encoded disappear.

    The encoder sees ``samples`` at the codec rate, ``size`` clips at a time.
    """
    heard = cleaning.filter_has_audio(rows).withColumn("_bytes", F.col("audio")["bytes"])
    heard = clips.decode_clips(heard, "_bytes").where(~F.col("undecodable"))
    heard = clips.resample_clips(heard, target)
    return synthesis.attach_codes(heard, encoder, size=size, inputs=["samples"]).drop("_bytes", "samples", "rate", "undecodable")


def prepare_corpus(sources: list[DataFrame], out: str, encoder: Encoder | None = None, split: str = "train",
                   rows_per_file: int | None = None, whole: bool = False) -> None:
    """Append the rows of all sources that the output lacks, with codes when an encoder is given.

    Each source is read from the raw index that the last commit noted; ``whole`` compares keys instead (after a filter
    was widened, say).

    ``sources`` come from ``cleaning.source_a`` / ``source_b`` and carry ``raw_index``. A cap is part of the source,
    so it holds over all runs together.
    """
    rows = cleaning.union_sources(sources).drop("source_order")
    rows = rows.withColumn("split", F.coalesce("split", F.lit(split)) if "split" in rows.columns else F.lit(split))
    rows = remaining(rows, out, whole=whole)
    _store(rows if encoder is None else encoded(rows, encoder), rows, out, rows_per_file)
    if encoder is not None:
        list_rejects(rows, out)


def attach_codes(spark: SparkSession, source: str, out: str, encoder: Encoder, keys: list[str] = KEYS,
                 rows_per_file: int | None = None, whole: bool = False, retry: tuple[str, ...] = ()) -> None:
    """Add codes to a stored dataset; rows that are already in the output are left alone.

    Rows lost to a reason named in ``retry`` are tried again.
    """
    if source.rstrip("/") == out.rstrip("/"):
        raise ValueError("input and output are the same folder")
    parts.recover(spark, source)
    rows = remaining(spark.read.parquet(source), out, keys, whole, retry)
    if keys == KEYS:
        _store(encoded(rows, encoder), rows, out, rows_per_file)
    else:
        writers.sink_parquet(encoded(rows, encoder), out, append=True, rows_per_file=rows_per_file)
    list_rejects(rows, out, keys)


def published(spark: SparkSession, out: str, schema: str = "train") -> DataFrame:
    """The stored rows in one of the output schemas."""
    rows = spark.read.parquet(out)
    return cleaning.output_rows(rows, schema, "audio_codes" if "audio_codes" in rows.columns else None)
