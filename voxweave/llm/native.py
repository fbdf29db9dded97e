"""Pieces that the DataFrame-only operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from voxweave.session import cut_lineage, work_path

SMALL_ROWS = 100_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df``, written to the shared folder, with a broadcast hint if it has at most ``rows`` narrow rows."""
    df = cut_lineage(df)
    return F.broadcast(df) if df.count() <= rows else df


def settle(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder and read from there, and its number of rows: one job, no recomputation."""
    seen, path = Observation(), work_path(df.sparkSession, "settled")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["n"]


def hold(df: DataFrame) -> DataFrame:
    """``df`` behind a barrier: filters above it see values, not the expressions that they come from.

    Otherwise a filter moves below the projections and takes a copy of their expressions into itself, into lambdas too,
    where they run once for each element.
    """
    held = df.select(F.explode_outer(F.array(F.struct(*df.columns))).alias("_held"))
    return held.select("_held.*")


def shielded(df: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """``df`` with every column but the used ones under a name of its own, and those names in the order of ``df``.

    Working columns can then have any name without meeting one of the caller's.
    """
    names = [c if c in used else f"kept_{k}_" for k, c in enumerate(df.columns)]
    return df.toDF(*names), names
