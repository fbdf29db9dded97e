"""Sizes measured from the data, from which numbers of groups follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts; one narrow pass."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def groups_for(size: int, each: int, least: int = 16) -> int:
    """How many groups hold ``size`` bytes with about ``each`` bytes in a group."""
    return max(least, -(-size // each))
