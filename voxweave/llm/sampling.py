"""Bounded, repeatable samples of labelled rows for training."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_CLASSES = 256
MAX_TEXT_BYTES = 64 << 10


def class_counts(rows: DataFrame, label: str, max_classes: int = MAX_CLASSES) -> dict:
    """Rows of each label value, of the ``max_classes`` most frequent values."""
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).count()
    return {r[0]: r[1] for r in counts.orderBy(F.desc("count"), label).limit(max_classes).collect()}


def labelled_sample(rows: DataFrame, label: str, counts: dict, per_class: int, key: str = "doc_id", text: str = "text") -> pa.Table:
    """Up to ``per_class`` rows of every label value in ``counts``, chosen by a hash of the key.

    Texts of more than ``MAX_TEXT_BYTES`` are not trained on. A first cut by hash keeps about twice the rows wanted,
    so the ranking never sees a whole class.
    """
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, 2.0 * per_class / n + 50.0 / n))).otherwise(share)
    order = F.xxhash64(F.col(key), F.lit(11))
    near = rows.where(F.pmod(order, F.lit(1 << 31)) < share * F.lit(float(1 << 31)))
    near = near.where(F.col(text).isNotNull() & (F.octet_length(text) <= MAX_TEXT_BYTES))
    ranked = near.select(key, label, text).withColumn("_rank", F.row_number().over(Window.partitionBy(label).orderBy(order, key)))
    return ranked.where(F.col("_rank") <= per_class).drop("_rank").toArrow().sort_by([(label, "ascending"), (key, "ascending")])
