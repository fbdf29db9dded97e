"""Preference training metrics over log-probability tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.vectors import log_sigmoid, log_softmax_at


def sequence_logprobs(sequences: DataFrame, tokens: DataFrame, subcodes: DataFrame | None = None, seq: str = "seq") -> DataFrame:
    """Summed log-probability of every sequence; ignored labels add nothing, and neither do missing frames.

    ``tokens`` and ``subcodes`` are (seq, logits, label). Each is summed per sequence before any join, so long
    sequences are combined on the map side.
    """
    def totals(rows: DataFrame) -> DataFrame:
        counted = rows.where(F.col("label") != K.LABEL_IGNORE)
        return counted.select(seq, log_softmax_at("logits", "label").alias("_lp"))

    parts = totals(tokens)
    if subcodes is not None:
        parts = parts.unionByName(totals(subcodes))
    sums = parts.groupBy(seq).agg(F.sum("_lp").alias("logprob"))
    return sequences.select(seq).join(sums, seq, "left").withColumn("logprob", F.coalesce("logprob", F.lit(0.0)))


def _gap(chosen: str, rejected: str) -> Column:
    return F.col(chosen) - F.col(rejected)


def preference_loss(pairs: DataFrame, beta: float = K.PREFERENCE_BETA, smoothing: float = 0.0, by: list[str] | None = None) -> DataFrame:
    """Mean pairwise preference loss. Columns: policy_chosen, policy_rejected, ref_chosen, ref_rejected."""
    z = _gap("policy_chosen", "policy_rejected") - _gap("ref_chosen", "ref_rejected")
    loss = -log_sigmoid(F.lit(beta) * z)
    if smoothing > 0:
        loss = loss * (1.0 - smoothing) - log_sigmoid(F.lit(-beta) * z) * smoothing
    return pairs.groupBy(*(by or [])).agg(F.avg(loss).alias("loss"))


def reward_metrics(pairs: DataFrame, beta: float = K.PREFERENCE_BETA, by: list[str] | None = None) -> DataFrame:
    chosen = F.lit(beta) * _gap("policy_chosen", "ref_chosen")
    rejected = F.lit(beta) * _gap("policy_rejected", "ref_rejected")
    won = F.when(chosen > rejected, 1.0).otherwise(0.0)
    return pairs.groupBy(*(by or [])).agg(
        F.avg(chosen - rejected).alias("reward_margin"), F.avg(won).alias("accuracy")
    )


def epoch_loss_summary(log: DataFrame, epochs: DataFrame | None = None) -> DataFrame:
    """Mean loss per epoch; an epoch without steps has mean 0."""
    sums = log.groupBy("epoch").agg(F.sum("loss").alias("_sum"), F.count("loss").alias("steps"))
    if epochs is not None:
        sums = epochs.select("epoch").join(sums, "epoch", "left").fillna(0, ["_sum", "steps"])
    mean = F.col("_sum") / F.greatest(F.col("steps"), F.lit(1))
    return sums.select("epoch", "steps", mean.alias("mean_loss"))
