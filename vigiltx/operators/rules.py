"""Typology flags, rule score, composite score and risk level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiltx.config import RuleThresholds, ScoreConfig
from vigiltx.functions.money import half_even2


def add_flags(features: DataFrame, t: RuleThresholds = RuleThresholds()) -> DataFrame:
    """0/1 columns, one per typology."""
    sent, received = F.col("sent_total"), F.col("received_total")
    raised = {
        "flag_structuring": F.col("sent_count").between(*t.structuring_sends)
        & (F.col("sent_max") <= t.structuring_max)
        & sent.between(*t.structuring_total),
        "flag_fan_in": (F.col("received_count") >= t.fan_in_received)
        & (F.col("fan_in_index") >= t.fan_in_index)
        & (sent >= t.fan_in_share_sent * received)
        & (sent < t.fan_in_sent_below),
        "flag_crypto": (F.col("crypto_count") >= t.crypto_sends)
        & (F.col("sent_max") <= t.crypto_max)
        & (F.col("crypto_ratio") >= t.crypto_ratio),
        "flag_kyc": (F.col("moved_income_ratio") >= t.kyc_ratio) & (sent > t.kyc_sent_above),
    }
    return features.withColumns({name: hit.cast("bigint") for name, hit in raised.items()})


def add_scores(flagged: DataFrame, s: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Needs the four flags and ``ml_score``; adds rule_score, risk_score, risk_level."""
    weighted = (
        F.col("flag_structuring") * s.weight_structuring
        + F.col("flag_fan_in") * s.weight_fan_in
        + F.col("flag_crypto") * s.weight_crypto
        + F.col("flag_kyc") * s.weight_kyc
    )
    blended = F.lit(s.ml_share) * F.col("ml_score") + F.lit(s.rule_share) * F.col("rule_score")
    score = F.col("risk_score")
    level = (
        F.when(score >= s.high_from, s.high_label)
        .when(score >= s.medium_from, s.medium_label)
        .otherwise(s.low_label)
    )
    return (
        flagged.withColumn("rule_score", half_even2(F.least(weighted, F.lit(s.rule_cap))))
        .withColumn("risk_score", half_even2(blended))
        .withColumn("risk_level", level)
    )
