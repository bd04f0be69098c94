"""Money flows by channel and pattern: links, nodes, hierarchy, scatter rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigiltx.functions.money import money_sum
from vigiltx.functions.ranks import dense_index
from vigiltx.operators.alerts import with_sender

# Pattern per flag, the first raised one counts.
PATTERNS = {
    "flag_structuring": "Pitufeo (Structuring)",
    "flag_fan_in": "Fan-In Plataforma",
    "flag_crypto": "Salto Crypto (KYT)",
    "flag_kyc": "Desvio KYC",
}
NORMAL = "Normal"
ALERT_CLASS = "Alerta AML (Fraude)"
CLEAN_CLASS = "Flujo Legítimo"


def _pattern() -> Column:
    pattern = F.lit(NORMAL)
    for flag, label in reversed(PATTERNS.items()):
        pattern = F.when(F.col(flag) == 1, label).otherwise(pattern)
    return pattern


def sender_risk(profiles: DataFrame) -> DataFrame:
    """(customer_id, pattern, is_fraud, risk_score in 0..1)."""
    any_flag = sum((F.col(flag) for flag in PATTERNS), F.lit(0)) > 0
    return profiles.select(
        "customer_id",
        _pattern().alias("pattern"),
        any_flag.alias("is_fraud"),
        (F.col("rule_score") / 100.0).alias("risk_score"),
    )


def risk_facts(tx: DataFrame, profiles: DataFrame) -> DataFrame:
    """Transactions of known customers with their sender's pattern."""
    return with_sender(tx, sender_risk(profiles)).select(
        "tx_id", "customer_id", "tx_date", "amount_usd", "channel",
        "pattern", "is_fraud", "risk_score",
    )


def channel_flows(tx: DataFrame, profiles: DataFrame) -> DataFrame:
    """Amount per (class, pattern, channel).

    Transactions are added up per (sender, channel) before they meet the profiles, so
    the join moves a few rows per customer, whatever a customer's volume.
    """
    sent = tx.groupBy("origin", "channel").agg(money_sum(F.col("amount_usd")).alias("amount"))
    risk = sender_risk(profiles)
    return (
        sent.join(risk, sent["origin"] == risk["customer_id"])
        .groupBy(
            F.when(F.col("is_fraud"), ALERT_CLASS).otherwise(CLEAN_CLASS).alias("classification"),
            "pattern",
            "channel",
        )
        .agg(money_sum(F.col("amount")).alias("amount"))
    )


def flow_links(flows: DataFrame) -> DataFrame:
    """Amount per (channel, pattern) and the kind of link to draw."""
    kind = (
        F.when(F.col("pattern").contains("Normal"), "normal")
        .when(F.col("pattern").contains("Pitufeo"), "structuring")
        .otherwise("other")
    )
    return (
        flows.groupBy("channel", "pattern")
        .agg(money_sum(F.col("amount")).alias("amount"))
        .withColumn("kind", kind)
    )


def flow_nodes(links: DataFrame) -> DataFrame:
    """Channels, then patterns, numbered from 0 in name order."""
    channels = links.select(F.lit(0).alias("side"), F.col("channel").alias("name")).distinct()
    patterns = links.select(F.lit(1).alias("side"), F.col("pattern").alias("name")).distinct()
    return dense_index(channels.unionByName(patterns), ["side", "name"], "node").select(
        "node", "name"
    )


def risk_hierarchy(flows: DataFrame) -> DataFrame:
    """Totals of class, pattern within class, and channel within pattern.

    ``level`` is the grouping id: 0 for the finest rows, 7 for the grand total.
    """
    return flows.rollup("classification", "pattern", "channel").agg(
        F.grouping_id().cast("int").alias("level"), money_sum(F.col("amount")).alias("amount")
    )


def scatter(facts: DataFrame) -> DataFrame:
    return facts.select(
        "tx_id",
        F.col("tx_date").alias("x"),
        F.col("amount_usd").alias("y"),
        F.col("risk_score").alias("z"),
        "pattern",
        F.col("amount_usd").alias("size"),
    )
