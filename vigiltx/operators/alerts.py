"""Transactions sent by customers at risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiltx.schema import ALERT_COLUMNS, FLAG_COLUMNS


def with_sender(tx: DataFrame, senders: DataFrame) -> DataFrame:
    """Transactions next to their sender's row (``customer_id`` and more); unknown senders drop out.

    Spark's adaptive join splits a sender that owns a large share of the rows, but only
    where both sides were shuffled for this very join. The sender side often comes out
    of another join on its key, so the key is computed anew to make Spark shuffle it;
    that side has one row per customer.
    """
    keyed = senders.withColumn("_sender", F.concat("customer_id", F.lit("")))
    return tx.join(keyed, tx["origin"] == keyed["_sender"]).drop("_sender")


def alerts(
    tx: DataFrame, profiles: DataFrame, customers: DataFrame, min_score: float = 40.0
) -> DataFrame:
    """Every transaction whose sender scores at least ``min_score``.

    Only the sender counts: money received by a customer at risk raises no alert.
    Customer details come from the silver table, where gaps are still NULL. The two
    customer-sized tables are joined first, so transactions move once.
    """
    at_risk = profiles.filter(F.col("risk_score") >= min_score).select(
        "customer_id", "risk_score", "risk_level", "ml_score", "rule_score", *FLAG_COLUMNS
    )
    details = customers.select("customer_id", "age", "occupation", "monthly_income")
    extra = [c for c in tx.columns if c not in (*ALERT_COLUMNS, "tx_ts")]
    return with_sender(tx, at_risk.join(details, "customer_id", "left")).select(
        *ALERT_COLUMNS, *extra
    )
