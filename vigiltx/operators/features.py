"""Per-customer sending and receiving features.

Transactions are read once. They are first added up per (origin, destination) pair,
which gives the distinct counterparties and spreads a busy customer over all tasks;
each pair then counts once for its sender and once for its receiver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigiltx.config import FeatureConfig
from vigiltx.functions.money import PARTS, dollars, money_parts, sample_std, squared_parts, total_cents
from vigiltx.schema import CUSTOMERS, FEATURE_COLUMNS, RECEIVED_COLUMNS, SENT_COLUMNS

DEFAULTS = FeatureConfig()


def payment_edges(tx: DataFrame, cfg: FeatureConfig = DEFAULTS) -> DataFrame:
    """One row per (origin, destination): counts, exact sums, maximum."""
    amount = F.col("amount_usd")

    high, cross, low = squared_parts(amount)

    def through(pattern: str) -> Column:
        return F.count_if(F.col("channel").rlike(pattern))

    return tx.groupBy("origin", "destination").agg(
        F.count("tx_id").alias("n"),
        *[F.sum(part).alias(name) for name, part in money_parts(amount).items()],
        F.sum(high).alias("high"),
        F.sum(cross).alias("cross"),
        F.sum(low).alias("low"),
        F.max(amount).alias("top"),
        through(cfg.cash_channels).alias("cash"),
        through(cfg.crypto_channels).alias("crypto"),
        through(cfg.platform_channels).alias("platform"),
    )


def _total(where: Column) -> Column:
    return dollars(*[F.sum(F.when(where, F.col(name))) for name in PARTS])


def _sent(where: Column, peer: str) -> list[Column]:
    def total_of(name: str) -> Column:
        return F.sum(F.when(where, F.col(name)))

    n, has_odd = total_of("n"), total_of("odd").isNotNull()
    total = total_cents(*map(total_of, PARTS[:3]))
    spread = sample_std(n, total, *map(total_of, ("high", "cross", "low")))
    return [
        n.alias("sent_count"),
        _total(where).alias("sent_total"),
        (_total(where) / n).alias("sent_avg"),
        F.max(F.when(where, F.col("top"))).alias("sent_max"),
        F.when(has_odd, F.lit(float("nan"))).otherwise(spread).alias("sent_std"),
        F.count(F.when(where, F.col(peer))).alias("unique_receivers"),
        total_of("cash").alias("cash_count"),
        total_of("crypto").alias("crypto_count"),
        total_of("platform").alias("platform_count"),
    ]


def _received(where: Column, peer: str) -> list[Column]:
    n = F.sum(F.when(where, F.col("n")))
    return [
        n.alias("received_count"),
        _total(where).alias("received_total"),
        (_total(where) / n).alias("received_avg"),
        F.max(F.when(where, F.col("top"))).alias("received_max"),
        F.count(F.when(where, F.col(peer))).alias("unique_senders"),
    ]


def sent_features(tx: DataFrame, cfg: FeatureConfig = DEFAULTS) -> DataFrame:
    edges = payment_edges(tx, cfg)
    return edges.groupBy(F.col("origin").alias("customer_id")).agg(
        *_sent(F.lit(True), "destination")
    )


def received_features(tx: DataFrame, cfg: FeatureConfig = DEFAULTS) -> DataFrame:
    edges = payment_edges(tx, cfg)
    return edges.groupBy(F.col("destination").alias("customer_id")).agg(
        *_received(F.lit(True), "origin")
    )


def both_sides(edges: DataFrame) -> DataFrame:
    """Each edge twice: for its sender (``sent`` true) and for its receiver."""
    values = [c for c in edges.columns if c not in ("origin", "destination")]
    sender = F.struct(
        F.col("origin").alias("customer_id"),
        F.col("destination").alias("peer"),
        F.lit(True).alias("sent"),
    )
    receiver = F.struct(
        F.col("destination").alias("customer_id"),
        F.col("origin").alias("peer"),
        F.lit(False).alias("sent"),
    )
    return (
        edges.select(F.explode(F.array(sender, receiver)).alias("side"), *values)
        .select("side.*", *values)
        .filter(F.col("customer_id").isNotNull())
    )


def customer_totals(tx: DataFrame, cfg: FeatureConfig = DEFAULTS) -> DataFrame:
    sides = both_sides(payment_edges(tx, cfg))
    return sides.groupBy("customer_id").agg(
        *_sent(F.col("sent"), "peer"), *_received(~F.col("sent"), "peer")
    )


def customer_features(
    customers: DataFrame, tx: DataFrame, cfg: FeatureConfig = DEFAULTS
) -> DataFrame:
    """Every customer with totals (0 where there is none) and ratios."""
    joined = (
        customers.select(*CUSTOMERS.fieldNames())
        .join(customer_totals(tx, cfg), "customer_id", "left")
        .fillna(0)
    )
    moved = F.col("sent_total") + F.col("received_total")
    income = F.when(F.col("monthly_income") <= 0, F.lit(cfg.undeclared_income)).otherwise(
        F.col("monthly_income")
    )

    def ratio(part: str, whole: str, otherwise: Column) -> Column:
        return F.when(
            F.col(whole) > 0, F.round(F.col(part) / F.col(whole), 4)
        ).otherwise(otherwise)

    nothing_in = F.when(F.col("sent_total") > 0, F.lit(cfg.nothing_received)).otherwise(0.0)
    return joined.select(
        *CUSTOMERS.fieldNames(),
        *SENT_COLUMNS,
        *RECEIVED_COLUMNS,
        moved.alias("total_moved"),
        ratio("sent_total", "received_total", nothing_in).alias("out_in_ratio"),
        F.round(moved / (income * 12.0), 4).alias("moved_income_ratio"),
        ratio("unique_senders", "received_count", F.lit(0.0)).alias("fan_in_index"),
        ratio("crypto_count", "sent_count", F.lit(0.0)).alias("crypto_ratio"),
    ).select(*FEATURE_COLUMNS)
