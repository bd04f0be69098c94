"""The dashboard's alert data and the figures of its widgets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiltx.config import DashboardConfig
from vigiltx.functions.money import money_sum


def alert_rows(tx: DataFrame, cfg: DashboardConfig = DashboardConfig()) -> DataFrame:
    """Large recent transactions, banded by amount alone. Unsorted: widgets add them up."""
    amount = F.col("amount_usd")
    rule = F.lit(cfg.other_rule)
    for above, label in reversed(cfg.rule_bands):
        rule = F.when(amount > above, label).otherwise(rule)
    level = F.when(amount > cfg.red_above, cfg.red_label).otherwise(cfg.watch_label)
    return tx.filter(
        (F.col("tx_date") >= F.lit(cfg.since).cast("date")) & (amount > cfg.above)
    ).select(
        F.col("tx_date").alias("Fecha"),
        rule.alias("Rule_Triggered"),
        amount.alias("Monto_USD"),
        F.col("tx_id").alias("Alert_ID"),
        F.col("origin").alias("Cliente_ID"),
        level.alias("Nivel_Riesgo"),
    )


def alert_sql(view: str, cfg: DashboardConfig = DashboardConfig()) -> str:
    """``alert_rows``, newest first, as SQL over a view of the published silver table."""
    bands = " ".join(f"WHEN Monto_USD > {above} THEN '{label}'" for above, label in cfg.rule_bands)
    return (
        f"SELECT Fecha_Transaccion AS Fecha, CASE {bands} ELSE '{cfg.other_rule}' END AS Rule_Triggered, "
        "Monto_USD, PK_Transaccion AS Alert_ID, FK_Cliente_Origen AS Cliente_ID, "
        f"CASE WHEN Monto_USD > {cfg.red_above} THEN '{cfg.red_label}' ELSE '{cfg.watch_label}' END AS Nivel_Riesgo "
        f"FROM {view} WHERE Fecha_Transaccion >= DATE '{cfg.since}' AND Monto_USD > {cfg.above} "
        "ORDER BY Fecha DESC, Alert_ID"
    )


def newest_first(rows: DataFrame) -> DataFrame:
    """For the sink. The id breaks ties, so one busy day still spreads over the sort."""
    return rows.orderBy(F.desc("Fecha"), "Alert_ID")


def date_range(rows: DataFrame, first: str, last: str) -> DataFrame:
    """Per date: alerts that fall in the chosen range (both ends included)."""
    inside = F.col("Fecha").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return rows.groupBy("Fecha").agg(F.count_if(inside).alias("in_range"))


def trend(rows: DataFrame) -> DataFrame:
    return rows.groupBy("Fecha").agg(F.count("*").alias("alerts"))


def amount_by_rule(rows: DataFrame) -> DataFrame:
    return rows.groupBy("Rule_Triggered").agg(money_sum(F.col("Monto_USD")).alias("amount"))


def counters(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("alerts"), money_sum(F.col("Monto_USD")).alias("amount"))


def customers_by_level(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct customers per level; a customer may count in both."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return rows.groupBy("Nivel_Riesgo").agg(distinct(F.col("Cliente_ID")).alias("customers"))
