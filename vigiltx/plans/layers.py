"""The three layers end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiltx.config import MonitorConfig
from vigiltx.operators.alerts import alerts
from vigiltx.operators.anomaly import add_raw_score, fit, model_vector, scale_scores
from vigiltx.operators.clean import clean_customers, clean_transactions
from vigiltx.operators.features import customer_features
from vigiltx.operators.rules import add_flags, add_scores
from vigiltx.schema import CUSTOMERS, PROFILE_COLUMNS, PUBLISHED, adopt, adopt_bronze, publish
from vigiltx.sources.shared import materialize
from vigiltx.sources.tables import VersionedTable


def anomaly_scores(features: DataFrame, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """Features with ml_score and ml_outlier.

    The features are written once, so the transactions behind them are not read again
    for the fit and the scoring; the scores are written once for their quantile.
    """
    features = materialize(features, "features")
    forest = fit(model_vector(features), cfg.model)
    return scale_scores(materialize(add_raw_score(features, forest), "scores"), cfg.model)


def risk_profiles(
    customers: DataFrame, tx: DataFrame, cfg: MonitorConfig = MonitorConfig()
) -> DataFrame:
    """Gold profile of every customer."""
    scored = anomaly_scores(customer_features(customers, tx, cfg.features), cfg)
    flagged = add_flags(scored, cfg.rules)
    return add_scores(flagged, cfg.scores).select(*PROFILE_COLUMNS)


def rule_profiles(
    customers: DataFrame, tx: DataFrame, cfg: MonitorConfig = MonitorConfig()
) -> DataFrame:
    """Profiles without the model: ml_score 0, ml_outlier false. Nothing is written."""
    features = customer_features(customers, tx, cfg.features)
    unscored = features.withColumn("ml_score", F.lit(0.0)).withColumn("ml_outlier", F.lit(False))
    return add_scores(add_flags(unscored, cfg.rules), cfg.scores).select(*PROFILE_COLUMNS)


def refresh_silver(
    bronze_tx: DataFrame,
    bronze_customers: DataFrame,
    silver_tx: VersionedTable,
    silver_customers: VersionedTable,
) -> None:
    """Clean both bronze tables and upsert them into silver, under the published column names.

    Bronze may have published or own names. ``adopt`` gives silver its own names back, and
    the parsed event time, which is not published.
    """
    tx = clean_transactions(adopt_bronze(bronze_tx)).drop("tx_ts")
    customers = clean_customers(adopt_bronze(bronze_customers, "customer_id"))
    silver_tx.upsert(publish(tx), PUBLISHED["tx_id"])
    silver_customers.upsert(publish(customers), PUBLISHED["customer_id"])


def refresh_gold(
    silver_tx: VersionedTable,
    silver_customers: VersionedTable,
    profiles: VersionedTable,
    alert_table: VersionedTable,
    cfg: MonitorConfig = MonitorConfig(),
) -> None:
    """Recompute gold under its published column names. Alerts read the written profiles."""
    tx, customers = adopt(silver_tx.read()), adopt(silver_customers.read())
    profiles.overwrite(publish(risk_profiles(customers, tx, cfg)))
    found = alerts(tx, adopt(profiles.read()), customers, cfg.scores.medium_from)
    alert_table.overwrite(publish(found))


def layer_counts(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Row counts of the silver tables."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")

    return counted(tx, "silver_transactions").unionByName(
        counted(customers.select(*CUSTOMERS.fieldNames()), "silver_customers")
    )


def sample_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first rows in a total order."""
    return df.orderBy(*order).limit(n)
