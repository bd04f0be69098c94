"""Time the layers, detectors and reports; prints one JSON line.

Stages read the tables the stage before wrote, as a scheduled run would. A pass over
the smallest tables comes first, so JVM and Python workers are warm.
BENCH_SF_DIR and BENCH_CPUS choose the data and the number of local cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harness import mapped
from harness.registry import DASHBOARD, RULES, WEEK
from vigiltx.config import MonitorConfig
from vigiltx.operators import alerts, anomaly, detectors, features
from vigiltx.operators.clean import clean_transactions
from vigiltx.plans import dashboard, flows, layers, report
from vigiltx.schema import adopt, publish
from vigiltx.sources.tables import PartitionedTable, VersionedTable

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def stages(spark: SparkSession, sf: str) -> dict[str, Callable[[], object]]:
    folder = tempfile.mkdtemp(prefix="bench-")
    cfg = MonitorConfig(rules=RULES)

    def table(name: str) -> VersionedTable:
        return VersionedTable(spark, f"{folder}/{name}")

    bronze, people = table("bronze"), table("bronze-customers")
    silver, customers = table("silver"), table("customers")
    profiles, alert_table = table("profiles"), table("alerts")
    by_year = PartitionedTable(spark, f"{folder}/by-year", "year")

    def tx() -> DataFrame:
        return adopt(silver.read())

    def clients() -> DataFrame:
        return adopt(customers.read())

    def gold() -> DataFrame:
        return adopt(profiles.read())

    def dash() -> DataFrame:
        return dashboard.alert_rows(tx(), DASHBOARD)

    def bronze_load():
        bronze.overwrite(mapped.bronze_transactions(spark, sf).repartition(2 * CPUS))
        people.overwrite(mapped.bronze_customers(spark, sf))

    def with_year(df: DataFrame) -> DataFrame:
        return df.selectExpr("*", "year(tx_date) AS year")

    return {
        "bronze_load": bronze_load,
        "defect_profile": lambda: run(detectors.defect_profile(bronze.read())),
        "near_duplicates": lambda: run(detectors.near_duplicates(bronze.read())),
        "silver_first_load": lambda: layers.refresh_silver(bronze.read(), people.read(), silver, customers),
        "silver_upsert": lambda: silver.upsert(
            publish(clean_transactions(bronze.read().filter("currency = 'EUR'")).drop("tx_ts")), "PK_Transaccion"
        ),
        "partitioned_load": lambda: by_year.upsert(with_year(tx()), "tx_id"),
        "partitioned_upsert": lambda: by_year.upsert(
            with_year(tx().filter("tx_date >= '1998-01-01'")), "tx_id"
        ),
        "features_customer": lambda: run(features.customer_features(clients(), tx())),
        "rule_profiles": lambda: run(layers.rule_profiles(clients(), tx(), cfg)),
        "gold": lambda: layers.refresh_gold(silver, customers, profiles, alert_table, cfg),
        "iforest_fit": lambda: anomaly.fit(anomaly.model_vector(gold())),
        "alerts": lambda: run(alerts.alerts(tx(), gold(), clients(), 35.0)),
        "report_lines": lambda: run(report.report_lines(tx(), gold())),
        "dash_trend": lambda: run(dashboard.trend(dash())),
        "dash_by_rule": lambda: run(dashboard.amount_by_rule(dash())),
        "dash_levels": lambda: run(dashboard.customers_by_level(dash())),
        "flow_links": lambda: run(flows.flow_links(flows.channel_flows(tx(), gold()))),
        "risk_rollup": lambda: run(flows.risk_hierarchy(flows.channel_flows(tx(), gold()))),
        "burst_sessions": lambda: run(detectors.burst_sessions(tx(), WEEK, 2)),
        "cash_splitting": lambda: run(detectors.cash_splitting(tx(), period="month", total_above=3000.0)),
        "pass_through": lambda: run(detectors.pass_through(tx(), limit=None)),
        "time_profile": lambda: run(detectors.time_profile(tx())),
        "single_exit": lambda: run(detectors.single_exit(tx(), "Exchange_Crypto", min_inbound=2, max_exits=3, tolerance=None)),
    }


def timed(spark: SparkSession, sf: str) -> dict[str, float]:
    seconds = {}
    for name, stage in stages(spark, sf).items():
        started = time.perf_counter()
        stage()
        seconds[name] = round(time.perf_counter() - started, 3)
    return seconds


def main() -> None:
    spark = session()
    smallest = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    if os.path.isdir(smallest):
        timed(spark, smallest)
    seconds = timed(spark, SF_DIR)
    print(
        json.dumps(
            {
                "metric": "seconds for all layers, detectors and reports",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "warm": os.path.isdir(smallest),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
