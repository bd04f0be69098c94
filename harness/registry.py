"""One query per operator, over the test tables seen as bronze.

Where the library's defaults select few rows of these tables or none, parameters or
amounts are changed; detectors whose optional test is switched off there have a second
query with it. The SQL in ``oracles`` uses the same values.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import mapped
from vigiltx.config import DashboardConfig, MonitorConfig, RuleThresholds, ScoreConfig
from vigiltx.operators import anomaly, detectors, features, rules
from vigiltx.operators.alerts import alerts
from vigiltx.operators.clean import clean_transactions
from vigiltx.plans import dashboard, flows, layers, report
from vigiltx.schema import (
    FLAG_COLUMNS, MODEL_COLUMNS, SILVER_COLUMNS, publish,
)
from vigiltx.sources.shared import fresh_path, lent, materialize
from vigiltx.sources.tables import (
    PartitionedTable, VersionedTable, append_batch, read_batches, with_lineage, write_partitioned,
)
from vigiltx.streaming.bursts import burst_stream
from vigiltx.streaming.upsert import load_new_batches, stream_silver

Query = Callable[[SparkSession, str], DataFrame]

RULES = RuleThresholds(fan_in_received=4)
RULE_ONLY = MonitorConfig(rules=RULES, scores=ScoreConfig(ml_share=0.0, rule_share=1.0))
WITH_MODEL = MonitorConfig(rules=RULES)
ALERT_FROM = 35.0
DASHBOARD = DashboardConfig(since="1998-01-01")
SMALL_AMOUNTS = DashboardConfig(
    since="1998-01-01", above=1000.0, red_above=1800.0,
    rule_bands=tuple((above / 5, label) for above, label in DashboardConfig().rule_bands),
)
WEEK, QUARTER_DAY = 7 * 86_400, 21_600
NEAR_LIMIT, NEAR_LIMIT_BY = 4000.0, 1500.0

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__.removesuffix("_query")] = f
    return f


def as_text(df: DataFrame) -> DataFrame:
    """Dates and times as text, the same in every engine."""
    text = {
        name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") if kind == "timestamp" else F.col(name).cast("string")
        for name, kind in df.dtypes
        if kind in ("date", "timestamp")
    }
    return df.withColumns(text)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals where engines differ in the last bits; + 0.0 turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})


def silver_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return mapped.silver_transactions(spark, sf), mapped.silver_customers(spark, sf)


def all_features(spark: SparkSession, sf: str) -> DataFrame:
    tx, customers = silver_pair(spark, sf)
    return features.customer_features(customers, tx)


def profiles_and_tx(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    tx, customers = silver_pair(spark, sf)
    return layers.rule_profiles(customers, tx, RULE_ONLY), tx, customers


def silver_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Silver transactions as a written table, for queries that take several batches from them."""
    return materialize(mapped.silver_transactions(spark, sf).select(*SILVER_COLUMNS), "silver")


def bronze_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze transactions as a written table, so that several batches do not each join lines and orders."""
    return materialize(mapped.bronze_transactions(spark, sf), "bronze-rows")


def new_table(spark: SparkSession, name: str) -> VersionedTable:
    return VersionedTable(spark, fresh_path(spark, name))


# Silver


@query
def silver_transactions(spark, sf):
    return as_text(publish(mapped.silver_transactions(spark, sf).select(*SILVER_COLUMNS)))


@query
def silver_customers(spark, sf):
    return publish(mapped.silver_customers(spark, sf))


# Tables


@query
def overwrite_roundtrip(spark, sf):
    tx, customers = silver_pair(spark, sf)
    table = new_table(spark, "overwrite")
    table.overwrite(customers)
    table.overwrite(tx.select(*SILVER_COLUMNS))
    return as_text(publish(table.read()))


@query
def upsert_transactions(spark, sf):
    tx = silver_rows(spark, sf)
    table = new_table(spark, "upsert-tx")
    table.upsert(tx.filter("amount_usd < 1000").withColumn("channel", F.lit("old")), "tx_id")
    table.upsert(tx.filter("amount_usd >= 500"), "tx_id")
    return as_text(publish(table.read()))


@query
def upsert_customers(spark, sf):
    customers = mapped.silver_customers(spark, sf)
    table = new_table(spark, "upsert-customers")
    table.upsert(
        customers.filter("monthly_income < 5000").withColumn("occupation", F.lit("old")),
        "customer_id",
    )
    table.upsert(customers.filter("monthly_income >= 0"), "customer_id")
    return publish(table.read())


@query
def upsert_idempotent(spark, sf):
    tx = silver_rows(spark, sf)
    table = new_table(spark, "upsert-twice")
    table.upsert(tx.filter("amount_usd < 1000").withColumn("channel", F.lit("old")), "tx_id")
    for _ in range(2):
        table.upsert(tx.filter("amount_usd >= 500"), "tx_id")
    return as_text(publish(table.read()))


@query
def upsert_by_partition(spark, sf):
    tx = silver_rows(spark, sf)
    by_year = tx.withColumn("year", F.year("tx_date"))
    table = PartitionedTable(spark, fresh_path(spark, "upsert-partitions"), "year")
    table.upsert(by_year.filter("amount_usd < 1000").withColumn("channel", F.lit("old")), "tx_id")
    table.upsert(by_year.filter("amount_usd >= 500"), "tx_id")
    return as_text(publish(table.read().select(*SILVER_COLUMNS)))


@query
def sample_rows(spark, sf):
    tx = mapped.silver_transactions(spark, sf).select(*SILVER_COLUMNS)
    return as_text(publish(layers.sample_rows(tx, ["tx_id"])))


# Each holds some keys that an earlier one has too; written in this order.
FILES = {"f1": "geography = 'Local'", "f2": "origin LIKE 'S%'", "f3": "channel LIKE 'Plata%' OR channel LIKE '%Crypto%'", "f4": "geography <> 'Local' AND origin LIKE 'C%'"}
BATCHES = {"b1": "origin LIKE 'C%'", "b2": "origin LIKE 'S%'"}


def append_bronze(bronze, path, batch_id) -> None:
    append_batch(bronze.filter(BATCHES[batch_id]), path, batch_id, "core")


@query
def bronze_append(spark, sf):
    bronze, path = bronze_rows(spark, sf), fresh_path(spark, "bronze")
    for batch_id in [*BATCHES, "b2"]:  # the second run of b2 replaces b2 only
        append_bronze(bronze, path, batch_id)
    return (
        read_batches(spark, path)
        .groupBy("batch_id", "source_system")
        .agg(F.count("*").alias("bronze_rows"), F.count("tx_id").alias("keyed_rows"))
    )


@query
def incremental_upsert(spark, sf):
    path, table = fresh_path(spark, "bronze"), new_table(spark, "incremental")
    bronze = bronze_rows(spark, sf)
    for batch_id in BATCHES:
        append_bronze(bronze, path, batch_id)
        load_new_batches(spark, path, table)
    return as_text(publish(table.read().select(*SILVER_COLUMNS, "batch_id")))


@query
def incremental_regrouped(spark, sf):
    """Batches that share keys; one comes late, one is corrected after it was loaded."""
    path, table = fresh_path(spark, "bronze"), new_table(spark, "regrouped")
    with lent(mapped.bronze_transactions(spark, sf), "bronze-rows") as bronze:
        wrong = bronze.withColumn("tx_id", F.concat(F.lit("wrong "), "tx_id"))
        append_batch(wrong, path, "009", "core")
        append_batch(bronze.filter("origin LIKE 'S%'"), path, "011", "core")
        load_new_batches(spark, path, table)
        append_batch(bronze.filter("geography = 'Local'"), path, "010", "branch")
        load_new_batches(spark, path, table)
        append_batch(bronze, path, "009", "core")
    load_new_batches(spark, path, table)
    return as_text(publish(table.read().select(*SILVER_COLUMNS, "batch_id", "source_system")))


@query
def pruned_scan(spark, sf):
    tx = mapped.silver_transactions(spark, sf).withColumn("year", F.year("tx_date"))
    path = fresh_path(spark, "by-year")
    write_partitioned(tx.select("tx_id", "amount_usd", "year", "channel"), path, ["year", "channel"])
    return (
        spark.read.parquet(path)
        .filter("year BETWEEN 1997 AND 1998 AND channel = 'Exchange_Crypto'")
        .select("tx_id", "amount_usd", "year", "channel")
    )


@query
def lineage_columns(spark, sf):
    bronze = with_lineage(mapped.bronze_transactions(spark, sf), "b1", "core")
    tx, customers = clean_transactions(bronze), mapped.silver_customers(spark, sf)
    profiles = layers.rule_profiles(customers, tx, RULE_ONLY)
    found = alerts(tx, profiles, customers, ALERT_FROM)
    return found.select("tx_id", "origin", "risk_score", "batch_id", "source_system")


@query
def schema_evolution(spark, sf):
    customers = mapped.silver_customers(spark, sf)
    table = new_table(spark, "evolving")
    table.upsert(customers.filter("age < 40"), "customer_id")
    table.upsert(customers.filter("age >= 30").withColumn("segment", F.upper("occupation")), "customer_id")
    return table.read()


# Features


@query
def features_outbound(spark, sf):
    return rounded(features.sent_features(mapped.silver_transactions(spark, sf)), "sent_avg", "sent_std")


@query
def features_inbound(spark, sf):
    return rounded(features.received_features(mapped.silver_transactions(spark, sf)), "received_avg")


@query
def features_customer(spark, sf):
    return rounded(all_features(spark, sf), "sent_avg", "sent_std", "received_avg")


@query
def layer_counts(spark, sf):
    return layers.layer_counts(*silver_pair(spark, sf))


# Model


@query
def feature_scaling(spark, sf):
    vectors = materialize(anomaly.model_vector(all_features(spark, sf)), "vectors")
    return rounded(anomaly.standardize(vectors), *MODEL_COLUMNS)


@query
def iforest_model(spark, sf):
    vectors = materialize(anomaly.model_vector(all_features(spark, sf)), "vectors")
    return anomaly.node_table(vectors)


@query
def anomaly_scores(spark, sf):
    scored = layers.anomaly_scores(all_features(spark, sf), WITH_MODEL)
    return scored.select("customer_id", "ml_score", "ml_outlier")


def stand_in_scores(spark, sf) -> DataFrame:
    """Features with a raw score SQL can repeat, put through the model's last step."""
    raw = all_features(spark, sf).withColumn(
        "raw_score", -(F.col("total_moved") / 1000.0 + F.col("fan_in_index"))
    )
    return anomaly.scale_scores(materialize(raw, "raw"))


@query
def anomaly_postprocess(spark, sf):
    return stand_in_scores(spark, sf).select(
        "customer_id", "ml_score", F.col("ml_outlier").cast("int").alias("outlier")
    )


# Rules and gold


@query
def typology_flags(spark, sf):
    return rules.add_flags(all_features(spark, sf), RULES).select("customer_id", *FLAG_COLUMNS)


@query
def risk_scores(spark, sf):
    scored = rules.add_scores(rules.add_flags(stand_in_scores(spark, sf), RULES))
    return scored.select("customer_id", "ml_score", "rule_score", "risk_score", "risk_level")


@query
def risk_profiles(spark, sf):
    tx, customers = silver_pair(spark, sf)
    profiles = layers.risk_profiles(customers, tx, WITH_MODEL)
    return publish(rounded(profiles, "sent_avg", "sent_std", "received_avg"))


@query
def risk_profiles_rules(spark, sf):
    profiles, _, _ = profiles_and_tx(spark, sf)
    text = rounded(profiles, "sent_avg", "sent_std", "received_avg")
    return publish(text.withColumn("ml_outlier", F.col("ml_outlier").cast("int")))


@query
def alerts_query(spark, sf):
    profiles, tx, customers = profiles_and_tx(spark, sf)
    return as_text(publish(alerts(tx, profiles, customers, ALERT_FROM)))



# Report


@query
def report_summary(spark, sf):
    profiles, tx, _ = profiles_and_tx(spark, sf)
    return report.summary(tx, profiles)


def _top(typology: str) -> Query:
    def top(spark, sf):
        profiles, _, _ = profiles_and_tx(spark, sf)
        return report.top_subject(profiles, typology)

    return top


for _typology in report.TYPOLOGIES:
    QUERIES[f"top_{_typology}"] = _top(_typology)


@query
def top_subjects(spark, sf):
    profiles, _, _ = profiles_and_tx(spark, sf)
    return report.top_subjects(profiles)


@query
def report_lines(spark, sf):
    profiles, tx, _ = profiles_and_tx(spark, sf)
    return report.report_lines(tx, profiles)


# Dashboard


def dashboard_rows(spark, sf) -> DataFrame:
    tx = mapped.silver_transactions(spark, sf)
    return dashboard.alert_rows(tx.withColumn("amount_usd", F.col("amount_usd") * 5), DASHBOARD)


@query
def dash_alerts(spark, sf):
    return as_text(dashboard.newest_first(dashboard_rows(spark, sf)))


@query
def dash_date_range(spark, sf):
    return as_text(dashboard.date_range(dashboard_rows(spark, sf), "1998-03-01", "1998-06-30"))


@query
def dash_trend(spark, sf):
    return as_text(dashboard.trend(dashboard_rows(spark, sf)))


@query
def dash_by_rule(spark, sf):
    return dashboard.amount_by_rule(dashboard_rows(spark, sf))


@query
def dash_counters(spark, sf):
    return dashboard.counters(dashboard_rows(spark, sf))


@query
def dash_levels(spark, sf):
    return dashboard.customers_by_level(dashboard_rows(spark, sf))


@query
def dashboard_sql(spark, sf):
    """SQL over the published names, on a view of the silver table as the layers write it."""
    silver, customers = new_table(spark, "silver"), new_table(spark, "silver-customers")
    bronze, people = mapped.bronze_transactions(spark, sf), mapped.bronze_customers(spark, sf)
    layers.refresh_silver(publish(bronze), publish(people), silver, customers)
    silver.as_view("silver_transactions_live")
    return as_text(spark.sql(dashboard.alert_sql("silver_transactions_live", SMALL_AMOUNTS)))


# Flows


def all_flows(spark, sf) -> DataFrame:
    profiles, tx, _ = profiles_and_tx(spark, sf)
    return flows.channel_flows(tx, profiles)


@query
def flow_links(spark, sf):
    return flows.flow_links(all_flows(spark, sf))


@query
def flow_nodes(spark, sf):
    return flows.flow_nodes(materialize(flows.flow_links(all_flows(spark, sf)), "links"))


@query
def risk_rollup(spark, sf):
    return flows.risk_hierarchy(all_flows(spark, sf))


@query
def risk_scatter(spark, sf):
    profiles, tx, _ = profiles_and_tx(spark, sf)
    return as_text(flows.scatter(flows.risk_facts(tx, profiles)))


# Detectors


@query
def fx_convert(spark, sf):
    tx = mapped.silver_transactions(spark, sf)
    return detectors.to_currency(tx).select("tx_id", "currency", "amount_usd", "converted")


@query
def defect_profile(spark, sf):
    return detectors.defect_profile(mapped.bronze_transactions(spark, sf))


@query
def near_duplicates(spark, sf):
    return as_text(detectors.near_duplicates(mapped.bronze_transactions(spark, sf)))


@query
def burst_sessions(spark, sf):
    tx = mapped.silver_transactions(spark, sf)
    return as_text(detectors.burst_sessions(tx, gap_seconds=WEEK, min_events=2))


@query
def cash_splitting(spark, sf):
    tx = mapped.silver_transactions(spark, sf)
    return as_text(detectors.cash_splitting(tx, period="month", total_above=3000.0))


@query
def pass_through(spark, sf):
    tx = mapped.silver_transactions(spark, sf)
    return as_text(detectors.pass_through(tx, limit=None))


@query
def pass_through_near_limit(spark, sf):
    """With the test for amounts just below a limit; limit and margin lie where these amounts do."""
    tx = mapped.silver_transactions(spark, sf)
    return as_text(detectors.pass_through(tx, limit=NEAR_LIMIT, near_limit=NEAR_LIMIT_BY))


@query
def cash_splitting_day(spark, sf):
    """The default form, with a month's payments moved to its first day and larger amounts."""
    tx = mapped.silver_transactions(spark, sf)
    moved = tx.withColumn("tx_ts", F.date_trunc("month", "tx_ts"))
    return as_text(detectors.cash_splitting(moved.withColumn("amount_usd", F.col("amount_usd") * 5)))


@query
def time_profile(spark, sf):
    profile = detectors.time_profile(mapped.silver_transactions(spark, sf))
    return rounded(profile, "night_share", "office_share", "weekend_share")


@query
def single_exit(spark, sf):
    return detectors.single_exit(
        mapped.silver_transactions(spark, sf),
        inbound_channel="Exchange_Crypto",
        min_inbound=2,
        max_exits=3,
        tolerance=None,
    )


@query
def single_exit_balanced(spark, sf):
    """With the default tolerance between what came in and what went out; amounts are made alike, so that some balance."""
    alike = (F.pmod(F.rint("amount_usd").cast("long"), F.lit(3)) + 999).cast("double") / 10
    tx = mapped.silver_transactions(spark, sf).withColumn("amount_usd", alike)
    return detectors.single_exit(tx, inbound_channel="Exchange_Crypto", min_inbound=2, max_exits=3)


# Streams


@query
def stream_upsert(spark, sf):
    """Copies of a key lie in several published files, of which two at a time, with all their parts, are loaded."""
    bronze_path, bronze = fresh_path(spark, "bronze-files"), bronze_rows(spark, sf)
    for name, rows in FILES.items():
        stamped = with_lineage(bronze.filter(rows), name, "core")
        # As many parts as the rows need. A key's rows stay in one file, as the newest file wins; rows without a key are spread.
        by = F.coalesce("tx_id", F.concat_ws(" ", "origin", "destination", "time_text"))
        publish(stamped.repartition(by)).write.parquet(f"{bronze_path}/{name}")
    parts = len(spark.read.schema("tx_id string").parquet(f"{bronze_path}/*").inputFiles())
    table = new_table(spark, "streamed")
    stream_silver(
        spark, f"{bronze_path}/*", table, fresh_path(spark, "progress"), files_per_batch=math.ceil(parts * 2 / len(FILES))
    ).awaitTermination()
    return as_text(publish(table.read().select(*SILVER_COLUMNS, "batch_id", "source_system")))


@query
def stream_bursts(spark, sf):
    schema = mapped.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    out, progress = fresh_path(spark, "bursts"), fresh_path(spark, "progress")
    closed = burst_stream(events, "user_id", "ts", "value", QUARTER_DAY, "1 hour")
    (
        closed.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return as_text(spark.read.schema(closed.schema).parquet(out))
