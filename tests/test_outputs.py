from datetime import date

import pytest
from builders import customers, silver
from conftest import executed_plan
from pyspark.sql import functions as F

from vigiltx.config import DashboardConfig, MonitorConfig, RuleThresholds, ScoreConfig
from vigiltx.operators.alerts import alerts
from vigiltx.operators.rules import add_flags, add_scores
from vigiltx.plans import dashboard, flows, report
from vigiltx.plans.layers import layer_counts, rule_profiles, sample_rows
from vigiltx.schema import ALERT_COLUMNS, FLAG_COLUMNS, PROFILE_COLUMNS

RULE_ONLY = MonitorConfig(scores=ScoreConfig(ml_share=0.0, rule_share=1.0))


def profiles(spark, rows):
    """Rows as dicts over an otherwise calm profile."""
    calm = {c: 0.0 for c in PROFILE_COLUMNS} | dict.fromkeys(FLAG_COLUMNS, 0)
    calm |= dict.fromkeys(("sent_count", "received_count", "crypto_count", "unique_receivers"), 0)
    calm |= {"customer_id": "c", "occupation": "x", "risk_level": "x", "ml_outlier": False}
    return spark.createDataFrame([{**calm, **r} for r in rows])


def test_alerts_follow_the_sender(spark):
    tx = silver(spark, [("a", "b", "c", 1.0, 0), ("b", "a", "c", 2.0, 1), ("c", "a", "c", 3.0, 2)])
    people = customers(spark, [("a", None, None, None), ("c", 5.0)])
    at_risk = profiles(spark, [{"customer_id": "a", "risk_score": 40.0}, {"customer_id": "c", "risk_score": 39.99}])
    (row,) = alerts(tx, at_risk, people).collect()
    assert list(row.asDict()) == ALERT_COLUMNS
    assert (row.tx_id, row.customer_id, row.age, row.monthly_income) == ("t0", "a", None, None)


def test_alerts_from_one_lineage(spark):
    tx = silver(spark, [("a", "a", "Deposito_Efectivo", 2900.0, i) for i in range(3)])
    people = customers(spark, [("a", 10.0)])
    found = alerts(tx, rule_profiles(people, tx, RULE_ONLY), people)
    assert [(r.flag_structuring, r.flag_kyc, r.rule_score, r.risk_level) for r in found.collect()] == [
        (1, 1, 65.0, "MEDIO RIESGO - MONITOREO")
    ] * 3


def test_a_sender_with_most_rows_is_split(spark):
    n = 60_000
    tx = spark.range(n).select(
        F.col("id").cast("string").alias("tx_id"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("origin"),
        *[F.lit("x").alias(c) for c in ("destination", "channel", "geography", "currency")],
        *[F.lit(1.0).alias(c) for c in ("amount_original", "amount_usd")],
        F.lit("2026-09-01").cast("date").alias("tx_date"), F.lit("12:00:00").alias("tx_time"),
    )
    at_risk = profiles(spark, [{"customer_id": "hot", "risk_score": 90.0}, *({"customer_id": f"c{i}", "risk_score": 90.0} for i in range(500))])
    people = customers(spark, [("hot", 1.0)])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = alerts(tx, at_risk, people)
        plan = executed_plan(found)
        assert "skew=true" in plan and found.count() == n
    finally:
        for k in settings:
            spark.conf.unset(k)


FLAGGED = [
    {"customer_id": "f2", "flag_fan_in": 1, "total_moved": 9.0, "received_count": 41, "sent_total": 1234.5, "moved_income_ratio": 1234.567},
    {"customer_id": "f1", "flag_fan_in": 1, "total_moved": 9.0, "received_count": 40, "sent_total": 1234.5, "moved_income_ratio": 1234.567},
    {"customer_id": "f0", "flag_fan_in": 1, "total_moved": 8.0},
    {"customer_id": "k", "flag_crypto": 1, "flag_kyc": 1, "total_moved": 1.0, "sent_total": 2500.0, "crypto_ratio": 0.625, "crypto_count": 5},
]


def test_subjects(spark):
    p = profiles(spark, FLAGGED)
    found = {r.typology: r for r in report.top_subjects(p).collect()}
    assert set(found) == {"fan_in", "crypto"} and found["fan_in"].customer_id == "f1"
    one = report.top_subject(p, "fan_in").first()
    assert one.asDict() == {"customer_id": "f1", "received_count": 40, "sent_total": 1234.5, "moved_income_ratio": 1234.567}
    assert report.top_subject(p, "structuring").count() == 0


def test_summary_and_lines(spark):
    tx = silver(spark, [("a", "b", "c", 1.0, i) for i in range(1234)])
    p = profiles(spark, FLAGGED)
    assert report.summary(tx, p).first().asDict() == {
        "total_tx": 1234, "total_customers": 4, "structuring_alerts": 0, "fan_in_alerts": 3, "crypto_alerts": 1, "total_alerts": 4,
    }
    lines = {(r.section, r.place): r.line for r in report.report_lines(tx, p).collect()}
    assert "universo de 1,234 operaciones" in lines["summary", 1] and "cartera de 4 clientes" in lines["summary", 1]
    assert lines["distribution", 1] == "- Concentración de Fondos (Fan-In): 3 alertas."
    assert lines["subjects", 1] == "- Sujeto ID: f1 (Fan-In)"
    assert lines["subjects", 2] == (
        "Recibió 40 transferencias, luego envió un total de USD 1,234.50 con una relación de ingresos/operado de 1234.57."
    )
    assert lines["subjects", 4] == (
        "Canalizó USD 2,500.00 a exchanges, representando el 62.5% de sus transferencias de salida en 5 envíos."
    )
    assert ("subjects", 5) not in lines and len(lines) == 8


def test_summary_of_empty_tables(spark):
    row = report.summary(silver(spark, [("a", "b", "c", 1.0, 0)]).limit(0), profiles(spark, [{}]).limit(0)).first()
    assert set(row.asDict().values()) == {0}


def test_report_has_no_join(spark):
    plan = executed_plan(report.report_lines(silver(spark, [("a", "b", "c", 1.0, 0)]), profiles(spark, FLAGGED)))
    assert "Join" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize(
    "amount, rule, red",
    [
        (5000.01, "Other Rule", False), (6000.0, "Other Rule", False), (6000.01, "Fan-In Platform", False),
        (8000.01, "Crypto Mixer", False), (9000.0, "Crypto Mixer", False), (9000.01, "Structuring (Pitufeo)", True),
        (9500.0, "Structuring (Pitufeo)", True), (9500.01, "KYC Deviation", True),
    ],
)
def test_dashboard_bands(spark, amount, rule, red):
    (row,) = dashboard.alert_rows(silver(spark, [("a", "b", "c", amount, 0)])).collect()
    assert row.Rule_Triggered == rule and row.Nivel_Riesgo.startswith("ALTO" if red else "MEDIO")


def test_dashboard_filters_and_widgets(spark):
    day = 86_400
    tx = silver(spark, [("a", "b", "c", 5000.0, 0), ("a", "b", "c", 7000.0, 0), ("a", "b", "c", 9600.0, day), ("b", "x", "c", 9600.5, 2 * day), ("b", "x", "c", 9999.0, None)])
    rows = dashboard.alert_rows(tx, DashboardConfig(since="2026-09-01"))
    assert rows.count() == 3
    assert dashboard.alert_rows(tx, DashboardConfig(since="2026-09-02")).count() == 2
    assert [r.Alert_ID for r in dashboard.newest_first(rows).collect()] == ["t3", "t2", "t1"]
    assert dashboard.counters(rows).first().asDict() == {"alerts": 3, "amount": 26200.5}
    assert {r.Nivel_Riesgo[:4]: r.customers for r in dashboard.customers_by_level(rows).collect()} == {"ALTO": 2, "MEDI": 1}
    assert {r.Fecha: r.in_range for r in dashboard.date_range(rows, "2026-09-02", "2026-09-03").collect()} == {
        date(2026, 9, 1): 0, date(2026, 9, 2): 1, date(2026, 9, 3): 1,
    }
    assert {r.Rule_Triggered: r.amount for r in dashboard.amount_by_rule(rows).collect()} == {"Fan-In Platform": 7000.0, "KYC Deviation": 19200.5}
    assert {r.alerts for r in dashboard.trend(rows).collect()} == {1}


def test_flows(spark):
    tx = silver(spark, [("f", "x", "Efectivo", 10.0, 0), ("f", "y", "Efectivo", 5.0, 1), ("n", "x", "Tarjeta", 1.0, 2), ("stranger", "x", "Tarjeta", 100.0, 3)])
    p = profiles(spark, [{"customer_id": "f", "flag_structuring": 1, "flag_kyc": 1, "rule_score": 65.0}, {"customer_id": "n"}])
    by_channel = flows.channel_flows(tx, p)
    links = flows.flow_links(by_channel)
    assert {tuple(r) for r in links.collect()} == {
        ("Efectivo", "Pitufeo (Structuring)", 15.0, "structuring"), ("Tarjeta", "Normal", 1.0, "normal"),
    }
    assert [tuple(r) for r in flows.flow_nodes(links).orderBy("node").collect()] == [
        (0, "Efectivo"), (1, "Tarjeta"), (2, "Normal"), (3, "Pitufeo (Structuring)"),
    ]
    tree = {(r.classification, r.pattern, r.channel, r.level): r.amount for r in flows.risk_hierarchy(by_channel).collect()}
    assert tree[None, None, None, 7] == 16.0 and tree["Alerta AML (Fraude)", None, None, 3] == 15.0 and len(tree) == 7
    dots = {r.tx_id: (r.z, r.pattern) for r in flows.scatter(flows.risk_facts(tx, p)).collect()}
    assert dots["t0"] == (0.65, "Pitufeo (Structuring)") and set(dots) == {"t0", "t1", "t2"}


def test_counts_and_samples(spark):
    tx = silver(spark, [("a", "b", "c", 1.0, i) for i in range(9)])
    counts = {r.layer: r.rows for r in layer_counts(tx, customers(spark, [("a", 1.0)])).collect()}
    assert counts == {"silver_transactions": 9, "silver_customers": 1}
    assert [r.tx_id for r in sample_rows(tx, ["tx_id"]).collect()] == ["t0", "t1", "t2", "t3", "t4"]


def test_thresholds_are_arguments(spark):
    tx = silver(spark, [(f"s{i}", "a", "c", 10.0, i) for i in range(4)] + [("a", "x", "c", 30.0, 9)])
    people = customers(spark, [("a", 1e9)])
    hit = rule_profiles(people, tx, MonitorConfig(rules=RuleThresholds(fan_in_received=4))).first()
    assert (hit.flag_fan_in, rule_profiles(people, tx).first().flag_fan_in) == (1, 0)


def test_flags_and_scores_stay_lazy(spark):
    p = profiles(spark, [{}])
    assert "Exchange" not in executed_plan(add_scores(add_flags(p)))
