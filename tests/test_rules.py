import pytest

from vigiltx.config import ScoreConfig
from vigiltx.operators.rules import add_flags, add_scores
from vigiltx.schema import FLAG_COLUMNS

CALM = {
    "sent_count": 0, "sent_max": 0.0, "sent_total": 0.0, "received_count": 0, "received_total": 0.0,
    "fan_in_index": 0.0, "crypto_count": 0, "crypto_ratio": 0.0, "moved_income_ratio": 0.0,
}
STRUCTURING = {"sent_count": 5, "sent_max": 2500.0, "sent_total": 9000.0}
FAN_IN = {"received_count": 40, "fan_in_index": 0.7, "sent_total": 7000.0, "received_total": 10000.0}
CRYPTO = {"crypto_count": 3, "sent_max": 2600.0, "crypto_ratio": 0.5}
KYC = {"moved_income_ratio": 3.0, "sent_total": 5000.01}


def flag(spark, name, values):
    row = spark.createDataFrame([{**CALM, **values}])
    return add_flags(row).first()[name]


@pytest.mark.parametrize(
    "change, want",
    [
        ({}, 1), ({"sent_count": 2}, 0), ({"sent_count": 3}, 1), ({"sent_count": 10}, 1),
        ({"sent_count": 11}, 0), ({"sent_max": 3000.0}, 1), ({"sent_max": 3000.01}, 0),
        ({"sent_total": 7999.99}, 0), ({"sent_total": 8000.0}, 1), ({"sent_total": 10500.0}, 1),
        ({"sent_total": 10500.01}, 0),
    ],
)
def test_structuring(spark, change, want):
    assert flag(spark, "flag_structuring", {**STRUCTURING, **change}) == want


@pytest.mark.parametrize(
    "change, want",
    [
        ({}, 1), ({"received_count": 39}, 0), ({"fan_in_index": 0.6999}, 0), ({"sent_total": 6999.99}, 0),
        ({"sent_total": 9999.99}, 1), ({"sent_total": 10000.0}, 0),
    ],
)
def test_fan_in(spark, change, want):
    assert flag(spark, "flag_fan_in", {**FAN_IN, **change}) == want


@pytest.mark.parametrize(
    "change, want",
    [({}, 1), ({"crypto_count": 2}, 0), ({"sent_max": 2600.01}, 0), ({"crypto_ratio": 0.4999}, 0)],
)
def test_crypto(spark, change, want):
    assert flag(spark, "flag_crypto", {**CRYPTO, **change}) == want


@pytest.mark.parametrize(
    "change, want", [({}, 1), ({"moved_income_ratio": 2.9999}, 0), ({"sent_total": 5000.0}, 0)]
)
def test_kyc(spark, change, want):
    assert flag(spark, "flag_kyc", {**KYC, **change}) == want


def scores(spark, flags, ml, cfg=ScoreConfig()):
    row = spark.createDataFrame([{**dict.fromkeys(FLAG_COLUMNS, 0), **flags, "ml_score": ml}])
    return add_scores(row, cfg).first()


def test_rule_score_is_capped(spark):
    assert scores(spark, dict.fromkeys(FLAG_COLUMNS, 1), 0.0).rule_score == 100.0


@pytest.mark.parametrize(
    "ml, risk, level",
    [
        (79.98, 39.99, "BAJO RIESGO - NORMAL"),
        (80.0, 40.0, "MEDIO RIESGO - MONITOREO"),
        (81.33, 40.66, "MEDIO RIESGO - MONITOREO"),
        (81.35, 40.67, "MEDIO RIESGO - MONITOREO"),
    ],
)
def test_levels_without_rules(spark, ml, risk, level):
    row = scores(spark, {}, ml)
    assert (row.risk_score, row.risk_level) == (risk, level)


def test_one_structuring_flag_is_high_only_at_full_score(spark):
    assert scores(spark, {"flag_structuring": 1}, 99.98).risk_level == "MEDIO RIESGO - MONITOREO"
    assert scores(spark, {"flag_structuring": 1}, 100.0).risk_level == "ALTO RIESGO - ALERTA ROS"
    assert scores(spark, {"flag_fan_in": 1}, 100.0).risk_score == 67.5
