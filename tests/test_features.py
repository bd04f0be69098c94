import math
import random
import statistics
from fractions import Fraction

import pytest
from builders import by_key, customers, silver
from conftest import executed_plan
from pyspark.sql import functions as F

from harness import mapped
from vigiltx.functions.money import convert, half_even2, money_sum, round2, with_round2
from vigiltx.operators.features import customer_features, received_features, sent_features
from vigiltx.schema import FEATURE_COLUMNS


def test_totals_of_each_side(spark):
    tx = silver(
        spark,
        [
            ("a", "b", "Cajero", 10.0, 0),
            ("a", "b", "EXCHANGE_x", 20.5, 1),
            ("a", "c", "Plataforma_Terceros", 30.25, 2),
            ("a", "a", "Deposito_Efectivo", 5.0, 3),
            ("x", "a", "Crypto_Wallet", 7.0, 4),
        ],
    )
    out, into = by_key(sent_features(tx)), by_key(received_features(tx))
    a = out["a"]
    assert (a["sent_count"], a["sent_total"], a["sent_max"]) == (4, 65.75, 30.25)
    assert a["sent_avg"] == 65.75 / 4
    assert a["sent_std"] == pytest.approx(statistics.stdev([10.0, 20.5, 30.25, 5.0]))
    assert a["unique_receivers"] == 3
    assert (a["cash_count"], a["crypto_count"], a["platform_count"]) == (2, 1, 1)
    assert (into["a"]["received_count"], into["a"]["received_total"], into["a"]["unique_senders"]) == (2, 12.0, 2)
    both = by_key(customer_features(customers(spark, [("a", 100.0)]), tx))["a"]
    for name, value in {**out["a"], **into["a"]}.items():
        assert both[name] == value
    assert both["total_moved"] == 77.75  # the self-transfer counts on both sides


def test_gaps_become_zero_and_ratios_have_guards(spark):
    tx = silver(
        spark,
        [("sender", "x", "c", 100.0, 0), ("x", "receiver", "c", 50.0, 0), ("both", "x", "c", 10.0, 0),
         ("x", "both", "c", 30.0, 0)],
    )
    people = customers(
        spark,
        [("idle", 500.0), ("sender", None), ("receiver", 0.0), ("both", -5.0), ("null age", None, None, 1.0)],
    )
    f = by_key(customer_features(people, tx))
    assert list(f["idle"]) == FEATURE_COLUMNS
    assert f["idle"]["sent_count"] == 0 and f["idle"]["out_in_ratio"] == 0.0
    assert f["idle"]["fan_in_index"] == 0.0 and f["idle"]["crypto_ratio"] == 0.0
    assert f["sender"]["out_in_ratio"] == 999.0 and f["sender"]["sent_std"] == 0.0
    assert f["sender"]["monthly_income"] == 0.0
    assert f["sender"]["moved_income_ratio"] == round(100 / 12000, 4)
    assert f["receiver"]["out_in_ratio"] == 0.0 and f["receiver"]["fan_in_index"] == 1.0
    assert f["both"]["out_in_ratio"] == 0.3333
    assert f["null age"]["age"] == 0 and f["null age"]["occupation"] is None


def test_unknown_parties(spark):
    tx = silver(spark, [(None, "a", "c", 1.0, 0), ("a", None, "c", 2.0, 0), ("a", "b", "c", 3.0, 0)])
    f = by_key(customer_features(customers(spark, [("a", 1.0)]), tx))["a"]
    assert (f["sent_count"], f["unique_receivers"]) == (2, 1)
    assert (f["received_count"], f["unique_senders"]) == (1, 0)


def test_same_result_for_any_partitioning(spark):
    rows = [(f"c{i % 7}", f"d{i % 5}", "Crypto", 0.1 * (i % 97) + 1e6 * (i % 3), i) for i in range(500)]
    tx = silver(spark, rows).withColumn("amount_usd", F.round("amount_usd", 2))
    people = customers(spark, [(f"c{i}", 100.0) for i in range(7)])
    seen = {
        tuple(sorted(customer_features(people, tx.orderBy(order).repartition(parts)).collect()))
        for parts, order in ((1, "tx_id"), (4, "amount_usd"), (16, "destination"))
    }
    assert len(seen) == 1


def test_spread_is_exact(spark):
    tx = silver(spark, [("a", f"d{i}", "c", 100.10, i) for i in range(10)] + [("b", f"d{i}", "c", 9e9 + i / 100, i) for i in range(3)])
    out = by_key(sent_features(tx))
    assert out["a"]["sent_std"] == 0.0
    assert out["b"]["sent_std"] == pytest.approx(0.01)


def test_spread_against_statistics(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for g in range(60):
        scale = 10 ** rng.uniform(0, 9)
        amounts = [round(rng.uniform(0.9 * scale, scale), 2) for _ in range(rng.randint(2, 30))]
        want[f"g{g}"] = statistics.stdev(amounts)
        rows += [(f"g{g}", f"d{i % 4}", "c", x, i) for i, x in enumerate(amounts)]
    got = by_key(sent_features(silver(spark, rows)))
    assert {k: r["sent_std"] for k, r in got.items()} == pytest.approx(want, rel=1e-12)


def test_infinite_and_nan_amounts(spark):
    tx = silver(spark, [("a", "b", "c", math.inf, 0), ("a", "b", "c", 5.0, 0), ("n", "b", "c", math.nan, 0)])
    out = by_key(sent_features(tx))
    assert out["a"]["sent_total"] == math.inf and math.isnan(out["a"]["sent_std"])
    assert math.isnan(out["n"]["sent_total"])


def test_transactions_are_read_once(spark, tmp_path):
    path = str(tmp_path / "tx")
    silver(spark, [("a", "b", "c", 1.0, 0)]).write.parquet(path)
    plan = executed_plan(customer_features(customers(spark, [("a", 1.0)]), spark.read.parquet(path)))
    assert plan.count("FileScan parquet") == 1
    assert "ReadSchema: struct<tx_id:string,origin:string,destination:string,channel:string,amount_usd:double>" in plan


@pytest.mark.parametrize("x, want", [(40.665, 40.66), (40.675, 40.67), (0.125, 0.12), (2.5, 2.5)])
def test_half_even(spark, x, want):
    assert spark.range(1).select(half_even2(F.lit(x))).first()[0] == want


def test_sums_of_large_amounts(spark):
    for amounts in ([9.5e16], [5e16, 5e16], [1e26, -0.01, 123.45, 9.5e16], [7e13 + 0.25, 0.25]):
        want = float(sum(map(Fraction, amounts)))
        for order in (amounts, amounts[::-1]):
            tx = silver(spark, [("a", f"d{i}", "c", x, i) for i, x in enumerate(order)])
            assert by_key(sent_features(tx))["a"]["sent_total"] == want
            assert tx.agg(money_sum(F.col("amount_usd"))).first()[0] == want
    wide = [3e17, 5e17, 8e17, 1.5]
    tx = silver(spark, [("a", "b", "c", x, i) for i, x in enumerate(wide)])
    assert by_key(sent_features(tx))["a"]["sent_std"] == pytest.approx(statistics.stdev(wide), rel=1e-9)


def test_beyond_any_money_counts_as_infinite(spark):
    tx = silver(spark, [("a", "b", "c", 2e27, 0), ("a", "c", "c", 5.0, 0)])
    assert by_key(sent_features(tx))["a"]["sent_total"] == math.inf


# The right column is what Python's round(x, 2) says.
ROUNDED = [
    (0.125, 0.12), (0.375, 0.38), (2.675, 2.67), (1.005, 1.0), (-2.675, -2.67), (40.665, 40.66), (0.005, 0.01), (0.015, 0.01),
    (1e13 + 0.005, 10000000000000.01), (8e15 + 1, 8000000000000001.0), (99.995, 100.0), (0.045, 0.04), (1.115, 1.11), (0.0, 0.0),
]


def test_rounding_of_the_exact_value(spark):
    assert all(round(x, 2) == want for x, want in ROUNDED)
    rows = spark.createDataFrame(ROUNDED, "x double, want double").withColumn("got", round2(F.col("x"))).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    draw = random.Random(4)
    many = [draw.uniform(-1, 1) * 10 ** draw.randint(-2, 15) for _ in range(2000)] + [k / 8 for k in range(-800, 800)] + [round(draw.uniform(0, 1e5), 3) for _ in range(2000)]
    got = spark.createDataFrame([(x,) for x in many], "x double").select("x", round2(F.col("x")).alias("y")).collect()
    assert [r.y for r in got] == [round(r.x, 2) for r in got]
    odd = spark.createDataFrame([(math.inf,), (-math.inf,), (None,)], "x double").select(round2(F.col("x"))).collect()
    assert [r[0] for r in odd] == [math.inf, -math.inf, None]


def test_money_sum_is_null_for_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert empty.agg(money_sum(F.col("x"))).first()[0] is None


def test_conversion(spark):
    rows = spark.createDataFrame([(10.0, "PEN"), (1.0, "JPY"), (2.0, "XXX")], "usd double, cur string")
    got = [r[0] for r in rows.select(convert(F.col("usd"), F.col("cur"))).collect()]
    assert got == [33.5, 159.35, None]


def test_rounding_in_steps_equals_rounding_at_once(spark):
    draw = random.Random(4)
    values = [0.125, 1.005, 2.675, -0.125, 0.0, -0.0, 1e15 + 0.5, 2.0**44, 2.0**44 - 0.005, 3e26, 1e27, 1e300, math.inf, -math.inf, math.nan, None, 5e-324]
    values += [draw.uniform(-1, 1) * 10 ** draw.randint(-4, 20) for _ in range(500)] + [draw.randint(0, 10**6) / 1000 for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    made = with_round2(rows.withColumn("at_once", round2(F.col("v"))), "steps", F.col("v"))
    assert made.columns == ["v", "at_once", "steps"]
    assert [r.v for r in made.filter("NOT at_once <=> steps").collect()] == []


def test_bronze_looks_up_a_rate_once_a_row(spark, tmp_path):
    lines = "1L l_orderkey, 2L l_partkey, 3L l_suppkey, 1 l_linenumber, 100.0D l_extendedprice, 'R' l_returnflag, 'F' l_linestatus, date '2026-01-01' l_shipdate"
    spark.sql(f"SELECT {lines}").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("SELECT 1L o_orderkey, 4L o_custkey, '1-URGENT' o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    bronze = mapped.bronze_transactions(spark, str(tmp_path))
    plan = bronze._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("USD") <= 4  # two lists of currencies, the rates; before, the rates stood at each use of the amount
    assert bronze.count() == 2
