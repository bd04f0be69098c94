import os
import subprocess
import sys

import pytest
from harness.check import compare, database
from harness.oracles import ORACLES
from harness.registry import QUERIES

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    built = []

    def query(*args):
        built.append(QUERIES[name](*args))
        return built[0]

    assert compare(spark, con, SF, query, ORACLES[name]) == ""
    plan = built[0]._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_near_limit_finds_what_the_share_does_not(spark):
    plain, near = ({r.customer_id for r in QUERIES[q](spark, SF).collect()} for q in ("pass_through", "pass_through_near_limit"))
    assert plain < near


def test_model_scores_every_customer(spark):
    rows = QUERIES["anomaly_scores"](spark, SF).collect()
    scores = [r.ml_score for r in rows]
    assert len(rows) == 150 and min(scores) == 0.0 and max(scores) == 100.0
    # The quantile lies between ranks 22 and 23 (0.15 * 149 = 22.35): at most 23 rows below it.
    assert 0 < sum(r.ml_outlier for r in rows) <= 23


def test_executors_need_no_copy_of_the_package(tmp_path):
    """The driver finds the package by path; its Python workers do not."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert e.entry(spark).count() == 177
assert e.queries()["risk_profiles"](spark, {SF!r}).count() == 150
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
