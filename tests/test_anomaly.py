import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigiltx.config import ModelConfig
from vigiltx.functions.ranks import dense_index, exact_quantile, order_statistic
from vigiltx.operators import anomaly
from vigiltx.sources.shared import materialize

COLUMNS = ["x", "y", "z"]


def cloud(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(f"c{i:06d}", *map(float, v)) for i, v in enumerate(rng.normal(size=(n, 3)))]
    return spark.createDataFrame(rows, "customer_id string, x double, y double, z double")


def score(vectors, cfg=ModelConfig(trees=40)):
    forest = anomaly.fit(vectors, cfg, COLUMNS)
    return anomaly.scale_scores(materialize(anomaly.add_raw_score(vectors, forest), "scores"), cfg)


def test_vector_has_no_gaps(spark):
    row = spark.createDataFrame(
        [("c", math.inf, math.nan, None), ("d", -math.inf, 2.0, 3.0)],
        "customer_id string, x double, y double, z double",
    )
    got = {r[0]: tuple(r[1:]) for r in anomaly.model_vector(row, COLUMNS).collect()}
    assert got == {"c": (999.0, 0.0, 0.0), "d": (999.0, 2.0, 3.0)}


def test_standardize(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 5.0, 0.0), ("b", 3.0, 5.0, 0.0)], "customer_id string, x double, y double, z double"
    )
    got = {r[0]: tuple(r[1:]) for r in anomaly.standardize(rows, COLUMNS).collect()}
    assert got == {"a": (-1.0, 0.0, 0.0), "b": (1.0, 0.0, 0.0)}


@pytest.mark.parametrize("n", [1, 255, 256, 257, 3000])
def test_each_tree_gets_its_sample(spark, n):
    cfg = ModelConfig(trees=10)
    vectors = cloud(spark, n)
    samples = anomaly.draw_samples(vectors, cfg, n)
    per_tree = samples.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("customer_id").alias("d"))
    assert {tuple(r) for r in per_tree.select("n", "d").collect()} == {(min(256, n), min(256, n))}
    assert per_tree.count() == 10


def test_every_row_of_a_large_table_can_enter_a_tree(spark):
    cfg = ModelConfig(trees=2, max_samples=256)
    vectors = spark.range(400_000).select(
        F.col("id").cast("string").alias("customer_id"), *[F.rand(i).alias(c) for i, c in enumerate(COLUMNS)]
    )
    samples = anomaly.draw_samples(vectors, cfg, 400_000)
    drawn = [set() for _ in range(2)]
    for tree, key in samples.select("tree", "customer_id").collect():
        drawn[tree].add(key)
    assert [len(d) for d in drawn] == [256, 256]
    # Out of all rows two draws of 256 share 0.16 on average; out of a thinned pool they would share many.
    assert len(drawn[0] & drawn[1]) < 4


def test_model_is_the_same_for_any_partitioning(spark):
    cfg = ModelConfig(trees=5)
    vectors = materialize(cloud(spark, 1000), "vectors")
    runs = [
        sorted(map(tuple, anomaly.node_table(vectors.repartition(p), cfg, COLUMNS).collect()))
        for p in (1, 4, 16)
    ]
    assert runs[0] == runs[1] == runs[2]
    sizes = {}
    for row in runs[0]:
        sizes.setdefault(row[0], []).append(row)
    assert all(len(nodes) <= 511 and nodes[0][6] == 256 for nodes in sizes.values())


def test_scores(spark):
    planted = spark.createDataFrame([("odd", 50.0, 50.0, 50.0)], "customer_id string, x double, y double, z double")
    vectors = materialize(cloud(spark, 2000).unionByName(planted), "vectors")
    got = score(vectors).select("customer_id", "ml_score", "ml_outlier").collect()
    values = sorted((r.ml_score for r in got), reverse=True)
    assert values[0] == 100.0 and values[-1] == 0.0
    odd = next(r for r in got if r.customer_id == "odd")
    assert odd.ml_score >= values[20]  # the most extreme hundredth
    share = sum(r.ml_outlier for r in got) / len(got)
    assert 0.14 <= share <= 0.15


def test_raw_scores_match_a_walk_through_the_nodes(spark):
    cfg = ModelConfig(trees=12)
    vectors = materialize(cloud(spark, 700), "vectors")
    nodes = {(r.tree, r.node): r for r in anomaly.node_table(vectors, cfg, COLUMNS).collect()}

    def depth(tree, row):
        node = nodes[tree, 0]
        steps = 0
        while node.left != node.node:
            goes_left = row[COLUMNS[node.feature]] <= node.threshold
            node = nodes[tree, node.left if goes_left else node.right]
            steps += 1
        assert node.path == pytest.approx((steps + anomaly.mean_path(node.size)) * anomaly.DEPTH_UNIT, abs=1)
        return node.path / anomaly.DEPTH_UNIT

    scored = anomaly.add_raw_score(vectors, anomaly.fit(vectors, cfg, COLUMNS)).collect()
    expected = anomaly.mean_path(256)
    for row in scored:
        mean = sum(depth(t, row) for t in range(cfg.trees)) / cfg.trees
        assert row.raw_score == pytest.approx(-(2 ** (-mean / expected)), rel=1e-12)


def test_children_split_their_parent(spark):
    rows = anomaly.node_table(cloud(spark, 600), ModelConfig(trees=3), COLUMNS).collect()
    nodes = {(r.tree, r.node): r for r in rows}
    for r in rows:
        if r.left != r.node:
            assert nodes[r.tree, r.left].size + nodes[r.tree, r.right].size == r.size
            assert min(nodes[r.tree, r.left].size, nodes[r.tree, r.right].size) > 0


@pytest.mark.parametrize("n", [1, 5])
def test_equal_customers_score_zero(spark, n):
    same = spark.createDataFrame(
        [(f"c{i}", 1.0, 1.0, 1.0) for i in range(n)], "customer_id string, x double, y double, z double"
    )
    assert {(r.ml_score, r.ml_outlier) for r in score(same).collect()} == {(0.0, False)}


@pytest.mark.parametrize("q", [0.0, 0.15, 0.5, 0.999, 1.0])
@pytest.mark.parametrize("kind", ["spread", "ties", "wide"])
def test_exact_quantile(spark, q, kind):
    rng = np.random.default_rng(3)
    values = {
        "spread": rng.normal(size=501),
        "ties": rng.integers(0, 4, size=400).astype(float),
        "wide": 10.0 ** rng.uniform(-9, 9, size=300),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert exact_quantile(df, "v", q) == pytest.approx(np.percentile(values, q * 100), rel=1e-14)


def test_order_statistic_with_two_slices(spark):
    df = spark.createDataFrame([(float(v),) for v in (5, 1, 4, 1, 3)], "v double")
    assert [order_statistic(df, "v", k, bins=2) for k in range(5)] == [1, 1, 3, 4, 5]


def test_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5) is None


def test_dense_index(spark):
    df = spark.range(1000).select(F.format_string("%04d", F.col("id")).alias("name")).repartition(7)
    got = dense_index(df, ["name"], "place").orderBy("name").collect()
    assert [r.place for r in got] == list(range(1000))


def test_mean_path():
    assert [anomaly.mean_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert anomaly.mean_path(256) == pytest.approx(10.2448, abs=1e-4)


def test_nothing_to_fit_on(spark):
    with pytest.raises(ValueError):
        anomaly.fit(cloud(spark, 1).limit(0), ModelConfig(trees=2), COLUMNS)
