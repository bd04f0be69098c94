"""Isolation Forest (Liu, Ting, Zhou 2008) as Spark jobs.

Fitting reads the rows twice: a count, and a draw by key hash that keeps a bounded
number of rows whatever the table size. Trees grow in parallel, one small group
each. Scoring sends only the model columns to Python, in Arrow batches, next to a
broadcast node table of at most trees * (2 * max_samples - 1) rows.

All chance comes from md5 and whole-number arithmetic modulo a prime, and depths add up
in whole numbers, so any engine can repeat the model to the last bit.

What runs inside tasks refers to numpy and pandas only, so executors need no copy of
this package.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigiltx.config import ModelConfig
from vigiltx.functions.money import half_even2
from vigiltx.functions.ranks import exact_quantile
from vigiltx.schema import MODEL_COLUMNS

INFINITY_STAND_IN = 999.0

# Draws are words modulo this prime; a product of two words fits a bigint.
PRIME = 2_147_483_629
# Depths are whole multiples of 1 / DEPTH_UNIT, so that their sum has no order.
DEPTH_UNIT = 1 << 20

# The children of node i are 2i + 1 and 2i + 2; path is in units of 1 / DEPTH_UNIT.
NODE_SCHEMA = (
    "tree int, node int, left int, right int, feature int, threshold double, "
    "size int, path bigint"
)


def finite(name: str) -> Column:
    """The column as a double: infinities become 999, NaN and NULL 0."""
    x = F.col(name).cast("double")
    return (
        F.when(x.isNull() | F.isnan(x), 0.0)
        .when(F.abs(x) == float("inf"), INFINITY_STAND_IN)
        .otherwise(x)
    )


def model_vector(features: DataFrame, columns: list[str] = MODEL_COLUMNS) -> DataFrame:
    return features.select("customer_id", *[finite(c).alias(c) for c in columns])


def standardize(vectors: DataFrame, columns: list[str] = MODEL_COLUMNS) -> DataFrame:
    """Z-scores with the population deviation; a constant column is only centred.

    The forest itself splits between a column's own values, so it is the same with
    or without this step.
    """
    moments = vectors.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    ).first()

    def z(name: str) -> Column:
        mean, std = moments[f"mean_{name}"], moments[f"std_{name}"]
        return ((F.col(name) - F.lit(mean)) / F.lit(std or 1.0)).alias(name)

    return vectors.select("customer_id", *[z(c) for c in columns])


def mean_path(n: int) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _word(text: Column, place: int) -> Column:
    """Eight hexadecimal digits of the text's md5, from the 1-based ``place`` on, modulo the prime."""
    digits = F.substring(F.md5(text), place, 8)
    return F.conv(digits, 16, 10).cast("bigint") % F.lit(PRIME)


def _coefficients(cfg: ModelConfig) -> list[tuple[int, int, int]]:
    """For each tree, what its draw multiplies the two words of a key with, and adds."""
    made = []
    for tree in range(cfg.trees):
        digits = hashlib.md5(f"{cfg.seed}:{tree}".encode()).hexdigest()
        a, b, c = (int(digits[i : i + 8], 16) % (PRIME - 1) for i in (0, 8, 16))
        made.append((a + 1, b + 1, c))
    return made


def draw_samples(vectors: DataFrame, cfg: ModelConfig, n: int, spread: float = 12.0) -> DataFrame:
    """``min(max_samples, n)`` rows per tree, without replacement, as (tree, key, columns).

    Every row can enter every tree: a tree takes the rows with the smallest draws, a
    linear hash of two words of the key's md5. Draws far above the smallest are left out
    before the shuffle; the bound lies ``spread`` deviations above the wanted number of
    rows, and ``fit`` draws without it should a tree ever fall short.
    """
    size = min(cfg.max_samples, n)
    near = min(1.0, (size + spread * math.sqrt(size) + 5 * spread) / max(n, 1))
    bound = math.ceil(near * PRIME)
    key = F.col("customer_id").cast("string")
    # Exploded, so that the words are computed once a row and not again for every tree.
    words = F.array(F.struct(_word(key, 1).alias("first"), _word(key, 9).alias("second")))
    hashed = vectors.select("*", F.explode(words).alias("_words"))

    def draw(of: Column) -> Column:
        first = of["a"] * F.col("_words.first") % PRIME
        return (first + of["b"] * F.col("_words.second") % PRIME + of["c"]) % PRIME

    trees = F.array(
        *[
            F.struct(
                F.lit(tree).alias("tree"),
                *[F.lit(v).cast("bigint").alias(name) for name, v in zip("abc", values)],
            )
            for tree, values in enumerate(_coefficients(cfg))
        ]
    )
    w = W.partitionBy("tree").orderBy("_draw", "customer_id")
    return (
        hashed.select("*", F.explode(trees).alias("_tree"))
        .withColumn("_draw", draw(F.col("_tree")))
        .filter(F.col("_draw") < bound)
        .select("_tree.tree", "_draw", *vectors.columns)
        .withColumn("_place", F.row_number().over(w))
        .filter(F.col("_place") <= size)
        .drop("_place", "_draw")
    )


def _grower(columns: list[str], cfg: ModelConfig):
    """The function that grows one tree from its sample.

    The md5 of (seed, tree, node) names the feature, among those that differ in the node,
    and the place of the cut between its lowest and its highest value.
    """
    seed, unit = cfg.seed, DEPTH_UNIT
    below_leaf = [round(mean_path(n) * unit) for n in range(cfg.max_samples + 1)]
    names = ["tree", "node", "left", "right", "feature", "threshold", "size", "path"]

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree, x = int(rows["tree"].iloc[0]), rows[columns].to_numpy(dtype=float)
        limit = math.ceil(math.log2(max(len(x), 2)))
        nodes: list[tuple] = []

        def add(members: np.ndarray, node: int, depth: int) -> None:
            low, high = members.min(axis=0), members.max(axis=0)
            splittable = np.flatnonzero(low < high)
            if depth == limit or not splittable.size:
                path = depth * unit + below_leaf[len(members)]
                nodes.append((tree, node, node, node, 0, math.inf, len(members), path))
                return
            digits = hashlib.md5(f"{seed}:{tree}:{node}".encode()).hexdigest()
            feature = int(splittable[int(digits[:8], 16) % splittable.size])
            share = int(digits[8:16], 16) / 2.0**32
            cut = low[feature] + share * (high[feature] - low[feature])
            if not cut < high[feature]:
                cut = low[feature]
            left, right = 2 * node + 1, 2 * node + 2
            nodes.append((tree, node, left, right, feature, cut, len(members), depth * unit))
            goes_left = members[:, feature] <= cut
            add(members[goes_left], left, depth + 1)
            add(members[~goes_left], right, depth + 1)

        add(x, 0, 0)
        return pd.DataFrame(nodes, columns=names)

    return grow


def node_table(
    vectors: DataFrame,
    cfg: ModelConfig = ModelConfig(),
    columns: list[str] = MODEL_COLUMNS,
    spread: float = 12.0,
) -> DataFrame:
    """Every node of every tree. A leaf points to itself and lets every value pass left."""
    samples = draw_samples(vectors, cfg, vectors.count(), spread)
    return samples.groupBy("tree").applyInPandas(_grower(columns, cfg), NODE_SCHEMA)


@dataclass(frozen=True)
class Forest:
    """A fitted model: node arrays of shape (trees, nodes)."""

    columns: list[str]
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    path: np.ndarray
    depth: int
    sample_size: int


def fit(
    vectors: DataFrame, cfg: ModelConfig = ModelConfig(), columns: list[str] = MODEL_COLUMNS
) -> Forest:
    """Fit on a table of model vectors; pass a written table, it is read more than once."""
    nodes = node_table(vectors, cfg, columns).toPandas()
    roots = nodes.loc[nodes["node"] == 0, "size"]
    if len(nodes) and (len(roots) < cfg.trees or roots.min() < cfg.max_samples):
        if len(roots) < cfg.trees or roots.min() < min(cfg.max_samples, vectors.count()):
            nodes = node_table(vectors, cfg, columns, spread=math.inf).toPandas()
    if nodes.empty:
        raise ValueError("no rows to fit on")
    width = int(nodes["node"].max()) + 1

    def grid(name: str, fill, dtype) -> np.ndarray:
        values = np.full((cfg.trees, width), fill, dtype=dtype)
        values[nodes["tree"], nodes["node"]] = nodes[name]
        return values

    sample_size = int(nodes.loc[nodes["node"] == 0, "size"].max())
    return Forest(
        columns=columns,
        left=grid("left", 0, np.int64),
        right=grid("right", 0, np.int64),
        feature=grid("feature", 0, np.int64),
        threshold=grid("threshold", math.inf, float),
        path=grid("path", 0, np.int64),
        depth=math.ceil(math.log2(max(sample_size, 2))),
        sample_size=sample_size,
    )


def add_raw_score(features: DataFrame, forest: Forest) -> DataFrame:
    """Adds raw_score = -2^(-mean depth / expected depth), in [-1, 0); lower is more anomalous."""
    nodes = features.sparkSession.sparkContext.broadcast(
        {name: getattr(forest, name) for name in ("left", "right", "feature", "threshold", "path")}
    )
    depth, expected, unit = forest.depth, mean_path(forest.sample_size), DEPTH_UNIT

    @F.pandas_udf("double")
    def raw_score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy() for c in columns])
        flat, start, total = x.ravel(), np.arange(len(x)) * x.shape[1], np.zeros(len(x), dtype=np.int64)
        trees = zip(*(nodes.value[k] for k in ("left", "right", "feature", "threshold", "path")))
        count = 0
        for left, right, feature, threshold, path in trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                at = np.where(flat[start + feature[at]] <= threshold[at], left[at], right[at])
            total += path[at]
            count += 1
        # One sampled row expects no depth at all; every row then scores alike.
        share = total / (count * expected * unit) if expected else np.ones(len(x))
        return pd.Series(-(2.0**-share))

    return features.withColumn("raw_score", raw_score(*[finite(c) for c in forest.columns]))


def scale_scores(scored: DataFrame, cfg: ModelConfig = ModelConfig()) -> DataFrame:
    """Turns raw_score into ml_score in 0..100 and ml_outlier.

    The lowest raw score becomes 100, the highest 0; all equal gives 0. Outliers lie
    strictly below the ``contamination`` quantile of the raw scores. Reads ``scored``
    several times: pass a written table.
    """
    offset = exact_quantile(scored, "raw_score", cfg.contamination)
    if offset is None:
        offset = low = high = 0.0
    else:
        low, high = scored.agg(F.min("raw_score"), F.max("raw_score")).first()
    low, spread = low - offset, (high - offset) - (low - offset)
    decision = F.col("raw_score") - F.lit(offset)
    scaled = (1 - (decision - F.lit(low)) / F.lit(spread)) * 100 if spread > 0 else F.lit(0.0)
    return scored.withColumns(
        {"ml_score": half_even2(scaled), "ml_outlier": decision < 0}
    ).drop("raw_score")
