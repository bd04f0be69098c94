"""Quality scores: n-gram indicators scaled by log-count ratios, and a linear hinge-loss model over them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from vigiltx.llm.common import CHUNK, carried, number, ship, smallest, uncarried
from vigiltx.sources.shared import materialize


@dataclass(frozen=True)
class QualityConfig:
    """``rows`` labelled texts of each label at most are fitted on, those with the smallest hashes of their ids.

    Indicators: byte n-grams of ``sizes``, folded into ``features`` numbers; how often the most frequent of the lines
    and the words of a text returns, in powers of two.
    """

    rows: int = 3000
    sizes: tuple[int, ...] = (1, 2, 3)
    features: int = 1 << 16
    smoothing: float = 1.0
    penalty: float = 1.0
    rounds: int = 30
    folds: int = 4
    threshold: float = 0.3


def _level(kind: int, n: int, features: int) -> int:
    return (0x51ED27 * kind + 0x2545F4 * n + 7) % features


def indicators(text: str | None, config: QualityConfig) -> np.ndarray:
    """Sorted numbers of the features that a text has; long texts are read in pieces that overlap."""
    raw = (text or "").encode("utf-8", "replace")
    seen = np.zeros(config.features, bool)
    for at in range(0, len(raw), CHUNK):
        piece = np.frombuffer(raw[max(0, at - max(config.sizes) + 1) : at + CHUNK], np.uint8).astype(np.uint32)
        for n in config.sizes:
            if len(piece) < n:
                continue
            rolled = np.full(len(piece) - n + 1, n, np.uint32)
            for k in range(n):
                rolled = rolled * np.uint32(0x01000193) + piece[k : len(piece) - n + 1 + k] * np.uint32(0x9E3779B1)
            rolled ^= rolled >> np.uint32(15)
            rolled *= np.uint32(0x2C1B3C6D)
            rolled ^= rolled >> np.uint32(13)
            seen[rolled % np.uint32(config.features)] = True
    for kind, parts in enumerate((raw.split(b"\n"), raw.split()), 1):
        parts = [p for p in parts if p]
        repeats = len(parts) - len(set(parts))
        share = int(8 * repeats / len(parts)) if parts else 8
        seen[_level(kind, share, config.features)] = True
        seen[_level(kind + 2, len(parts).bit_length(), config.features)] = True
    return np.flatnonzero(seen)


def ratios(rows: list[np.ndarray], good: np.ndarray, config: QualityConfig) -> np.ndarray:
    """For each feature, the log of its smoothed share in the texts of label 1 over that in the texts of label 0."""
    counts = np.full((2, config.features), config.smoothing)
    for label in (0, 1):
        own = [r for r, y in zip(rows, good, strict=True) if y == label]
        if own:
            counts[label] += np.bincount(np.concatenate(own), minlength=config.features)
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], good: np.ndarray, weight: np.ndarray, config: QualityConfig) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised hinge-loss model, by coordinate descent on its dual."""
    w, bias = np.zeros(config.features), 0.0
    sign = np.where(good == 1, 1.0, -1.0)
    alpha = np.zeros(len(rows))
    curve = np.array([v @ v + 1.0 for v in values])
    most = config.penalty * weight
    draw = np.random.default_rng(7)
    for _ in range(config.rounds):
        moved = 0.0
        for i in draw.permutation(len(rows)):
            gradient = sign[i] * (w[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / curve[i], 0.0), most[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def calibrated(margin: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, by weighted logistic regression with a soft target."""
    up, down = weight[good == 1].sum(), weight[good == 0].sum()
    target = np.where(good == 1, (up + 1) / (up + 2), 1 / (down + 2))
    slope, offset = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        g = weight * (p - target)
        h = weight * p * (1 - p) + 1e-9
        a = np.array([[(h * margin * margin).sum() + 1e-6, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(a, np.array([(g * margin).sum(), g.sum()]))
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(slope, 1e-6)), float(offset)


@dataclass(frozen=True)
class QualityModel:
    """``weight``: one number for each feature, the log-count ratio times the model's weight."""

    weight: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float
    offset: float
    config: QualityConfig

    def margin(self, rows: np.ndarray) -> float:
        norm = np.sqrt((self.ratio[rows] ** 2).sum()) if len(rows) else 0.0
        return float(self.weight[rows].sum() / (norm or 1.0) + self.bias)

    def score(self, text: str | None) -> float:
        z = self.slope * self.margin(indicators(text, self.config)) + self.offset
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))

    @classmethod
    def build(cls, rows: list[np.ndarray], good: np.ndarray, prior: float, config: QualityConfig) -> QualityModel:
        """``prior``: the share of label 1 among all labelled rows, which the sample's classes are weighted to."""
        if len(set(good.tolist())) < 2:
            z = np.zeros(config.features)
            sure = float(good[0]) if len(good) else 0.5
            return cls(z, z, 0.0, 1.0, float(np.log((sure + 0.01) / (1.01 - sure))), config)
        share = good.mean()
        weight = np.where(good == 1, prior / share, (1 - prior) / (1 - share))
        balance = np.where(good == 1, 0.5 / share, 0.5 / (1 - share))

        def solved(use: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
            mine = [rows[i] for i in use]
            r = ratios(mine, good[use], config)
            values = [r[x] / (np.sqrt((r[x] ** 2).sum()) or 1.0) for x in mine]
            w, bias = dual_descent(mine, values, good[use], balance[use], config)
            return r, w * r, bias

        fold = np.arange(len(rows)) % config.folds
        margin = np.zeros(len(rows))
        for f in range(config.folds):
            use = np.flatnonzero(fold != f)
            if len(set(good[use].tolist())) < 2:
                continue
            r, w, bias = solved(use)
            part = cls(w, r, bias, 1.0, 0.0, config)
            for i in np.flatnonzero(fold == f):
                margin[i] = part.margin(rows[i])
        slope, offset = calibrated(margin, good, weight)
        r, w, bias = solved(np.arange(len(rows)))
        return cls(w, r, bias, slope, offset, config)


def fit(docs: DataFrame, known: DataFrame, config: QualityConfig = QualityConfig()) -> QualityModel:
    """A model of ``docs`` (id, text) and ``known`` (id, label); labels other than 0 or 1 are passed over, a null text is
    empty, and of the texts of a repeated id one counts.

    The sample is drawn from ids and labels alone; only its texts are shuffled. What reaches the driver are the feature
    numbers of 2 x ``config.rows`` texts at most.
    """
    known = known.where("label in (0, 1)").select("id", F.col("label").cast("int").alias("label"))
    labelled = docs.select("id").join(known, "id")
    prior = labelled.agg(F.avg("label")).first()[0]
    drawn = materialize(smallest(labelled, "label", config.rows, "id"), "drawn")
    whole = docs.join(drawn.select("id").distinct(), "id").groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("at"), F.coalesce("text", F.lit("")).alias("text"))).alias("one"))
    rows = whole.select("id", "one.text").join(drawn, "id")

    @pandas_udf("binary")
    def numbers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([indicators(t, config).astype(np.uint32).tobytes() for t in batch], dtype=object)

    got = rows.repartition(F.xxhash64("id", "text")).select("id", F.xxhash64("id", "text").alias("at"), "label", numbers("text").alias("n")).toPandas()
    got = got.sort_values(["at", "id", "label"], kind="stable")
    return QualityModel.build([np.frombuffer(n, np.uint32).astype(np.int64) for n in got["n"]], got["label"].to_numpy(), prior if prior is not None else 0.5, config)


def held_out(key: Column) -> Column:
    """A fifth of the ids, never learned from."""
    return number(key) % 5 == 0


def score_quality(
    docs: DataFrame, labels: DataFrame, held_out: Column | None = None, *, text: str = "text", key: str = "doc_id", label: str = "quality", config: QualityConfig = QualityConfig()
) -> DataFrame:
    """``docs`` with ``score``, from 0 to 1 and higher where label 1 is likelier, and ``predicted``.

    Learned from the rows of ``docs`` whose key ``labels`` has, but for those where ``held_out`` is true. The score
    depends on the text alone; a null text counts as empty and gets a score like any other. If only one label is
    known, or none, every text gets the same score. A key that is repeated in ``labels`` counts once for each label.
    Input columns named as an output are replaced.
    """
    ship(docs.sparkSession)
    learn = docs if held_out is None else docs.where(~F.coalesce(held_out, F.lit(False)))
    learn = learn.select(F.col(key).cast("string").alias("id"), F.col(text).cast("string").alias("text"))
    known = labels.select(F.col(key).cast("string").alias("id"), F.col(label).alias("label")).distinct()
    model = fit(learn, known, config)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shared.value.score(t) for t in batch], dtype=float)

    found = carried(docs, F.col(text).cast("string").alias("_text")).withColumn("_score", scored("_text"))
    at_least = (F.col("_score") >= config.threshold).cast("int")
    return uncarried(found, docs.columns, F.col("_score").alias("score"), at_least.alias("predicted"), added=["score", "predicted"])
