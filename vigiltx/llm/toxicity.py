"""Toxicity: a Kneser-Ney model of toxic and one of ordinary text, compared by length-normalised likelihoods.

Both classes have trigram and bigram models of their own over characters folded into 256 symbols; below them they share
one unigram model of continuation counts over all labelled text. The log-likelihood ratio of a text is taken per symbol
and per expression (a word with the separator after it), so that a few toxic expressions show in a long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from vigiltx.llm.common import CHUNK, carried, let_through, number, ship, smallest, uncarried
from vigiltx.sources.shared import materialize

#: Symbols a character folds into; a model has at most SYMBOLS ** 3 ratios, whatever the corpus.
SYMBOLS = 256
#: Symbol before, between and after texts.
BORDER = 0


@dataclass(frozen=True)
class ToxicityConfig:
    """``rows`` labelled texts of each label at most calibrate the score; the models count all labelled texts.

    ``steps``: how far an expression's log-likelihood ratio must lie above 0 to count; the shares of expressions above
    each step are what the calibration sees beside the mean ratios.
    """

    rows: int = 4000
    steps: tuple[float, ...] = (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0)
    threshold: float = 0.5


def folded(text: str | None) -> np.ndarray:
    """The symbols of a text in lower case: code points below 256 as they are, others folded into the upper half."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(raw < SYMBOLS, np.maximum(raw, 1), 128 + raw % 127).astype(np.uint8)


def pieces(text: str | None, limit: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(history, symbols) of a text, the end included: two symbols of history, then ``limit`` symbols or so.

    A piece ends after a separator, so that expressions stay whole; one longer than ``limit`` counts as several.
    """
    symbols = np.append(folded(text), np.uint8(BORDER))
    history, at = np.zeros(2, np.uint8), 0
    while at < len(symbols):
        end = min(at + limit, len(symbols))
        if end < len(symbols):
            gaps = np.flatnonzero(symbols[at:end] <= 32)
            end = at + int(gaps[-1]) + 1 if len(gaps) else end
        yield history, symbols[at:end]
        history, at = np.concatenate([history, symbols[at:end]])[-2:], end


def trigrams(history: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The number of the trigram that ends at each symbol."""
    whole = np.concatenate([history, symbols]).astype(np.int32)
    return (whole[:-2] << 16) | (whole[1:-1] << 8) | whole[2:]


def discount(counts: np.ndarray) -> float:
    """What Kneser-Ney takes from each seen event, from the numbers of events seen once and twice."""
    once, twice = float((counts == 1).sum()), float((counts == 2).sum())
    return min(max(once / max(once + 2 * twice, 1.0), 0.1), 0.95)


def shared_backoff(seen: list[np.ndarray]) -> np.ndarray:
    """Probability of each symbol by the number of symbols it follows in text of any class; none is 0.

    ``seen``: for each class the bigrams it has.
    """
    pairs = np.unique(np.concatenate(seen)) if seen else np.empty(0, np.int64)
    follows = np.bincount(pairs & 255, minlength=SYMBOLS).astype(float)
    d, total = discount(follows), follows.sum()
    if not total:
        return np.full(SYMBOLS, 1.0 / SYMBOLS)
    return (np.maximum(follows - d, 0) + d * np.count_nonzero(follows) / SYMBOLS) / total


def _layer(counts: np.ndarray, context: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of seen events their discounted share, and of every context the weight of what lies below it."""
    d = discount(counts)
    total = np.bincount(context, counts, size)
    types = np.bincount(context, counts > 0, size)
    left = np.where(total > 0, d * types / np.maximum(total, 1), 1.0)
    return np.maximum(counts - d, 0) / total[context], left


@dataclass(frozen=True)
class ClassModel:
    """One class: ``low`` is its bigram model whole, ``share`` what its trigrams ``grams`` add to ``left`` times that."""

    low: np.ndarray
    grams: np.ndarray
    share: np.ndarray
    left: np.ndarray

    @classmethod
    def build(cls, grams: np.ndarray, counts: np.ndarray, base: np.ndarray) -> ClassModel:
        pairs, found = np.unique(grams & 0xFFFF, return_inverse=True)
        follows = np.bincount(found, minlength=len(pairs)).astype(float)  # symbols each pair is seen after
        share, left = _layer(follows, pairs >> 8, SYMBOLS)
        low = left[:, None] * base[None, :]
        low[pairs >> 8, pairs & 255] += share
        share, left = _layer(counts.astype(float), grams >> 8, SYMBOLS * SYMBOLS)
        return cls(low.ravel(), grams, share, left)

    def probability(self, grams: np.ndarray) -> np.ndarray:
        """P(third | first, second) of each trigram."""
        out = self.left[grams >> 8] * self.low[grams & 0xFFFF]
        mine = np.isin(grams, self.grams)
        out[mine] += self.share[np.searchsorted(self.grams, grams[mine])]
        return out


@dataclass(frozen=True)
class RatioModel:
    """Log-likelihood ratios of toxic to ordinary: ``two`` of every bigram, ``value`` of the trigrams ``grams``; any other
    trigram has that of its bigram plus ``context`` of its first two symbols."""

    two: np.ndarray
    context: np.ndarray
    grams: np.ndarray
    value: np.ndarray

    @classmethod
    def build(cls, counts: pd.DataFrame) -> RatioModel:
        """From rows (gram, toxic, n), one for each trigram and class."""
        counts = counts.sort_values("gram")
        both = [counts[counts["toxic"] == c] for c in (0, 1)]
        grams = [b["gram"].to_numpy(np.int64) for b in both]
        base = shared_backoff([np.unique(g & 0xFFFF) for g in grams])
        ordinary, toxic = (ClassModel.build(g, b["n"].to_numpy(), base) for g, b in zip(grams, both, strict=True))
        seen = np.union1d(*grams)
        value = np.log(toxic.probability(seen) / ordinary.probability(seen))
        two, context = np.log(toxic.low / ordinary.low), np.log(toxic.left / ordinary.left)
        return cls(two.astype(np.float32), context.astype(np.float32), seen, value.astype(np.float32))

    @cached_property
    def three(self) -> np.ndarray:
        """The ratio of every trigram, by its number."""
        table = (self.context[:, None] + np.tile(self.two.reshape(SYMBOLS, SYMBOLS), (SYMBOLS, 1))).ravel()
        table[self.grams] = self.value
        return table

    def features(self, text: str | None, steps: tuple[float, ...]) -> np.ndarray:
        """Of the trigram and of the bigram ratios: their mean, and the root of the share of expressions above each step.

        Last, one over the root of the number of expressions.
        """
        size, words = 0, 0
        total, above = np.zeros(2), np.zeros((2, len(steps)))
        for history, symbols in pieces(text):
            grams = trigrams(history, symbols)
            gap = symbols <= 32
            starts = np.flatnonzero(np.append(True, gap[:-1]))
            starts_in = starts[~gap[starts]]
            size, words = size + len(symbols), words + len(starts_in)
            for i, ratio in enumerate((self.three[grams], self.two[grams & 0xFFFF])):
                total[i] += ratio.sum(dtype=float)
                if len(starts_in):
                    sums = np.add.reduceat(ratio, starts, dtype=float)[~gap[starts]]
                    above[i] += [(sums > s).sum() for s in steps]
        out = np.concatenate([(total / max(size, 1))[:, None], np.sqrt(above / max(words, 1))], axis=1)
        return np.append(out.ravel(), 1 / np.sqrt(max(words, 1)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, weights with the offset last) of a weighted, lightly regularised logistic regression."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.append((x - mean) / scale, np.ones((len(x), 1)), axis=1)
    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + 1e-2 * w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w)), gradient)
        w -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


@dataclass(frozen=True)
class ToxicityModel:
    ratios: RatioModel
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    config: ToxicityConfig

    def score(self, text: str | None) -> float:
        x = (self.ratios.features(text, self.config.steps) - self.mean) / self.scale
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30))))


def count_trigrams(rows: DataFrame) -> DataFrame:
    """(gram, label, half, n) over every text of ``rows`` (text, label, half); each task adds up its own first."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], list] = {}
        sums: dict[tuple[int, int], pd.Series] = {}

        def settle(kind: tuple[int, int]) -> None:
            grams, n = np.unique(np.concatenate(held.pop(kind)), return_counts=True)
            sums[kind] = pd.Series(n, index=grams).add(sums[kind], fill_value=0) if kind in sums else pd.Series(n, index=grams)

        size: dict[tuple[int, int], int] = {}
        for batch in batches:
            for text, label, half in zip(batch["text"], batch["label"], batch["half"], strict=True):
                kind = (int(label), int(half))
                for history, symbols in pieces(text):
                    held.setdefault(kind, []).append(trigrams(history, symbols))
                    size[kind] = size.get(kind, 0) + len(symbols)
                    if size[kind] > 4 * CHUNK:
                        settle(kind)
                        size[kind] = 0
        for kind in list(held):
            settle(kind)
        for (label, half), n in sums.items():
            yield pd.DataFrame({"gram": n.index.astype("int32"), "label": label, "half": half, "n": n.to_numpy(np.int64)})

    counts = rows.mapInPandas(counted, "gram int, label int, half int, n long")
    return counts.groupBy("gram", "label", "half").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, known: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    """A model of ``docs`` (id, text) and ``known`` (id, label).

    Trigrams are counted over all texts whose id is known; at most ``SYMBOLS ** 3`` of them for each class and half come
    to the driver. The calibration reads a bounded sample, each text by the counts of the other half of the ids.
    """
    known = known.where("label in (0, 1)").select("id", F.col("label").cast("int").alias("label"))
    known = materialize(known.where("id is not null").distinct(), "labels")
    half = F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("half")
    rows = let_through(docs, known, "id", F.col("id")).where("_met").select("id", "text")
    rows = materialize(rows.join(known, "id").select("id", F.coalesce("text", F.lit("")).alias("text"), "label", half), "labelled")
    counts = count_trigrams(rows).toPandas()

    def ratios(part: pd.DataFrame) -> RatioModel:
        summed = part.groupby(["gram", "label"], as_index=False)["n"].sum()
        return RatioModel.build(summed.rename(columns={"label": "toxic"}))

    whole = ratios(counts)
    shown = counts.groupby("half")["label"].nunique()
    width = 2 * len(config.steps) + 3
    flat = np.zeros(width), np.ones(width), np.zeros(width + 1)
    if len(shown) < 2 or shown.min() < 2:  # too little to calibrate on: even odds, but for a single label
        labels = counts["label"].unique()
        flat[2][-1] = 0.0 if len(labels) != 1 else (4.6 if labels[0] else -4.6)
        return ToxicityModel(whole, *flat, config)
    other = rows.sparkSession.sparkContext.broadcast([ratios(counts[counts["half"] != h]) for h in (0, 1)])
    steps = config.steps

    @pandas_udf("array<double>")
    def described(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, halves in batches:
            yield pd.Series([other.value[h].features(t, steps) for t, h in zip(texts, halves, strict=True)], dtype=object)

    drawn = materialize(smallest(rows.select("id", "label"), "label", config.rows, "id"), "drawn")
    sample = rows.join(drawn.distinct(), ["id", "label"]).select("id", "label", F.xxhash64("text").alias("at"), described("text", "half").alias("x"))
    got = sample.toPandas().sort_values(["at", "id", "label"], kind="stable")
    share = rows.agg(F.avg("label")).first()[0]
    y = got["label"].to_numpy(float)
    if len(set(y)) < 2:
        return ToxicityModel(whole, *flat, config)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return ToxicityModel(whole, *logistic(np.array(got["x"].tolist()), y, weight), config)


def held_out(key: Column) -> Column:
    """A fifth of the ids, never learned from."""
    return number(key) % 5 == 0


def score_toxicity(
    docs: DataFrame, labels: DataFrame, held_out: Column | None = None, *, text: str = "text", key: str = "doc_id", label: str = "toxic", config: ToxicityConfig = ToxicityConfig()
) -> DataFrame:
    """``docs`` with ``score``, from 0 to 1 and higher where label 1 is likelier, and ``predicted``.

    Learned from the rows of ``docs`` whose key ``labels`` has, but for those where ``held_out`` is true. The score depends
    on the text alone; a null text counts as empty, and an empty one gets the score of a text without expressions. Texts
    are read whole. Labels other than 0 and 1 and null keys are passed over; a key that is repeated in ``docs`` counts as
    often as it is there, one that is repeated in ``labels`` once for each label. Where one label alone is known, or none,
    every text gets the same score. Input columns named as an output are replaced.
    """
    ship(docs.sparkSession)
    learn = docs if held_out is None else docs.where(~F.coalesce(held_out, F.lit(False)))
    learn = learn.select(F.col(key).cast("string").alias("id"), F.col(text).cast("string").alias("text"))
    known = labels.select(F.col(key).cast("string").alias("id"), F.col(label).alias("label"))
    model = fit(learn, known, config)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shared.value.score(t) for t in batch], dtype=float)

    found = carried(docs, F.col(text).cast("string").alias("_text")).withColumn("_score", scored("_text"))
    at_least = (F.col("_score") >= config.threshold).cast("int")
    return uncarried(found, docs.columns, F.col("_score").alias("score"), at_least.alias("predicted"), added=["score", "predicted"])
