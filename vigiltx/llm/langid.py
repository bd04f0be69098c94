"""Language identification: bit-sliced Bloom filters say which languages know an n-gram; counts per language decide."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from vigiltx.llm.common import CHUNK, WORD, carried, mixed, number, ship, smallest, uncarried

UNKNOWN = "und"
_letters: np.ndarray | None = None


@dataclass(frozen=True)
class LanguageConfig:
    """``rows`` labelled texts a language at most are fitted on, those with the smallest hashes of id and text.

    A language's filter holds its ``grams`` most frequent n-grams at most, of those whose share among its n-grams is
    ``ratio`` times the largest share in any language or more. The filter has ``bits`` rows, whatever the corpus.
    """

    rows: int = 2000
    sizes: tuple[int, ...] = (3, 4)
    grams: int = 40_000
    least: int = 3
    ratio: float = 0.5
    bits: int = 1 << 20
    probes: int = 2


def letters() -> np.ndarray:
    """For every code point, whether it is a letter; made once in each worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def ending(text: str, n: int) -> str:
    """The last ``n`` characters of a lower-case text as n-grams see them: letters, and one space for a run of others."""
    out: list[str] = []
    for c in reversed(text):
        c = c if c.isalpha() else " "
        if c != " " or not out or out[-1] != " ":
            out.append(c)
            if len(out) == n:
                break
    return "".join(reversed(out))


def pieces(texts: list[str], sizes: tuple[int, ...]) -> Iterator[tuple[int, str, int]]:
    """(text, piece, seen): each text in lower case between two spaces, in pieces if it is long.

    A piece begins with the ``seen`` characters before it that n-grams across the border need.
    """
    for i, text in enumerate(texts):
        whole, before = f" {text.lower()} ", ""
        for at in range(0, len(whole), CHUNK):
            piece = before + whole[at : at + CHUNK]
            yield i, piece, len(before)
            if at + CHUNK < len(whole):
                before = ending(piece, max(sizes) - 1)


def grams(texts: list[str], sizes: tuple[int, ...], seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all character n-grams of the pieces, and the piece each is in; not of those within the characters ``seen``.

    Every run of characters other than letters is one space.
    """
    known = letters()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), lengths)
    code = np.where(known[code], code, np.uint32(32))
    kept = np.ones(len(code), bool)
    kept[1:] = (code[1:] != 32) | (code[:-1] != 32) | (owner[1:] != owner[:-1])
    code, owner = code[kept].astype(WORD), owner[kept]
    place = np.arange(len(code)) - np.searchsorted(owner, np.arange(len(texts)))[owner]
    hashes, owners = [], []
    for n in sizes:
        if len(code) < n:
            continue
        rolled = np.full(len(code) - n + 1, n, WORD)
        for k in range(n):
            rolled = rolled * WORD(0x9E3779B97F4A7C15) + code[k : len(code) - n + 1 + k]
        inside = (owner[n - 1 :] == owner[: len(code) - n + 1]) & (place[n - 1 :] >= seen[owner[n - 1 :]])
        hashes.append(mixed(rolled[inside]))
        owners.append(owner[n - 1 :][inside])
    if not hashes:
        return np.empty(0, WORD), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def together(texts: list[str], sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
    """Pieces in groups of a bounded size: the text of each, the pieces, and how much of each was seen."""
    held: list[tuple[int, str, int]] = []
    total = 0
    for piece in chain(pieces(texts, sizes), [None]):
        if held and (piece is None or total + len(piece[1]) > CHUNK):
            yield np.array([i for i, _, _ in held], np.int64), [t for _, t, _ in held], np.array([n for _, _, n in held], np.int64)
            held, total = [], 0
        if piece is not None:
            held.append(piece)
            total += len(piece[1])


def rows_of(hashes: np.ndarray, bits: int, probes: int) -> Iterator[np.ndarray]:
    """The filter rows that a hash is looked up in."""
    step = (hashes >> WORD(32)) | WORD(1)
    for k in range(probes):
        yield ((hashes + WORD(k) * step) % WORD(bits)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """``table``: for each filter row, one bit for each of ``languages``; ``wrong``: each filter's false positive rate."""

    languages: tuple[str, ...]
    table: np.ndarray
    wrong: np.ndarray
    config: LanguageConfig

    @classmethod
    def build(cls, held: dict[str, np.ndarray], order: list[str], config: LanguageConfig) -> LanguageModel:
        """``held``: the hashes of each language's n-grams; ``order``: languages, the one to prefer in a tie first."""
        table = np.zeros((config.bits, max(1, -(-len(order) // 8))), np.uint8)
        wrong = np.zeros(len(order))
        for i, language in enumerate(order):
            for rows in rows_of(held[language], config.bits, config.probes):
                table[rows, i // 8] |= np.uint8(128 >> i % 8)
            wrong[i] = (np.count_nonzero(table[:, i // 8] & (128 >> i % 8)) / config.bits) ** config.probes
        return cls(tuple(order), table, wrong, config)

    def hits(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """For each of ``n`` texts and each language, how many of its n-grams the filter has."""
        mask = None
        for rows in rows_of(hashes, self.config.bits, self.config.probes):
            mask = self.table[rows] if mask is None else mask & self.table[rows]
        out = np.zeros((n, len(self.languages)))
        for i in range(len(self.languages)):
            out[:, i] = np.bincount(owner, (mask[:, i // 8] >> np.uint8(7 - i % 8)) & 1, n)
        return out

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        whole = [t or "" for t in texts]
        hits, total = np.zeros((len(whole), len(self.languages))), np.zeros(len(whole))
        for to, texts, seen in together(whole, self.config.sizes):
            hashes, owner = grams(texts, self.config.sizes, seen)
            if len(hashes) and self.languages:
                np.add.at(hits, to, self.hits(hashes, owner, len(texts)))
            np.add.at(total, to, np.bincount(owner, minlength=len(texts)))
        if not self.languages:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(whole), "score": 0.0})
        share = np.clip((hits / np.maximum(total, 1)[:, None] - self.wrong) / np.maximum(1 - self.wrong, 1e-9), 0, 1)
        best = share.argmax(axis=1)
        spoken = np.fromiter((any(map(str.isalpha, t)) for t in whole), bool, len(whole))
        names = np.array([*self.languages], object)[best]
        names[~spoken] = UNKNOWN
        return pd.DataFrame({"lang_pred": names, "score": np.where(spoken, share[np.arange(len(whole)), best], 0.0)})


def fit(spark: SparkSession, labelled: DataFrame, config: LanguageConfig = LanguageConfig()) -> LanguageModel:
    """A model of ``labelled`` (id, text, lang); rows without text or lang are passed over.

    Of a language the ``config.rows`` rows with the smallest hashes are taken, equal rows once; what reaches the
    driver is ``config.grams`` hashes a language at most.
    """
    rows = smallest(labelled.where("lang is not null and text is not null"), "lang", config.rows, "id", "text").select("text", "lang")
    sizes = config.sizes

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang", sort=True)["text"]:
                for _, cut, before in together(list(texts), sizes):
                    hashes, n = np.unique(grams(cut, sizes, before)[0], return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": hashes.view(np.int64), "n": n})

    seen = rows.repartition(F.xxhash64("text")).mapInPandas(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    seen = seen.withColumn("share", share).withColumn("most", F.max("share").over(Window.partitionBy("gram")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    own = seen.where((F.col("n") >= config.least) & (F.col("share") >= config.ratio * F.col("most")))
    own = own.withColumn("place", place).where(F.col("place") <= config.grams).select("lang", "gram", "n").toPandas()
    held = {str(lang): rows["gram"].to_numpy(np.int64).view(WORD) for lang, rows in own.groupby("lang")}
    weight = own.groupby("lang")["n"].sum().to_dict()
    return LanguageModel.build(held, sorted(held, key=lambda x: (-weight[x], x)), config)


def detector(spark: SparkSession, model: LanguageModel):
    """A column function: struct (lang_pred, score) of a text. The broadcast filter's size is fixed by the config."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("lang_pred string, score double")
    def detect(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield shared.value.predict(batch.tolist())

    return detect


def identify(docs: DataFrame, held_out: Column | None = None, *, text: str = "text", lang: str = "lang", key: str = "doc_id", config: LanguageConfig = LanguageConfig()) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the text's n-grams that this language's filter has.

    The model is fitted on the rows whose ``lang`` is known and for which ``held_out`` is not true. The prediction
    depends on the text alone. A text that is null, empty or without a letter is ``und`` with score 0, and so is every
    text if no row is labelled; in a tie the language with more n-grams counted wins, then the name. Long texts are
    read in pieces whose n-gram counts are added up, each n-gram once, those across borders too. Input columns named as an output are replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    learn = docs if held_out is None else docs.where(~F.coalesce(held_out, F.lit(False)))
    model = fit(spark, learn.select(F.col(key).cast("string").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")), config)
    detect = detector(spark, model)
    found = carried(docs, F.col(text).cast("string").alias("_text")).withColumn("_found", detect("_text"))
    return uncarried(found, docs.columns, F.col("_found.lang_pred").alias("lang_pred"), F.col("_found.score").alias("score"), added=["lang_pred", "score"])


def held_out(key: Column) -> Column:
    """A quarter of the ids, never learned from."""
    return number(key) % 4 == 2


def spoken(docs: DataFrame, least: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` in a known language: rejected are ``und`` and scores below ``least``."""
    fields = docs.columns
    found = identify(docs.select(F.struct("*").alias("_all"), *(F.col(c) for c in (options.get("text", "text"), options.get("lang", "lang"), options.get("key", "doc_id")))), **options)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*(F.col("_all")[f].alias(f) for f in fields))
