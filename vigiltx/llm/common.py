"""What several operators share: carried rows, text batches, hashes, connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import BinaryType

from vigiltx.sources.shared import materialize

#: Characters that numpy works on at a time inside a task.
CHUNK = 1 << 18
WORD = np.uint64
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once for each application; they import it from there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="vigiltx-"), "vigiltx_workers.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.join("vigiltx", os.path.relpath(file, package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def carried(df: DataFrame, *columns: Column) -> DataFrame:
    """Every input row as struct ``_row`` beside ``columns``, so that no input name can clash."""
    return df.select(F.struct("*").alias("_row"), *columns)


def uncarried(df: DataFrame, fields: list[str], *columns: Column, added: list[str]) -> DataFrame:
    """The input columns again, with ``columns`` named ``added``; one of the same name is replaced."""
    kept = [F.col("_row")[f].alias(f) for f in fields if f.lower() not in {a.lower() for a in added}]
    return df.select(*kept, *columns)


def number(column: Column) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")))


def chunks(sizes: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to ``limit`` at most, or single rows."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def parts(batches: Iterator[pd.DataFrame], column: str = "text", limit: int = CHUNK) -> Iterator[pd.DataFrame]:
    """The rows in frames of ``limit`` characters or so, so that what is made of them stays small."""
    for batch in batches:
        sizes = np.fromiter((len(t) if t is not None else 0 for t in batch[column]), np.int64, len(batch))
        for a, b in chunks(sizes, limit):
            yield batch.iloc[a:b]


def whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Rows in order of ``key``, in frames that end where a group ends."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[key].iloc[-1]
        first = int((batch[key].to_numpy() == last).argmax())
        if first or (held and held[0][key].iloc[-1] != last):
            done = [*held, batch.iloc[:first]] if first else held
            yield pd.concat(done, ignore_index=True) if len(done) > 1 else done[0].reset_index(drop=True)
            held = []
        held.append(batch.iloc[first:])
    if held:
        yield pd.concat(held, ignore_index=True)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(WORD, copy=True)
    x ^= x >> WORD(30)
    x *= WORD(0xBF58476D1CE4E5B9)
    x ^= x >> WORD(27)
    x *= WORD(0x94D049BB133111EB)
    x ^= x >> WORD(31)
    return x


def hashed_words(text: str | bytes | None) -> np.ndarray:
    """64-bit hashes of the words of a text: A-Z in lower case, cut at space and \\x09-\\x0D only."""
    from pandas.util import hash_array

    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    if not words:
        return np.empty(0, WORD)
    column = np.empty(len(words), object)
    column[:] = words
    return hash_array(column, categorize=False)


def shingles(text: str | bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` words in a row; a shorter text is one shingle, an empty one none."""
    words = hashed_words(text)
    if not len(words):
        return words
    size = min(size, len(words))
    rolled = np.full(len(words) - size + 1, size, WORD)
    for k in range(size):
        rolled = mixed(rolled + words[k : len(words) - size + 1 + k])
    return np.unique(rolled)


def smallest(rows: DataFrame, by: str, limit: int, *hashed: str) -> DataFrame:
    """Of the rows of each value of ``by``, those with the ``limit`` smallest hashes of ``hashed``; equal hashes count once.

    How many hashes a value has is estimated first. Only rows below the bound under which twice ``limit`` of them are
    expected reach the shuffle, so that neither it nor the task that ranks them grows with the table.
    """
    rows = rows.withColumn("_hash", F.xxhash64(*hashed))
    known = materialize(rows.groupBy(F.col(by).alias("_by")).agg(F.approx_count_distinct("_hash").alias("_n")), "known")
    share = F.least(F.lit(1.0), F.lit(2.0 * limit + 100) / F.col("_n"))
    near = rows.join(known, F.col(by) == F.col("_by")).where(F.col("_hash").cast("double") <= share * 2.0**64 - 2.0**63)
    near = near.dropDuplicates([by, "_hash"]).drop("_by", "_n")
    rank = F.row_number().over(Window.partitionBy(by).orderBy("_hash"))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_hash", "_rank")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node it is connected with.

    Large-star and small-star rounds until nothing changes; each round is a written table. A node with very many
    edges meets its minimum in a join of two shuffled sides, which the adaptive skew join can split.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = materialize(large.where("a <> b").distinct(), "edges")
        least = materialize(edges.groupBy("a").agg(F.min("b").alias("least")), "least")
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).union(least)
        edges = materialize(small.where("a <> b").distinct(), "edges")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(edges.select("b", "b")).distinct()


#: Bits of a set of ids that is sent to every task, whatever the number of ids.
SIEVE = 1 << 24


def sieve(ids: DataFrame, hashed: Column) -> np.ndarray:
    """A bitmap of fixed size over 64-bit hashes: one that is there is always found, others now and then.

    It saves shuffling rows that are not wanted; the exact join comes after it. With very many ids it fills up and
    then saves nothing.
    """
    place = hashed.bitwiseAND(F.lit(SIEVE - 1).cast("long"))
    words = ids.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63).cast("long")).cast("int").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toPandas()
    out = np.zeros(SIEVE >> 6, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(WORD)


def sieved(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of these hashes the sieve lets through."""
    place = hashes.astype(np.int64) & (SIEVE - 1)
    return (bits[place >> 6] >> (place & 63).astype(WORD)) & WORD(1) == 1


def let_through(rows: DataFrame, ids: DataFrame, column: str, key: Column) -> DataFrame:
    """``rows`` with ``_met``: whether the sieve over ``column`` of ``ids`` lets the row's ``key`` through."""
    bits = rows.sparkSession.sparkContext.broadcast(sieve(ids, F.xxhash64(column)))

    @pandas_udf("boolean")
    def met(hashes: pd.Series) -> pd.Series:
        return pd.Series(sieved(hashes.to_numpy(np.int64), bits.value))

    return rows.withColumn("_met", met(F.xxhash64(key)))


@pandas_udf(BinaryType())
def squeezed(texts: pd.Series) -> pd.Series:
    """Texts packed for the way through a shuffle; a null text becomes the empty one."""
    return pd.Series([zlib.compress((t or "").encode("utf-8", "surrogatepass"), 1) for t in texts], dtype=object)


def without(rows: DataFrame, dropped: DataFrame, key: str, column: str) -> DataFrame:
    """``rows`` whose ``key`` is not in ``column`` of ``dropped``, a written table; rows of a null key stay.

    Only rows that the sieve takes for dropped ones are shuffled.
    """
    marked = let_through(rows.select(F.struct("*").alias("_row")), dropped, column, F.col("_row")[key])
    gone = dropped.select(F.col(column).alias("_gone")).distinct()
    rest = marked.where("_met").join(gone, F.col("_row")[key] == F.col("_gone"), "left_anti")
    return marked.where("not _met").unionByName(rest).select(*(F.col("_row")[c].alias(c) for c in rows.columns))
