"""Documents linked by the Jaccard similarity of their word shingles, and the groups that the links make.

An inverted index over the rarest shingles of each set (its prefix) yields candidates, rarest by exact counts. These are
counted in bands of the hash range: a set with enough shingles that no other set has can link with nothing and takes no
part in later bands. Set relations spare most of the rest: equal sets are one node; in rounds, every set first meets only
one of the sets that lead its lists, and where they link, one answer stands for the other; lists whose sets are all
connected by then are skipped. What is left of a list is cut into blocks by size and position, and whole blocks that
cannot meet are skipped. The overlap of two sets is then derived from that of the sets they were found to be similar to,
by how much each differs from it; only pairs that these bounds leave open are counted in full.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from vigiltx.llm.common import CHUNK, WORD, components, let_through, parts, shingles, ship, sieve, sieved, without
from vigiltx.sources.shared import materialize

BLOCK = 256
#: Pairs whose sets a task holds at a time.
PAIRS = 250


@dataclass(frozen=True)
class JaccardRule:
    """Sets of shingles of ``words`` words link when 100 * intersection >= ``percent`` * union."""

    words: int = 5
    percent: int = 80

    def short(self, n: Column, own: Column) -> Column:
        """Whether ``own`` shingles are fewer than the prefix of a set of ``n`` has."""
        return own < n - F.ceil(F.lit(self.percent) * n / F.lit(100)) + 1

    def edges(self) -> list[int]:
        """Where the bands of 64-bit hashes end: half as much again as a prefix takes, more, and all."""
        first = min(1.0, 1.5 * (100 - self.percent) / 100 + 0.01)
        shares = [first] + ([2.5 * first] if first < 0.3 else [])
        return [int(share * 2**64) for share in shares if share < 0.9] + [2**64]

    def needed(self, a: Column, b: Column) -> Column:
        """The least overlap of linked sets of these sizes."""
        return F.ceil(F.lit(self.percent) * (a + b) / F.lit(100 + self.percent))

    def fits(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def reach(self, a: Column, at: Column, b: Column, bt: Column) -> Column:
        """Whether sets whose first common shingle is at these positions can link."""
        return 1 + F.least(a - at - 1, b - bt - 1) >= self.needed(a, b)


def _node(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def _counts(own: np.ndarray) -> bytes:
    """How many shingles of a set fall to each value of their low bits; more bits for larger sets."""
    n = 64 if len(own) < 512 else 256 if len(own) < 8192 else 1024
    counts = np.bincount((own & WORD(n - 1)).astype(np.int64), minlength=n)
    size = 1 if counts.max(initial=0) < 1 << 8 else 2 if counts.max() < 1 << 16 else 4
    return bytes([size]) + counts.astype(f"u{size}").tobytes()


def _most(one: bytes, two: bytes) -> int:
    """A bound on the overlap of two sets from their counts."""
    a, b = (np.frombuffer(x[1:], f"u{x[0]}").astype(np.int64) for x in (one, two))
    n = min(len(a), len(b))
    return int(np.minimum(a.reshape(-1, n).sum(axis=0), b.reshape(-1, n).sum(axis=0)).sum())


def _places(own: np.ndarray, edges: list[int]) -> list[int]:
    """How many of a sorted set of hashes lie below each edge."""
    return [int(np.searchsorted(own, WORD(e))) if e < 1 << 64 else len(own) for e in edges]


def _scan(docs: DataFrame, kind: str, rule: JaccardRule) -> DataFrame:
    """A row (id, n, node, counts, cuts) for each document; ``cuts``: how many of its shingles lie below each edge."""
    words, edges = rule.words, rule.edges()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(a, 500) for whole in batches for a in range(0, whole.num_rows, 500)):
            sets = [shingles(text.as_py(), words) for text in batch.column("text")]
            cuts = pa.array([_places(own, edges) for own in sets], pa.list_(pa.int64()))
            columns = [batch.column("id"), pa.array(map(len, sets), pa.int64()), pa.array(map(_node, sets), pa.int64()), pa.array(map(_counts, sets), pa.binary()), cuts]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "node", "counts", "cuts"])

    return materialize(docs.mapInArrow(read, f"id {kind}, n long, node long, counts binary, cuts array<long>"), "scan")


def _band(texts: DataFrame, rule: JaccardRule, low: int, high: int) -> DataFrame:
    """(token, node, n) of the shingles between two edges of the hash range; a task gives equal sets once.

    ``texts`` has one column, ``text``: texts, or packed ones.
    """
    words, packed = rule.words, texts.schema["text"].dataType.simpleString() == "binary"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in parts(batches, limit=CHUNK // 4 if packed else CHUNK):
            seen = seen if len(seen) < 1 << 16 else set()
            tokens, nodes, sizes = [], [], []
            for text in batch["text"]:
                own = shingles(zlib.decompress(text) if packed else text, words)
                if not len(own) or (node := _node(own)) in seen:
                    continue
                seen.add(node)
                first, last = _places(own, [low, high])
                tokens.append(own[first:last].view(np.int64))
                nodes.append(node)
                sizes.append(len(own))
            if tokens:
                n = [len(t) for t in tokens]
                yield pd.DataFrame({"token": np.concatenate(tokens), "node": np.repeat(np.array(nodes, np.int64), n), "n": np.repeat(np.array(sizes, np.int32), n)})

    return texts.mapInPandas(read, "token long, node long, n int")


def _met(rows: DataFrame) -> DataFrame:
    """The rows (token, node, n) of shingles that several sets have, with ``times``: how many."""
    token = Window.partitionBy("token")
    rows = rows.withColumn("before", F.lag("node").over(token.orderBy("node"))).where("before is null or before <> node")
    return rows.withColumn("times", F.count("*").over(token)).where("times > 1").drop("before")


@dataclass(frozen=True)
class _Corpus:
    """The sets that may link: ``nodes`` (node, n, counts) and ``texts`` (node, packed), a text of each."""

    texts: DataFrame
    nodes: DataFrame
    rule: JaccardRule

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose overlap the counts of their sets do not rule out, with the sizes an and bn."""

        @pandas_udf("long")
        def most(one: pd.Series, two: pd.Series) -> pd.Series:
            return pd.Series([_most(a, b) for a, b in zip(one, two, strict=True)], dtype=np.int64)

        for side in "ab":
            pairs = pairs.join(self.nodes.select(F.col("node").alias(side), F.col("n").alias(f"{side}n"), F.col("counts").alias(f"{side}c")), side)
        return pairs.where(most("ac", "bc") >= self.rule.needed(F.col("an"), F.col("bn"))).drop("ac", "bc")

    def overlaps(self, pairs: DataFrame) -> DataFrame:
        """(a, b, overlap) of distinct pairs of nodes, counted on whole sets."""
        words = self.rule.words

        def overlap_of(one: pd.Series, two: pd.Series) -> list[int]:
            sets = {x: shingles(zlib.decompress(x), words) for x in {*one, *two}}
            return [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(one, two, strict=True)]

        @pandas_udf("long")
        def overlap(one: pd.Series, two: pd.Series) -> pd.Series:
            # A few pairs at a time, so that only their sets are in memory.
            return pd.Series([n for a in range(0, len(one), PAIRS) for n in overlap_of(one[a : a + PAIRS], two[a : a + PAIRS])], dtype=np.int64)

        met = materialize(pairs.select("a", "b").distinct(), "pairs")
        for side in "ab":
            met = met.join(self.texts.select(F.col("node").alias(side), F.col("packed").alias(f"{side}t")), side)
        return materialize(met.select("a", "b", overlap("at", "bt").alias("overlap")), "overlaps")


def _texts_of(wanted: DataFrame, nodes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(node, packed): one text of each wanted node; only texts that a sieve takes for wanted are shuffled."""
    asked = materialize(wanted.select("node").join(nodes.select("node", "first"), "node"), "wanted")
    bits = texts.sparkSession.sparkContext.broadcast(sieve(asked, F.xxhash64("first")))
    kind = texts.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # In one pass, so that a task needs one worker; a few texts at a time.
        for batch in batches:
            batch = batch.filter(pa.array(sieved(batch.column("hash").to_numpy(), bits.value)))
            for part in (batch.slice(a, 500) for a in range(0, batch.num_rows, 500)):
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in part.column("text").to_pylist()]
                nodes = pa.array([_node(shingles(t, words)) for t in raw], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), nodes, pa.array([zlib.compress(t, 1) for t in raw], pa.binary())], ["id", "node", "packed"])

    rows = texts.where("id is not null").select("id", "text", F.xxhash64("id").alias("hash"))
    rows = rows.mapInArrow(read, f"id {kind}, node long, packed binary")
    # A node has one first id. Joined by both and taken once by both, texts are shuffled once.
    found = rows.join(asked.withColumnRenamed("first", "id"), ["node", "id"])
    return materialize(found.dropDuplicates(["node", "id"]).select("node", "packed"), "texts")


def _prefixes(texts: DataFrame, nodes: DataFrame, rule: JaccardRule) -> tuple[DataFrame, _Corpus]:
    """(token, node, n, pos): the shingles of each set's prefix that other sets have, and their places in it; and the
    sets that may link.

    Shingles are in order of how many sets had them when their band was counted. That is a function of the shingle, and
    a set left out of a count holds a whole prefix of shingles no other set has, so it links with nothing. Some of
    those sets may be counted all the same: their texts are held back by a sieve, not by a join, which would shuffle
    the texts. ``active`` has the sets that may link and how many of their shingles so far are ``common``.
    """
    low, rows, active, found = 0, None, None, None
    for k, high in enumerate(rule.edges()):
        source = texts.select("text") if found is None else found.select(F.col("packed").alias("text"))
        met = materialize(_met(_band(source, rule, low, high)), "met")
        rows = met if rows is None else rows.union(met)
        sets = nodes.select("node", "n", "cuts", F.lit(0).alias("common")) if active is None else nodes.select("node", "n", "cuts").join(active, "node")
        sets = sets.join(met.groupBy("node").agg(F.count("*").alias("more")), "node", "left")
        sets = sets.withColumn("common", F.col("common") + F.coalesce("more", F.lit(0)))
        active = materialize(sets.where(rule.short(F.col("n"), F.col("cuts")[k] - F.col("common"))).select("node", "common"), "active")
        found = _texts_of(active, nodes, texts, rule.words) if found is None else let_through(found, active, "node", F.col("node")).where("_met").drop("_met")
        low = high
    whole = Window.partitionBy("node")
    pos = F.col("n") - F.count("*").over(whole) + F.row_number().over(whole.orderBy("times", "token")) - 1
    rows = rows.join(active, "node", "left_semi").withColumn("pos", pos.cast("int"))
    counts = nodes.join(active, "node", "left_semi").select("node", "n", "counts")
    corpus = _Corpus(materialize(found, "texts"), materialize(counts, "counts"), rule)
    return rows.where(rule.short(F.col("n"), F.col("pos"))).select("token", "node", "n", "pos"), corpus


def _mixed(lists: DataFrame, joined: DataFrame | None) -> DataFrame:
    """The rows of lists that hold several components, with ``c``, the component."""
    rows = lists.withColumn("c", F.col("node"))
    if joined is not None:
        rows = lists.join(joined.withColumnRenamed("component", "_c"), "node", "left").withColumn("c", F.coalesce("_c", "node")).drop("_c")
    several = rows.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("token")
    return rows.join(several, "token", "left_semi")


def _leaders(lists: DataFrame, joined: DataFrame | None, tried: DataFrame | None, rule: JaccardRule) -> DataFrame:
    """For each set one that it can link with, of another component and not tried: the one it shares most lists with,
    among the sets that come first in the prefix order of their size class in each list.

    Such a set has the fewest shingles of its own, so it is near the middle of a group of near copies.
    """
    rows = _mixed(lists, joined)
    heads = rows.groupBy("token", "class").agg(F.min(F.struct("pos", "n", "node", "c")).alias("lead"))
    ok = (F.col("c") != F.col("lead.c")) & rule.fits(F.col("n"), F.col("lead.n")) & rule.reach(F.col("n"), F.col("pos"), F.col("lead.n"), F.col("lead.pos"))
    shared = rows.join(heads, ["token", "class"]).where(ok).groupBy("node", F.col("lead.node").alias("leader")).agg(F.count("*").alias("times"))
    if tried is not None:
        shared = shared.join(tried.select(F.col("a").alias("node"), F.col("b").alias("leader")), ["node", "leader"], "left_anti")
    best = shared.groupBy("node").agg(F.min(F.struct((-F.col("times")).alias("times"), "leader")).alias("best"))
    return best.select(F.col("node").alias("a"), F.col("best.leader").alias("b"))


def _led(lists: DataFrame, corpus: _Corpus) -> DataFrame:
    """(a, b, an, bn, overlap) of linked sets, found by rounds in which each set meets one leader at most.

    A round whose links are less than a quarter of its pairs is the last one; what it leaves is compared in blocks.
    """
    rule, found, tried, joined = corpus.rule, None, None, None
    while True:
        asked = materialize(_leaders(lists, joined, tried, rule), "asked")
        if found is not None and asked.isEmpty():
            return found
        near = materialize(corpus.possible(asked), "near")
        near = near.join(corpus.overlaps(near), ["a", "b"]).where(F.col("overlap") >= rule.needed(F.col("an"), F.col("bn")))
        near = materialize(near, "near")
        found = near if found is None else found.unionByName(near)
        if near.count() * 4 <= asked.count():
            return found
        tried = asked if tried is None else tried.union(asked)
        joined = components(found.select("a", "b"))


def _remaining(lists: DataFrame, joined: DataFrame, rule: JaccardRule) -> DataFrame:
    """Pairs of sets of different components that share a list and can link by size and position."""
    rows, token = _mixed(lists, joined), Window.partitionBy("token")
    block = ((F.row_number().over(token.orderBy("n", "pos", "node")) - 1) / BLOCK).cast("long")
    rows = materialize(rows.select("token", "node", "n", "pos", "c", block.alias("block")), "remaining")
    bounds = rows.groupBy("token", "block").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("rest"), F.min("c").alias("low"), F.max("c").alias("high")
    )
    one, two = bounds.alias("one"), bounds.alias("two")
    # Blocks are in order of size: the first one's largest must reach the second one's least, and their rests the overlap.
    meet = (
        (F.col("one.token") == F.col("two.token")) & (F.col("one.block") <= F.col("two.block"))
        & (F.col("one.most") * 100 >= F.col("two.least") * rule.percent)
        & (F.least("one.rest", "two.rest") >= rule.needed(F.col("one.least"), F.col("two.least")))
        & (F.least("one.low", "two.low") != F.greatest("one.high", "two.high"))
    )
    met = one.join(two, meet).select(F.col("one.token").alias("token"), F.col("one.block").alias("block"), F.col("two.block").alias("other"))
    first = rows.select("token", "block", F.col("node").alias("a"), F.col("n").alias("an"), F.col("pos").alias("ap"), F.col("c").alias("ac"))
    second = rows.select("token", F.col("block").alias("other"), F.col("node").alias("b"), F.col("n").alias("bn"), F.col("pos").alias("bp"), F.col("c").alias("bc"))
    pairs = met.join(first, ["token", "block"]).join(second, ["token", "other"]).where(
        (F.col("ac") != F.col("bc")) & ((F.col("block") != F.col("other")) | (F.col("a") < F.col("b")))
        & rule.fits(F.col("an"), F.col("bn")) & rule.reach(F.col("an"), F.col("ap"), F.col("bn"), F.col("bp"))
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _derived(pairs: DataFrame, anchors: DataFrame, corpus: _Corpus) -> DataFrame:
    """The links among ``pairs`` (a, an, b, bn); ``anchors``: (node, anchor, lost, more) of sets found similar to another.

    A set differs from its anchor by ``lost`` shingles that only it has and ``more`` that only the anchor has.
    """

    def of(side: str) -> DataFrame:
        return anchors.select(F.col("node").alias(side), *(F.col(x).alias(f"{side}_{x}") for x in ("anchor", "lost", "more")))

    known = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    for side in "ab":
        known = known.withColumn(f"{side}_anchor", F.coalesce(f"{side}_anchor", side)).na.fill(0, [f"{side}_lost", f"{side}_more"])
    known = known.withColumn("x", F.least("a_anchor", "b_anchor")).withColumn("y", F.greatest("a_anchor", "b_anchor"))
    known = materialize(known.select("a", "b", "an", "bn", "x", "y", (F.col("a_lost") + F.col("b_lost")).alias("lost"), (F.col("a_more") + F.col("b_more")).alias("more")), "derived")
    counted = corpus.overlaps(known.select(F.col("x").alias("a"), F.col("y").alias("b")))
    known = known.join(counted.select(F.col("a").alias("x"), F.col("b").alias("y"), "overlap"), ["x", "y"])
    least, most, needed = F.col("overlap") - F.col("more"), F.col("overlap") + F.col("lost"), corpus.rule.needed(F.col("an"), F.col("bn"))
    known = materialize(known.select("a", "b", "an", "bn", F.when(least >= needed, True).when(most < needed, False).alias("linked")), "derived")
    open_ = known.where("linked is null")
    full = corpus.overlaps(open_).join(open_.select("a", "b", "an", "bn"), ["a", "b"]).where(F.col("overlap") >= needed)
    return known.where("linked").select("a", "b").union(full.select("a", "b"))


def similar_groups(docs: DataFrame, rule: JaccardRule = JaccardRule(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): for each row of ``docs``, the size of its set and the least id it is linked to.

    Words are cut at space and \\x09-\\x0D after A-Z became lower case. A text of fewer words than a shingle is one
    shingle; a null or wordless text has no shingle, is linked with nothing and stands alone. Links are exact and
    complete: no list is cut, and a pair is only passed over if it cannot link or is connected already. Copies are one
    node however many they are. Rows that repeat an id stay rows of their own. A null id is never the least of
    a group with other ids, and a set that only rows without an id hold links with nothing. Sets are known by 64-bit hashes of their 64-bit shingle hashes.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    rows = _scan(texts, kind, rule)
    nodes = rows.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.min("id").alias("first"), F.first("counts").alias("counts"), F.first("cuts").alias("cuts"))
    nodes = materialize(nodes, "nodes")

    size = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / rule.percent) + 1e-9) if rule.percent < 100 else F.col("n").cast("long")
    lists, corpus = _prefixes(texts, nodes, rule)
    lists = materialize(lists.withColumn("class", size), "lists")
    near = _led(lists, corpus)
    joined = components(near.select("a", "b"))
    lost, more = F.col("an") - F.col("overlap"), F.col("bn") - F.col("overlap")
    anchors = near.groupBy(F.col("a").alias("node")).agg(F.min(F.struct((lost + more).alias("far"), F.col("b").alias("anchor"), lost.alias("lost"), more.alias("more"))).alias("_"))
    anchors = anchors.select("node", "_.anchor", "_.lost", "_.more")
    pairs = materialize(corpus.possible(_remaining(lists, joined, rule)), "possible")
    links = joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(_derived(pairs, anchors, corpus))
    joined = components(links)

    first = nodes.select("node", "first")
    member = joined.join(first, "node")
    group = member.groupBy("component").agg(F.min("first").alias("least"))
    least = member.join(group, "component").select("node", "least")
    least = materialize(first.join(least, "node", "left").select("node", F.coalesce("least", "first").alias("least")), "groups")
    some = rows.where("n > 0").join(least, "node").select("id", "n", "least")
    return some.union(rows.where("n = 0").select("id", "n", F.col("id").alias("least"))).select("id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, rule: JaccardRule = JaccardRule(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that belong to a group but are not its least id; rows of a null id stay.

    Only rows that a fixed-size sieve takes for dropped ones are joined; the rest is passed on as read.
    """
    groups = similar_groups(docs, rule, key=key, text=text)
    dropped = groups.where(F.col("component_id") != F.col("id")).select(F.col("id").alias("_id")).distinct()
    return without(docs, materialize(dropped, "dropped"), key, "_id")
