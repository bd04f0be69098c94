"""Approximate nearest neighbours: NN-descent grows a neighbour graph by joins, greedy search walks it.

Vectors are turned so that the largest inner product is the smallest angle (one more component makes all lengths equal)
and are rounded to bytes, each by its own scale, for building and walking the graph; results are scored on the vectors as
given.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from vigiltx.llm.common import ship, whole_groups
from vigiltx.llm.topk import sound
from vigiltx.sources.shared import materialize

LIST = "id long, ids array<long>, sims array<float>"


@dataclass(frozen=True)
class GraphConfig:
    """``degree`` neighbours a node, as many reverse ones in the joins; ``orders`` random orders seed the graph, each cut
    into leaves of ``leaf`` vectors; ``descents`` rounds of NN-descent; a search keeps ``beam`` nodes and opens up to
    ``open`` of them in each of ``rounds`` rounds, beginning at its own node and the ``longest`` longest vectors."""

    degree: int = 32
    orders: int = 10
    leaf: int = 1024
    descents: int = 3
    beam: int = 160
    open: int = 64
    rounds: int = 5
    longest: int = 1024
    seed: int = 5


def ranked(owner: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int, flag: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The ``most`` best distinct ids of each owner, best first; a flag set on any copy of an id stays set."""
    flag = np.zeros(len(owner), bool) if flag is None else flag
    by = np.lexsort((~flag, ids, owner))
    owner, ids, sims, flag = owner[by], ids[by], sims[by], flag[by]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])
    owner, ids, sims, flag = owner[first], ids[first], sims[first], flag[first]
    by = np.lexsort((ids, -sims, owner))
    owner, ids, sims, flag = owner[by], ids[by], sims[by], flag[by]
    start = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    place = np.arange(len(owner)) - np.maximum.accumulate(np.where(start, np.arange(len(owner)), 0)) if len(owner) else owner
    keep = place < most
    return owner[keep], ids[keep], sims[keep], flag[keep]


def listed(owner: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """Sorted flat rows as one list for each owner and column."""
    if not len(owner):
        return owner, [[] for _ in columns]
    cut = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    return owner[np.concatenate([[0], cut])], [np.split(c, cut) for c in columns]


def _flat(frame: pd.DataFrame, column: str, kind: type) -> np.ndarray:
    return np.concatenate(frame[column].to_list()).astype(kind) if len(frame) else np.empty(0, kind)


def _merged(lists: DataFrame, most: int) -> DataFrame:
    """One list of the best for each id."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, "id"):
            n = frame["ids"].map(len).to_numpy()
            owner, ids, sims, _ = ranked(np.repeat(frame["id"].to_numpy(np.int64), n), _flat(frame, "ids", np.int64), _flat(frame, "sims", np.float32), most)
            own, (ids, sims) = listed(owner, ids, sims)
            yield pd.DataFrame({"id": own, "ids": ids, "sims": sims})

    return lists.repartition("id").sortWithinPartitions("id").mapInPandas(merge, LIST)


def _best_of(ids: np.ndarray, vectors: np.ndarray, most: int, above: np.ndarray | None = None) -> pd.DataFrame:
    """Within one group, each member's ``most`` most similar other members, those above its mark only."""
    sims = _likeness(vectors)
    np.fill_diagonal(sims, -np.inf)
    if above is not None:
        sims[sims <= above[:, None]] = -np.inf
    most = min(most, len(ids) - 1)
    top = np.argpartition(-sims, most - 1, axis=1)[:, :most] if most < len(ids) - 1 else np.argsort(-sims, axis=1)[:, :most]
    value = np.take_along_axis(sims, top, 1)
    good = value > -np.inf
    some = good.any(axis=1)
    return pd.DataFrame({"id": ids[some], "ids": [ids[t[g]] for t, g in zip(top[some], good[some], strict=True)], "sims": [v[g] for v, g in zip(value[some], good[some], strict=True)]})


#: Lengths, in those of the median vector, beyond which float32 could not hold a product; only the graph is cut there.
LONG = 1e15


def _packed(values: list[np.ndarray], dim: int, middle: float, longest: float) -> list[bytes]:
    """Each vector as ``dim`` bytes and three floats: the scale of its bytes, and two parts of its added component.

    The length of the median vector, e to the ``middle``, counts as 1. For the largest length M the added component is
    a = sqrt(M M - v v) = M - d with d = v v / (M + a), kept as d and M d: a itself would be M for all vectors that are
    short beside M.
    """
    out = []
    for value in values:
        v = np.zeros(dim)
        v[: len(value)] = value
        v /= np.abs(v).max()
        own = np.sqrt(v @ v)
        length = np.exp(min(np.log(np.abs(value).max()) + np.log(own) - middle, np.log(longest)))
        d = length / (longest / length + np.sqrt(max((longest / length) ** 2 - 1.0, 0.0)))
        tail = np.array([length / own / 127.0, d, longest * d], np.float32)
        out.append(np.rint(v * 127.0).astype(np.int8).tobytes() + tail.tobytes())
    return out


def _unpacked(cells: bytes, n: int) -> np.ndarray:
    """Rows of the vector, d and M d."""
    raw = np.frombuffer(cells, np.uint8).reshape(n, -1)
    tail = np.ascontiguousarray(raw[:, -12:]).view(np.float32)
    return np.concatenate([raw[:, :-12].view(np.int8) * tail[:, :1], tail[:, 1:]], axis=1, dtype=np.float32)


def _bytes(cells: list[bytes]) -> np.ndarray:
    return _unpacked(b"".join(cells), len(cells))


def _likeness(vectors: np.ndarray) -> np.ndarray:
    """The inner products of the turned vectors, less M M."""
    turned, far = vectors[:, :-1], vectors[:, -1]
    return turned @ turned.T - (far[:, None] + far)


def _seeded(points: DataFrame, n: int, dim: int, config: GraphConfig) -> DataFrame:
    """First lists: vectors in random orders (signs of random directions, then one direction), each cut into leaves."""
    bits = max(0, math.ceil(math.log2(max(1, n) / config.leaf)))
    orders, leaf, degree, seed = config.orders, config.leaf, config.degree, config.seed

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turns = np.random.default_rng(seed).normal(size=(orders, bits + 1, dim)).astype(np.float32)
        for batch in batches:
            vectors = _bytes(batch["vec"].to_list()) if len(batch) else None
            for t in range(orders if len(batch) else 0):
                side = vectors[:, :-1] @ turns[t].T
                code = ((side[:, :bits] > 0) * (1 << np.arange(bits, dtype=np.int64))).sum(axis=1) if bits else 0
                yield pd.DataFrame({"turn": t, "code": code, "at": side[:, bits], "id": batch["id"], "vec": batch["vec"]})

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) and (len(held) >= 2 * leaf or held["turn"].iloc[0] != held["turn"].iloc[-1]):
                same = int((held["turn"] == held["turn"].iloc[0]).sum())
                cut = same if same < 2 * leaf else leaf
                part, held = held.iloc[:cut], held.iloc[cut:]
                if len(part) > 1:
                    yield _best_of(part["id"].to_numpy(np.int64), _bytes(part["vec"].to_list()), degree)
        if held is not None and len(held) > 1:
            yield _best_of(held["id"].to_numpy(np.int64), _bytes(held["vec"].to_list()), degree)

    placed = points.mapInPandas(place, "turn int, code long, at float, id long, vec binary")
    parts = max(1, n * orders // (4 * leaf))
    return placed.repartitionByRange(parts, "turn", "code", "at").sortWithinPartitions("turn", "code", "at").mapInPandas(leaves, LIST)


def _members(graph: DataFrame, degree: int) -> DataFrame:
    """(node, member): the neighbours of each node, and the ``degree`` closest of those it is a neighbour of."""
    edges = graph.select(F.col("id").alias("node"), F.inline(F.arrays_zip("ids", "sims"))).withColumnRenamed("ids", "member")
    place = F.row_number().over(Window.partitionBy("member").orderBy(F.desc("sims"), "node"))
    back = edges.withColumn("place", place).where(F.col("place") <= degree)
    return edges.select("node", "member").union(back.select(F.col("member").alias("node"), F.col("node").alias("member"))).distinct()


def _descended(graph: DataFrame, points: DataFrame, config: GraphConfig) -> DataFrame:
    """One round: the members of every node meet each other, and each keeps the best it has met."""
    degree = config.degree
    mark = F.when(F.size("sims") >= degree, F.get("sims", F.lit(degree - 1))).otherwise(F.lit(float("-inf")).cast("float"))
    known = materialize(points.join(graph.select("id", mark.alias("mark")), "id", "left").select(F.col("id").alias("member"), "vec", F.coalesce("mark", F.lit(float("-inf")).cast("float")).alias("mark")), "known")
    met = materialize(_members(graph, degree), "members").join(known, "member")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, "node"):
            vectors, ids, marks = _bytes(frame["vec"].to_list()), frame["member"].to_numpy(np.int64), frame["mark"].to_numpy(np.float32)
            node = frame["node"].to_numpy()
            cut = np.concatenate([[0], np.flatnonzero(node[1:] != node[:-1]) + 1, [len(node)]])
            owner, other, value = [], [], []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b - a < 2:
                    continue
                sims = _likeness(vectors[a:b])
                np.fill_diagonal(sims, -np.inf)
                one, two = np.nonzero(sims > marks[a:b, None])
                owner.append(ids[a:b][one])
                other.append(ids[a:b][two])
                value.append(sims[one, two])
            if any(map(len, owner)):
                # The same two meet at many nodes: within this frame one meeting is enough.
                found, ids, sims, _ = ranked(np.concatenate(owner), np.concatenate(other), np.concatenate(value), degree)
                own, (ids, sims) = listed(found, ids, sims)
                yield pd.DataFrame({"id": own, "ids": ids, "sims": sims})

    found = met.repartition("node").sortWithinPartitions("node").mapInPandas(meet, LIST)
    return materialize(_merged(graph.union(found), degree), "graph")


def _opened(most: int) -> Column:
    """The flags of a beam after its first ``most`` nodes that were not open have been opened."""
    shut = F.transform("done", lambda d, i: F.when(d, 0).otherwise(F.size(F.filter(F.slice("done", 1, i + 1), lambda x: ~x))))
    return F.zip_with("done", shut, lambda d, n: d | (n <= most))


def _walked(graph: DataFrame, points: DataFrame, asks: DataFrame, longest: pd.DataFrame, config: GraphConfig) -> DataFrame:
    """(ask, found) from greedy searches that begin at the asked vectors' own nodes and the ``longest`` (id, vec).

    No short vector has a long one among its nearest, but long ones have the large products. ``asks``: (ask, cells).
    """
    near = materialize(_members(graph, config.degree), "members").join(points.select(F.col("id").alias("member"), "vec"), "member")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, "node"):
            node = frame["node"].to_numpy()
            cut = np.concatenate([[0], np.flatnonzero(node[1:] != node[:-1]) + 1, [len(node)]])
            members, vec = frame["member"].to_numpy(np.int64), frame["vec"].to_list()
            yield pd.DataFrame({"node": node[cut[:-1]], "members": [members[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], "vecs": [b"".join(vec[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]})

    near = materialize(near.repartition("node").sortWithinPartitions("node").mapInPandas(pack, "node long, members array<long>, vecs binary"), "near")
    beam, open_ = config.beam, config.open

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for ask, cells, members, vecs in batch[["ask", "cells", "members", "vecs"]].itertuples(index=False):
                rows.append((ask, members, _unpacked(vecs, len(members))[:, :-2] @ _unpacked(cells, 1)[0, :-2]))
            yield pd.DataFrame(rows, columns=["id", "ids", "sims"])

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, "id"):
            n = frame["ids"].map(len).to_numpy()
            owner, ids, sims, done = ranked(
                np.repeat(frame["id"].to_numpy(np.int64), n), _flat(frame, "ids", np.int64), _flat(frame, "sims", np.float32), beam, _flat(frame, "done", bool)
            )
            own, (ids, sims, done) = listed(owner, ids, sims, done)
            yield pd.DataFrame({"id": own, "ids": ids, "sims": sims, "done": done})

    far_ids, far_vec = longest["id"].to_numpy(np.int64), longest["vec"].to_list()

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        far = _bytes(far_vec)[:, :-2]
        for batch in batches:
            if len(batch):
                sims = _bytes(batch["cells"].to_list())[:, :-2] @ far.T
                own = np.repeat(batch["ask"].to_numpy(np.int64), len(far_ids))
                owner, ids, sims, _ = ranked(own, np.tile(far_ids, len(batch)), sims.ravel(), beam)
                # The own node is opened first, however short.
                own = batch["ask"].to_numpy(np.int64)
                owner, ids, sims, done = ranked(
                    np.concatenate([own, owner[owner != ids]]), np.concatenate([own, ids[owner != ids]]),
                    np.concatenate([np.full(len(own), np.inf, np.float32), sims[owner != ids]]), beam,
                )
                owner, (ids, sims, done) = listed(owner, ids, sims, done)
                yield pd.DataFrame({"id": owner, "ids": ids, "sims": sims, "done": done})

    beams = materialize(asks.mapInPandas(begin, LIST + ", done array<boolean>"), "beams")
    for _ in range(config.rounds):
        todo = F.slice(F.filter(F.arrays_zip("ids", "done"), lambda x: ~x["done"]), 1, open_)
        opened = beams.select(F.col("id").alias("ask"), F.explode(todo).alias("x")).select("ask", F.col("x.ids").alias("node"))
        opened = materialize(opened.join(asks, "ask"), "opened")
        seen = opened.join(near, "node").mapInPandas(look, LIST)
        news = seen.select("id", "ids", "sims", F.transform("ids", lambda x: F.lit(False)).alias("done"))
        old = beams.select("id", "ids", "sims", _opened(open_).alias("done"))
        beams = materialize(old.union(news).repartition("id").sortWithinPartitions("id").mapInPandas(keep, LIST + ", done array<boolean>"), "beams")
    return beams.select(F.col("id").alias("ask"), F.explode("ids").alias("found"))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, *, key: str = "vec_id", vector: str = "embedding", config: GraphConfig = GraphConfig()
) -> DataFrame:
    """For each row where ``is_query``, the ``k`` nearest other rows found, by the largest inner product in double precision.

    Columns query_id, rank (from 1), vec_id, score; ties go to the smaller key. Every vector is in the graph; equal
    vectors are one node, whose rows all count in the end. Null and zero vectors and those with a null or non-finite
    component take no part, nor do null keys; shorter vectors count as filled up with zeros. Rows that repeat a key with
    the same vector count once. With ``k`` candidates or fewer all are returned; an empty table gives no rows.
    """
    ship(vectors.sparkSession)
    cells = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.where(sound(F.col(vector)) & F.exists(F.col(vector), lambda x: x != 0) & F.col(key).isNotNull())
    rows = rows.select(F.col(key).cast("long").alias("id"), cells.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    # Rows of one vector: beyond the first k + 1 keys none can be among the k nearest.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    same = rows.select("id", "v").distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    same = materialize(same.withColumn("node", F.min("id").over(Window.partitionBy("v"))), "same")
    points = same.where("place = 1").select("id", "v")
    cell = F.array_max(F.transform("v", lambda x: F.abs(x)))
    # The logarithm of the length: squares may overflow.
    length = F.log(cell) + F.log(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / cell) * (x / cell))) / 2
    most = points.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(length).alias("longest"), F.percentile_approx(length, 0.5, F.lit(1000)).alias("middle")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not most["n"]:
        return vectors.sparkSession.createDataFrame([], schema)
    dim, middle = most["dim"], most["middle"]
    longest = min(math.exp(min(most["longest"] - middle, 100.0)), LONG)

    @pandas_udf("binary")
    def node_cells(v: pd.Series) -> pd.Series:
        return pd.Series(_packed(v.tolist(), dim, middle, longest), dtype=object)

    packed = materialize(points.select("id", node_cells("v").alias("vec")), "points")
    graph = materialize(_merged(_seeded(packed, most["n"], dim + 1, config), config.degree), "graph")
    for _ in range(config.descents):
        graph = _descended(graph, packed, config)
    asking = rows.where("asks").select("id", "v").distinct().join(points.select(F.col("id").alias("node"), "v"), "v")
    asking = materialize(asking.select(F.col("id").alias("query_id"), F.col("node").alias("ask"), "v"), "asking")
    asks = materialize(asking.select("ask").distinct().join(packed.select(F.col("id").alias("ask"), F.col("vec").alias("cells")), "ask"), "asks")
    far = points.select("id", length.alias("length")).orderBy(F.desc("length"), "id").limit(config.longest)
    found = _walked(graph, packed, asks, far.join(packed, "id").select("id", "vec").toPandas(), config)

    @pandas_udf("double")
    def product(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([float(x[: len(y)] @ y[: len(x)]) for x, y in zip(a, b, strict=True)], dtype=float)

    own = asks.select("ask", F.col("ask").alias("found"))
    found = found.union(own).distinct().join(points.select(F.col("id").alias("found"), "v"), "found")
    scored = found.join(points.select(F.col("id").alias("ask"), F.col("v").alias("asked")), "ask").select("ask", "found", product("asked", "v").alias("score"))
    rows = scored.join(same.select(F.col("node").alias("found"), F.col("id").alias("vec_id")), "found").join(asking.select("query_id", "ask"), "ask").where("query_id <> vec_id")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
