"""Exact top-k search: statistics of segments bound a score, coarse to fine, and only survivors are scored in full."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigiltx.llm.common import ship


def sound(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def levels(dim: int) -> list[int]:
    """Numbers of segments, coarse to fine."""
    out = [n for n in (1, 4, 16) if n <= dim]
    return out or [1]


def segments(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the segments over the root of their length, and the norms of what deviates from the segments' means."""
    edges = np.linspace(0, rows.shape[1], n + 1).astype(int)
    size = np.diff(edges)
    total = np.add.reduceat(rows, edges[:-1], axis=1)
    square = np.add.reduceat(rows * rows, edges[:-1], axis=1)
    return total / np.sqrt(size), np.sqrt(np.maximum(square - total * total / size, 0.0))


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, held: list[np.ndarray], k: int) -> int:
    """Put the ``k`` best of ``rows`` into ``held``, which has (score, id) rows for each query; how many rows were scored.

    The inner product of two vectors is, segment by segment, the product of the means plus that of the deviations; the
    latter is at most the product of their norms. A row whose bound is below the k-th best score is passed over; where
    squares leave the range of doubles there is no bound and the row is scored.
    """
    x, y = rows.astype(float), queries.astype(float)
    fine = [(segments(y, n), segments(x, n)) for n in levels(x.shape[1])]
    slack = 1e-9 * (np.sqrt((x * x).sum(axis=1)).max(initial=0.0) * np.sqrt((y * y).sum(axis=1)).max(initial=0.0) + 1.0)
    scored = 0
    (means, spread), (row_means, row_spread) = fine[0]
    coarse = means @ row_means.T + spread @ row_spread.T
    for q in range(len(queries)):
        own = held[q]
        least = float(own[-1, 0]) if len(own) >= k else -np.inf
        alive = np.flatnonzero(~(coarse[q] + slack < least))
        for (means, spread), (row_means, row_spread) in fine[1:]:
            if not len(alive):
                break
            bound = row_means[alive] @ means[q] + row_spread[alive] @ spread[q]
            if len(own) < k and len(alive) > k:  # nothing to compare with yet: the rows of the best bounds set the mark
                first = alive[np.argpartition(-bound, k)[: k + 1]]
                some = np.sort(rows[first[ids[first] != query_ids[q]]] @ queries[q])
                least = max(least, float(some[-k])) if len(some) >= k else least
            alive = alive[~(bound + slack < least)]
        alive = alive[ids[alive] != query_ids[q]]
        if not len(alive):
            continue
        scored += len(alive)
        found = np.column_stack([rows[alive] @ queries[q], ids[alive]])
        own = np.concatenate([own, found])
        held[q] = own[np.lexsort((own[:, 1], -own[:, 0]))][:k]
    return scored


def _packer(rows: int, kind: str):
    """Blocks of up to ``rows`` vectors of one length, ids and cells (floors) packed as bytes; blocks are dealt by
    ``at``, those of a task one after another and each task's from another place on."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = TaskContext.get().partitionId() * STRIDE
        for batch in batches:
            for dim, same in batch.groupby("dim", sort=True):
                for a in range(0, len(same), rows):
                    part = same.iloc[a : a + rows]
                    cells = np.floor(np.concatenate(part["cells"].to_list()).astype(np.float64))
                    yield pd.DataFrame({"at": [n], "dim": [dim], "ids": [part["id"].to_numpy(np.int64).tobytes()], "cells": [cells.astype(kind).tobytes()]})
                    n += 1

    return pack


#: A prime, so that tasks begin to deal at different shards.
STRIDE = 1_000_003
BLOCK = "at long, dim int, ids binary, cells binary"


def _kind(most: float) -> str:
    """The smallest type that holds integers up to ``most`` in absolute value; beyond 2^53 every double is one."""
    return "i2" if most < 1 << 15 else "i4" if most < 1 << 31 else "i8" if most < 1 << 53 else "f8"


def _numbers(cells: bytes, kind: str, dim: int, wide: bool) -> np.ndarray:
    """The vectors of a block as 64-bit integers, or as Python's where products pass 64 bits."""
    flat = np.frombuffer(cells, kind)
    return (np.array([int(x) for x in flat], object) if wide else flat.astype(np.int64)).reshape(-1, dim)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, *, scale: int = 256, key: str = "vec_id", vector: str = "embedding", query_block: int = 512, row_block: int = 2048,
    shard_bytes: int = 1 << 24,
) -> DataFrame:
    """For each row where ``is_query``, the ``k`` other rows of the largest integer inner product, ties to the smaller key.

    Components become floor(scale * x). Rows are packed into blocks of ``row_block`` and shuffled once, to shards of
    ``shard_bytes`` of cells or so. The queries, the small side, go to every shard in blocks of ``query_block``: a task
    holds its shard's rows and reads one query block after another, with marks that rise from row block to row block. The
    shards' best are merged by rank. So the shuffle holds the rows once and the queries once a shard.

    Null or empty vectors and those with a null or non-finite component take no part; a query is compared with vectors
    of its own length only. Rows of a null key take no part. Of rows that repeat a key each counts, but none is compared
    with its own key. With fewer rows than ``k`` all are returned; an empty table gives no rows. Where products can pass 64
    bits they are made of Python's integers, slowly; a score among a shard's best that is no 64-bit integer is an error.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.where(sound(F.col(vector)) & F.col(key).isNotNull() & (F.size(vector) > 0))
    cells = F.transform(F.col(vector), lambda x: F.lit(float(scale)) * x.cast("double"))
    rows = rows.select(F.col(key).cast("long").alias("id"), cells.alias("cells"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.size(vector).alias("dim"))
    # A floor is at most one further from zero.
    square = F.aggregate("cells", F.lit(0.0), lambda s, x: s + (F.abs(x) + 1) * (F.abs(x) + 1))
    known = rows.agg(F.count("*").alias("n"), F.max("dim").alias("dim"), F.max(F.array_max(F.transform("cells", F.abs))).alias("most"), F.max(square).alias("square")).first()
    if known["n"] and not math.isfinite(known["most"]):
        raise OverflowError("scale times a component is no finite number")
    kind, wide = _kind((known["most"] or 0.0) + 1), (known["square"] or 0.0) >= 2.0**62
    held_rows = max(1, shard_bytes // ((known["dim"] or 1) * np.dtype(kind).itemsize))
    spread = min(2 * spark.sparkContext.defaultParallelism, -(-known["n"] // row_block))
    shards = max(1, -(-known["n"] // held_rows), spread)
    blocks = rows.select("dim", "id", "cells").mapInPandas(_packer(min(row_block, held_rows), kind), BLOCK)
    blocks = blocks.select(F.pmod("at", F.lit(shards)).alias("shard"), "dim", F.lit(False).alias("asks"), "ids", "cells")
    asks = rows.where("asks").select("dim", "id", "cells").mapInPandas(_packer(query_block, kind), BLOCK)
    asks = asks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), "dim", F.lit(True).alias("asks"), "ids", "cells")
    met = blocks.union(asks).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "dim", "asks")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, shard = None, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if (row.shard, row.dim) != here:
                    here, shard = (row.shard, row.dim), []
                ids = np.frombuffer(row.ids, np.int64)
                if not row.asks:
                    shard.append((ids, row.cells))
                    continue
                lists = [np.empty((0, 2), object if wide else np.int64) for _ in ids]
                asked = _numbers(row.cells, kind, row.dim, wide)
                for mine, packed in shard:
                    best(asked, ids, _numbers(packed, kind, row.dim, wide), mine, lists, k)
                every = np.concatenate(lists)
                if wide and any(abs(x) >= 1 << 63 for x in every[:, 0]):
                    raise OverflowError("a score is no 64-bit integer")
                yield pd.DataFrame({"query_id": np.repeat(ids, [len(x) for x in lists]), "vec_id": every[:, 1].astype(np.int64), "score": every[:, 0].astype(np.int64)})

    found = met.mapInPandas(search, "query_id long, vec_id long, score long")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
