"""Exact order statistics and dense numbering without a single-task sort."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigiltx.sources.shared import materialize


def order_statistic(df: DataFrame, column: str, rank: int, bins: int = 2048) -> float:
    """The value at 0-based ``rank`` of ``column``, exactly.

    Each pass counts the rows of at most ``bins`` slices and keeps the slice that
    holds the rank, so only ``bins`` rows ever reach the driver.
    """
    x = F.col(column)
    low, high = df.agg(F.min(x), F.max(x)).first()
    while low < high:
        share = (x - F.lit(low)) / F.lit(high - low)
        slices = (
            df.filter(x.between(low, high))
            .groupBy(F.least(F.floor(share * bins), F.lit(bins - 1)).alias("slice"))
            .agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high"))
            .orderBy("slice")
            .collect()
        )
        for part in slices:
            if rank < part["n"]:
                low, high = part["low"], part["high"]
                break
            rank -= part["n"]
    return low


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    """Quantile with linear interpolation between the two nearest ranks.

    Reads ``df`` a few times: pass a written table rather than a long plan.
    """
    df = df.select(column).filter(F.col(column).isNotNull())
    n = df.count()
    if n == 0:
        return None
    position = (n - 1) * q
    rank = math.floor(position)
    value = order_statistic(df, column, rank)
    weight = position - rank
    if weight == 0:
        return value
    upto, above = df.agg(
        F.count_if(F.col(column) <= value), F.min(F.when(F.col(column) > value, F.col(column)))
    ).first()
    following = value if upto > rank + 1 else above
    return value + (following - value) * weight


def dense_index(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows 0, 1, 2, … in ``order``.

    The sorted rows are written with their partition and place; offsets come from
    one count per partition, so no task sees more than its own slice of the rows.
    """
    placed = materialize(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "index"
    )
    part = F.shiftright("_place", 33).alias("_part")
    offsets = (
        placed.groupBy(part)
        .agg(F.count("*").alias("_n"))
        .select(
            "_part",
            (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_offset"),
        )
    )
    in_part = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + in_part)
        .drop("_part", "_place", "_offset")
    )
