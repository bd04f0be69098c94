"""Burst sessions over a stream, the same rows as the batch detector gives."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigiltx.functions.money import PARTS, dollars, money_parts


def _pieces(gap: int):
    """Merges the rows of each key that lie within ``gap`` seconds, batch by batch and without state.

    A busy key leaves a task as a few pieces, whatever its rows. One row without a key tells
    the watermark of the latest second.
    """
    names = ["key", "started", "ended", "events", "coarse", "fine", "wide", "odd"]

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            latest = int(rows["second"].max())
            rows = rows[rows["key"].notna()].sort_values(["key", "second"], kind="stable")
            fresh = (rows["key"] != rows["key"].shift()) | (rows["second"].diff() > gap)
            piece = rows.groupby(fresh.cumsum().to_numpy())
            found = pd.DataFrame(
                {
                    "key": piece["key"].first(),
                    "started": piece["second"].min(),
                    "ended": piece["second"].max(),
                    "events": piece["second"].count(),
                    **{name: piece[name].sum(min_count=1) for name in ("coarse", "fine", "odd")},
                }
            )
            wide = rows["wide"].notna()
            sums = {}
            for number, value in zip(fresh.cumsum()[wide], rows["wide"][wide]):
                sums[number] = sums.get(number, 0) + value
            found["wide"] = pd.Series([sums.get(i) for i in found.index], index=found.index, dtype=object)
            for name in ("coarse", "fine"):
                found[name] = found[name].astype("Int64")
            yield found[names]
            yield pd.DataFrame([(None, latest, latest, 0, None, None, None, None)], columns=names)

    return merged


def burst_stream(
    events: DataFrame, key: str, time: str, amount: str, gap_seconds: int = 59, late_by: str = "1 hour"
) -> DataFrame:
    """``burst_sessions`` of a stream, each session once the watermark has passed its last second and the gap.

    Neighbours may lie ``gap_seconds`` apart, that gap included; amounts add up exactly. Rows
    later than ``late_by`` are dropped unless rows of the same batch join them to an open
    session. Each task merges its rows into pieces first; a piece is a session window of its
    own length plus the gap, and the state joins those that meet.
    """
    kind = events.schema[key].dataType
    second = F.unix_seconds(F.col(time).cast("timestamp"))
    rows = events.select(
        F.col(key).alias("key"), second.alias("second"),
        *[part.alias(name) for name, part in money_parts(F.col(amount)).items()],
    ).filter("second IS NOT NULL")
    long, wide = T.LongType(), T.DecimalType(38, 0)
    fields = [("key", kind), *((n, long) for n in ("started", "ended", "events", "coarse", "fine")), ("wide", wide), ("odd", T.DoubleType())]
    pieces = rows.mapInPandas(_pieces(gap_seconds), T.StructType([T.StructField(n, t) for n, t in fields]))
    # Half a second more: windows that only touch would be joined as well.
    length = F.concat((F.col("ended") - F.col("started") + gap_seconds).cast("string"), F.lit(".5 seconds"))
    sessions = (
        pieces.withColumn("at", F.timestamp_seconds("started"))
        .withWatermark("at", late_by)
        .groupBy(F.session_window("at", length).alias("session"), "key")
        .agg(F.sum("events").alias("events"), *[F.sum(name).alias(name) for name in PARTS])
        .filter("events > 0")  # a test of the key itself would keep the latest second from the watermark
    )
    started = F.unix_seconds("session.start")
    ended = F.unix_seconds("session.end") - gap_seconds
    return sessions.select(
        F.concat_ws("@", F.col("key").cast("string"), started).alias("session_id"),
        F.col("key").alias("customer_id"),
        F.timestamp_seconds(started).alias("started_at"),
        F.timestamp_seconds(ended).alias("ended_at"),
        (ended - started).alias("span_seconds"),
        "events",
        dollars(*map(F.col, PARTS)).alias("amount"),
    )
