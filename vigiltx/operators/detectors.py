"""Behaviour detectors over bronze or silver transactions.

A customer or key may own a large share of all rows, so no detector gathers a whole
customer in one task: rows are added up per second, day or pair first, and windows
run over pieces of bounded size. Amounts add up exactly, as in the features; an infinite
or NaN amount makes the total infinite or NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigiltx.config import RATES, REPORTING_LIMIT, FeatureConfig
from vigiltx.functions.money import PARTS, convert, dollars, money_parts, money_sum
from vigiltx.functions.times import parse_time
from vigiltx.operators.features import both_sides

DAY = 86_400


def _money(amount: Column, where: Column | None = None, prefix: str = "") -> list[Column]:
    """Sums of the parts that ``_dollars`` puts together."""
    return [
        F.sum(part if where is None else F.when(where, part)).alias(prefix + name)
        for name, part in money_parts(amount).items()
    ]


def _dollars(prefix: str = "") -> Column:
    return dollars(*[F.col(prefix + name) for name in PARTS])


def _slice(second: Column, width: int) -> Column:
    """Index of the time slice. Declared never NULL, so that Spark adds no null filter
    of its own to one of several uses and they share one shuffle."""
    return F.coalesce(F.floor(second / width), F.lit(0))


def to_currency(tx: DataFrame, name: str = "converted", rates: dict[str, float] = RATES) -> DataFrame:
    return tx.withColumn(name, convert(F.col("amount_usd"), F.col("currency"), rates))


def defect_profile(bronze: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of slash-format dates, non-standard currencies, missing and repeated keys."""
    slash = F.col("time_text").rlike(r"^\d{2}/\d{2}/\d{4}")
    standard = F.col("currency").isin(*RATES)
    per_key = bronze.groupBy(*by, "tx_id").agg(
        F.count("*").alias("n"),
        F.count_if(slash).alias("slash"),
        F.count_if(~standard).alias("other"),
    )
    no_key = F.col("tx_id").isNull()

    def rows(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0))

    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_rows"),
        F.coalesce(F.sum("slash"), F.lit(0)).alias("slash_dates"),
        F.coalesce(F.sum("other"), F.lit(0)).alias("nonstandard_currencies"),
        rows(no_key).alias("missing_keys"),
        rows(~no_key & (F.col("n") > 1)).alias("repeated_key_rows"),
    )


def near_duplicates(bronze: DataFrame) -> DataFrame:
    """Keys seen at two consecutive seconds.

    Each row is offered to its own second and to the next one; a second that gets
    both is a pair. One shuffle by (key, second), counted before it.
    """
    at = F.unix_seconds(parse_time(F.col("time_text")))
    own = F.struct(at.alias("second"), F.lit(1).alias("here"), F.lit(0).alias("before"))
    next_one = F.struct((at + 1).alias("second"), F.lit(0).alias("here"), F.lit(1).alias("before"))
    return (
        bronze.filter(F.col("tx_id").isNotNull())
        .select("tx_id", F.explode(F.array(own, next_one)).alias("o"))
        .filter(F.col("o.second").isNotNull())
        .groupBy("tx_id", F.col("o.second").alias("second"))
        .agg(F.sum("o.before").alias("first_rows"), F.sum("o.here").alias("second_rows"))
        .filter("first_rows > 0 AND second_rows > 0")
        .select(
            "tx_id",
            F.timestamp_seconds(F.col("second") - 1).alias("first_at"),
            F.timestamp_seconds("second").alias("second_at"),
            "first_rows",
            "second_rows",
        )
    )


def _chain(pieces: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """Join pieces (started, ended, events, money) of one key that lie within ``gap``.

    A task sorts its pieces and holds their sums twice, many times what it reads. So they are dealt to all shuffle
    partitions, which adaptive execution does not put together up to its advisory size again.
    """
    pieces = pieces.repartition(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    w = W.partitionBy(*keys).orderBy("started")
    breaks = F.coalesce(F.col("started") - F.lag("ended").over(w) > gap, F.lit(True))
    return (
        pieces.withColumn("_break", breaks.cast("int"))
        .withColumn("_chain", F.sum("_break").over(w))
        .groupBy(*keys, "_chain")
        .agg(
            F.min("started").alias("started"),
            F.max("ended").alias("ended"),
            F.sum("events").alias("events"),
            *[F.sum(name).alias(name) for name in PARTS],
        )
        .drop("_chain")
    )


def burst_sessions(tx: DataFrame, gap_seconds: int = 59, min_events: int = 1) -> DataFrame:
    """Runs of a sender's transactions with at most ``gap_seconds`` between neighbours.

    Time is cut into slices. Sessions are built per (sender, slice) from one row per
    second; only those that come close to a slice border, at most two per slice, are
    then joined across slices.
    """
    width = max(DAY, 10 * gap_seconds)
    second = F.unix_seconds("tx_ts")
    ticks = (
        tx.filter(F.col("origin").isNotNull() & F.col("tx_ts").isNotNull())
        .groupBy(F.col("origin").alias("customer_id"), second.alias("started"))
        .agg(F.count("*").alias("events"), *_money(F.col("amount_usd")))
        .withColumn("ended", F.col("started"))
        .withColumn("slice", _slice(F.col("started"), width))
    )
    local = _chain(ticks, ["customer_id", "slice"], gap_seconds)
    near_start = F.col("started") - F.col("slice") * width <= gap_seconds
    near_end = (F.col("slice") + 1) * width - F.col("ended") <= gap_seconds
    at_border = F.coalesce(near_start | near_end, F.lit(True))  # as in _slice
    across = _chain(local.filter(at_border), ["customer_id"], gap_seconds)
    sessions = local.filter(~at_border).drop("slice").unionByName(across)
    return sessions.filter(F.col("events") >= min_events).select(
        F.concat_ws("@", "customer_id", "started").alias("session_id"),
        "customer_id",
        F.timestamp_seconds("started").alias("started_at"),
        F.timestamp_seconds("ended").alias("ended_at"),
        (F.col("ended") - F.col("started")).alias("span_seconds"),
        "events",
        _dollars().alias("amount"),
    )


def cash_splitting(
    tx: DataFrame,
    cash_channels: str = FeatureConfig.cash_channels,
    period: str = "day",
    deposits: tuple[int, int] = (3, 5),
    each_below: float = REPORTING_LIMIT,
    total_above: float = REPORTING_LIMIT,
) -> DataFrame:
    """Customers whose few cash movements of one period add up to more than the limit
    while each stays below it."""
    return (
        tx.filter(F.col("channel").rlike(cash_channels) & F.col("tx_ts").isNotNull())
        .groupBy(
            F.col("origin").alias("customer_id"),
            F.to_date(F.date_trunc(period, "tx_ts")).alias("period_start"),
        )
        .agg(
            F.count("*").alias("deposits"),
            money_sum(F.col("amount_usd")).alias("amount"),
            F.max("amount_usd").alias("largest"),
        )
        .filter(
            F.col("deposits").between(*deposits)
            & (F.col("largest") < each_below)
            & (F.col("amount") > total_above)
        )
    )


def pass_through(
    tx: DataFrame,
    inbound_channel: str = "Plataforma_Terceros",
    outbound_channel: str = "Transferencia_Bancaria",
    min_share: float = 0.90,
    limit: float | None = REPORTING_LIMIT,
    near_limit: float = 1.0,
) -> DataFrame:
    """Customers who, after their last inbound payment, send on most of what they got,
    or an amount just below the reporting limit.

    Whole days after the last inbound day are added up per (customer, day); only that
    last day itself is looked at by the second.
    """
    amount = F.col("amount_usd")
    # Filtered on the very expression used below, so both uses of by_second are one plan.
    timed = tx.filter(F.unix_seconds("tx_ts").isNotNull())
    received = (
        timed.filter(F.col("channel") == inbound_channel)
        .groupBy(F.col("destination").alias("customer_id"))
        .agg(
            F.count("*").alias("in_count"),
            *_money(amount, prefix="in_"),
            F.max(F.unix_seconds("tx_ts")).alias("last_in"),
        )
        .filter(F.col("customer_id").isNotNull())
        .withColumn("last_day", _slice(F.col("last_in"), DAY))
    )
    by_second = (
        timed.filter((F.col("channel") == outbound_channel) & F.col("origin").isNotNull())
        .groupBy(F.col("origin").alias("customer_id"), F.unix_seconds("tx_ts").alias("second"))
        .agg(F.count("*").alias("n"), *_money(amount))
        .withColumn("day", _slice(F.col("second"), DAY))
    )
    by_day = by_second.groupBy("customer_id", "day").agg(
        *[F.sum(name).alias(name) for name in ("n", *PARTS)]
    )
    later_days = by_day.join(received, "customer_id").filter(F.col("day") > F.col("last_day"))
    last_day = (
        by_second.withColumnRenamed("day", "last_day")
        .join(received, ["customer_id", "last_day"])
        .filter(F.col("second") > F.col("last_in"))
    )
    received_parts = [f"in_{name}" for name in PARTS]
    wanted = ["customer_id", "in_count", *received_parts, "last_in", "n", *PARTS]
    sent = (
        later_days.select(*wanted)
        .unionByName(last_day.select(*wanted))
        .groupBy("customer_id")
        .agg(
            F.max("in_count").alias("in_count"),
            *[F.max(name).alias(name) for name in received_parts],
            F.max("last_in").alias("last_in"),
            F.sum("n").alias("out_count"),
            *[F.sum(name).alias(f"out_{name}") for name in PARTS],
        )
    )
    out_total, in_total = F.col("out_total"), F.col("in_total")
    suspicious = out_total >= min_share * in_total
    if limit is not None:
        suspicious = suspicious | ((out_total >= limit - near_limit) & (out_total < limit))
    return sent.select(
        "customer_id",
        "in_count",
        _dollars("in_").alias("in_total"),
        F.timestamp_seconds("last_in").alias("last_in_at"),
        "out_count",
        _dollars("out_").alias("out_total"),
    ).filter(suspicious)


def time_profile(tx: DataFrame) -> DataFrame:
    """Per sender: transactions at night (hours 1-5), in office hours (9-18), at weekends.

    Shares are over transactions with a readable time.
    """
    hour = F.hour("tx_ts")
    timed = F.count("tx_ts")
    counts = {
        "night": F.count_if(hour.between(1, 5)),
        "office": F.count_if(hour.between(9, 18)),
        "weekend": F.count_if(F.dayofweek("tx_ts").isin(1, 7)),
    }
    return (
        tx.filter(F.col("origin").isNotNull())
        .groupBy(F.col("origin").alias("customer_id"))
        .agg(
            timed.alias("timed_count"),
            *[n.alias(f"{name}_count") for name, n in counts.items()],
        )
        .withColumns(
            {f"{name}_share": F.try_divide(f"{name}_count", "timed_count") for name in counts}
        )
    )


def single_exit(
    tx: DataFrame,
    inbound_channel: str = "Crypto_Wallet",
    outbound_channel: str = "Exchange_Crypto",
    min_inbound: int = 5,
    max_exits: int = 1,
    tolerance: float | None = 0.01,
) -> DataFrame:
    """Customers fed by several inbound payments whose outflow goes to at most
    ``max_exits`` destinations; with a tolerance, out must equal in within that share."""
    channel, amount = F.col("channel"), F.col("amount_usd")
    comes_in, goes_out = channel == inbound_channel, channel == outbound_channel
    edges = (
        tx.filter(comes_in | goes_out)
        .groupBy("origin", "destination")
        .agg(
            F.count_if(comes_in).alias("in_n"),
            *_money(amount, comes_in, "in_"),
            F.count_if(goes_out).alias("out_n"),
            *_money(amount, goes_out, "out_"),
        )
    )
    sent = F.col("sent")
    is_exit = sent & (F.col("out_n") > 0)

    def total(where: Column, side: str) -> Column:
        parts = (F.sum(F.when(where, F.col(f"{side}_{name}"))) for name in PARTS)
        return dollars(*parts).alias(f"{side}_total")

    totals = both_sides(edges).groupBy("customer_id").agg(
        F.sum(F.when(~sent, F.col("in_n"))).alias("in_count"),
        total(~sent, "in"),
        F.sum(F.when(sent, F.col("out_n"))).alias("out_count"),
        total(sent, "out"),
        F.count(F.when(is_exit, F.col("peer"))).alias("exits"),
    )
    found = totals.filter(
        (F.col("in_count") >= min_inbound) & F.col("exits").between(1, max_exits)
    )
    if tolerance is not None:
        off = F.abs(F.col("out_total") - F.col("in_total"))
        found = found.filter(off <= tolerance * F.col("in_total"))
    return found
