"""Mixing sources to target weights: each block of a source gets a slot of an earliest-deadline-first schedule."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigiltx.llm.common import carried, uncarried
from vigiltx.sources.shared import fresh_path, materialize

ADDED = ["block", "release", "deadline", "slot", "block_start"]
#: Blocks placed in one step of an array, steps in one job.
STEP, STEPS = 256, 256


def _weight(weights: dict[str, float] | None, power: float) -> Column:
    if weights is None:
        chars = F.greatest("chars", F.lit(1)).cast("double")
        return F.sqrt(chars) if power == 0.5 else F.pow(chars, F.lit(power))  # a root is rounded alike everywhere
    given = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair)) if weights else F.create_map().cast("map<string,double>")
    return F.coalesce(given[F.col("_source")].cast("double"), F.lit(0.0))


def shares(totals: DataFrame, period: int, weights: dict[str, float] | None = None, power: float = 0.5) -> DataFrame:
    """(source, slots): how many of ``period`` slots each source gets, one at least, by the largest remainders.

    ``weights`` names target weights (a source it lacks gets 0, so one slot); without it a source weighs its
    characters to the power ``power``.
    """
    whole = Window.partitionBy()
    rows = totals.select("_source", _weight(weights, power).alias("weight"), F.count("*").over(whole).alias("n"))
    total = F.sum("weight").over(Window.partitionBy().orderBy("_source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    free = F.greatest(F.lit(period), 2 * F.col("n")) - F.col("n")
    exact = F.when(total > 0, free * F.col("weight") / total).otherwise(free / F.col("n"))
    rows = rows.select("_source", free.alias("free"), F.floor(exact).alias("low"), (exact - F.floor(exact)).alias("rest"))
    left = F.col("free") - F.sum("low").over(whole)
    rank = F.row_number().over(Window.partitionBy().orderBy(F.desc("rest"), "_source"))
    return rows.select("_source", (1 + F.col("low") + F.when(rank <= left, 1).otherwise(0)).alias("slots"))


def schedule(shares: DataFrame) -> DataFrame:
    """(_source, at, period): the slots of one period that each source is served in, in one row per source.

    The k-th block of a source with a of W slots may start at slot floor(k W / a) and must be done by slot
    ceil((k + 1) W / a); each slot goes to the released block with the earliest deadline. At every slot a source has
    then been served less than one block more or less than a / W asks for; what its slots are off its weight adds up
    from period to period. There is one row per source and one slot per unit of the period, whatever the size of the
    table.
    """
    every = shares.agg(F.array_sort(F.collect_list(F.struct("_source", "slots"))).alias("all"))
    every = every.select("all", F.aggregate("all", F.lit(0).cast("long"), lambda n, s: n + s["slots"]).alias("period"))
    period = F.col("period")

    def step(done: Column, t: Column) -> Column:
        def waiting(s: Column, i: Column) -> Column:
            k = F.get(done["served"], i)
            released = (k < s["slots"]) & (F.floor(k * period / s["slots"]) <= t)
            return F.when(released, F.struct(F.ceil((k + 1) * period / s["slots"]).alias("deadline"), i.alias("i")))

        pick = F.array_min(F.transform("all", waiting))["i"]
        return F.struct(
            F.transform(done["served"], lambda n, i: n + F.when(i == pick, 1).otherwise(0).cast("long")).alias("served"),
            F.array_append(done["out"], pick).alias("out"),
        )

    start = F.struct(F.transform("all", lambda s: F.lit(0).cast("long")).alias("served"), F.array().cast("array<int>").alias("out"))
    slots = F.when(period > 0, F.sequence(F.lit(0).cast("long"), period - 1)).otherwise(F.array().cast("array<bigint>"))
    order = F.aggregate(slots, start, step)["out"]
    served = every.select("all", "period", F.posexplode(order).alias("slot", "i"))
    served = served.select(F.get("all", F.col("i"))["_source"].alias("_source"), "period", "slot")
    return served.groupBy("_source", "period").agg(F.array_sort(F.collect_list("slot")).alias("at"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def timetable(totals: DataFrame, block_chars: int, weights: dict[str, float] | None = None, power: float = 0.5) -> DataFrame:
    """(_source, _block, release, deadline, slot) of every block of the table, from the target weights themselves.

    Weights are whole numbers a of W, so fine that over the whole run they are off by next to nothing; the least is 1,
    so a source of weight 0 comes when hardly another has blocks left. The k-th block may start at slot floor(k W / a) and must be
    done by slot ceil((k + 1) W / a); each slot goes to the released block with the earliest deadline, and slots for
    which none is released stay empty. So at every slot, however many there are, a source that has blocks left has been
    served less than one block more or less than its weight asks for. One step for each block; what is waiting goes on
    from job to job in a written table of one row.
    """
    rows = totals.select("_source", _weight(weights, power).alias("weight"), (F.floor(F.col("chars") / F.lit(block_chars)) + 1).cast("long").alias("blocks"))
    size = rows.agg(F.coalesce(F.sum("blocks"), F.lit(0)).alias("all"), F.coalesce(F.max("blocks"), F.lit(0)).alias("most"), F.count("*").alias("n")).first()
    fine = F.lit(min(1 << 50, (1 << 61) // (size["most"] + size["n"] + 2))).cast("long")
    row = rows.agg(F.array_sort(F.collect_list(F.struct("_source", "weight", "blocks"))).alias("all"))
    row = row.select("all", F.aggregate("all", F.lit(0.0), lambda x, s: x + s["weight"]).alias("total"))
    part = lambda s: F.when(F.col("total") > 0, s["weight"] / F.col("total")).otherwise(1.0 / F.size("all"))
    row = row.select("all", F.transform("all", lambda s: F.greatest(F.lit(1).cast("long"), F.round(part(s) * fine).cast("long"))).alias("a"))
    row = row.select("all", "a", F.aggregate("a", F.lit(0).cast("long"), lambda x, y: x + y).alias("w"))

    def div(x: Column, y: Column) -> Column:
        return F.call_function("div", x, y)

    def waiting(i: Column, source: Column, k: Column, a: Column, w: Column, blocks: Column) -> Column:
        due = div((k + 1) * w + a - 1, a).alias("deadline")
        return F.struct(due, i.alias("i"), div(k * w, a).alias("release"), k.alias("k"), a.alias("a"), w.alias("w"), blocks.alias("blocks"), source.alias("source"))

    first = F.transform("all", lambda s, i: waiting(i, s["_source"], F.lit(0).cast("long"), F.get("a", i), F.col("w"), s["blocks"]))
    state = materialize(row.select(first.alias("waiting"), F.lit(0).cast("long").alias("t")), "waiting")
    served = "array<struct<_source:string,_block:bigint,release:bigint,deadline:bigint,slot:bigint>>"

    def step(done: Column, _: Column) -> Column:
        def serve(now: Column, pick: Column) -> Column:
            here = lambda x: F.when(x["i"] == pick["i"], waiting(x["i"], x["source"], x["k"] + 1, x["a"], x["w"], x["blocks"])).otherwise(x)
            at = F.struct(pick["source"].alias("_source"), pick["k"].alias("_block"), pick["release"].alias("release"), pick["deadline"].alias("deadline"), now.alias("slot"))
            left = F.filter(F.transform(done["waiting"], here), lambda x: x["k"] < x["blocks"])
            return F.struct(left.alias("waiting"), (now + 1).alias("t"), F.array_append(done["out"], at).alias("out"))

        now = F.greatest(done["t"], F.array_min(F.transform(done["waiting"], lambda x: x["release"])))
        turn = _let(now, lambda n: _let(F.array_min(F.filter(done["waiting"], lambda x: x["release"] <= n)), lambda pick: serve(n, pick)))
        return F.when(F.size(done["waiting"]) > 0, turn).otherwise(done)

    def steps(done: Column, _: Column) -> Column:
        start = F.struct(done["waiting"].alias("waiting"), done["t"].alias("t"), F.array().cast(served).alias("out"))
        some = F.aggregate(F.sequence(F.lit(1), F.lit(STEP)), start, step)
        return _let(some, lambda s: F.struct(s["waiting"].alias("waiting"), s["t"].alias("t"), F.array_append(done["outs"], s["out"]).alias("outs")))

    path = fresh_path(totals.sparkSession, "timetable")
    for at in range(0, max(1, size["all"]), STEP * STEPS):
        rounds = max(1, min(STEPS, -(-(size["all"] - at) // STEP)))
        start = F.struct("waiting", "t", F.array().cast(f"array<{served}>").alias("outs"))
        state = materialize(state.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, steps).alias("done")).select("done.*"), "waiting")
        state.select(F.inline(F.flatten("outs"))).write.mode("append").parquet(path)
        state = state.select("waiting", "t")
    return totals.sparkSession.read.schema("_source string, _block long, release long, deadline long, slot long").parquet(path)


def _placed(
    docs: DataFrame, weights: dict[str, float] | None, power: float, block_chars: int, period: int | None, text: str, source: str, key: str, rows_per_bucket: int
) -> DataFrame:
    """Every row as ``_row``, and the columns of the schedule as struct ``_at``."""
    sized = carried(
        docs, F.coalesce(F.col(source).cast("string"), F.lit("\x00")).alias("_source"), F.coalesce(F.length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("_size"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
    ).withColumn("_hash", F.conv(F.substring(F.md5("_key"), 1, 15), 16, 10).cast("long"))
    buckets = 1 + docs.count() // rows_per_bucket
    sized = sized.withColumn("_bucket", F.shiftright(F.shiftright("_hash", 30) * F.lit(buckets), 30))
    inside = materialize(sized.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_chars")), "blocks")
    earlier = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = inside.select("_source", "_bucket", "_chars", F.coalesce(F.sum("_chars").over(earlier), F.lit(0)).alias("_base"))
    totals = inside.groupBy("_source").agg(F.sum("_chars").alias("chars"))
    before = Window.partitionBy("_source", "_bucket").orderBy("_hash", "_key", "_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    start = F.col("_base") + F.col("_before")
    block, n = F.floor(start / F.lit(block_chars)), F.size("at")
    if period is None:
        # The blocks that a bucket reaches into come to its rows as one array.
        reached = F.floor(F.col("_base") / F.lit(block_chars)), F.floor((F.col("_base") + F.col("_chars")) / F.lit(block_chars))
        spans = offsets.select("_source", "_bucket", "_base", F.explode(F.sequence(*reached)).alias("_block"))
        served = spans.join(timetable(totals, block_chars, weights, power), ["_source", "_block"]).groupBy("_source", "_bucket", "_base")
        served = materialize(served.agg(F.array_sort(F.collect_list(F.struct("_block", "release", "deadline", "slot"))).alias("at")), "places")
        placed = placed.join(served, ["_source", "_bucket"]).withColumn("_start", start).withColumn("_block", block)
        own = F.get("at", (F.col("_block") - F.get("at", F.lit(0))["_block"]).cast("int"))
        at = F.struct(F.col("_block").alias("block"), *(own[c].alias(c) for c in ("release", "deadline", "slot")), F.col("_start").alias("block_start"))
        return placed.select("_row", at.alias("_at"))
    served = schedule(shares(totals, period, weights, power))
    placed = placed.join(offsets, ["_source", "_bucket"]).join(F.broadcast(served), "_source")
    placed = placed.withColumn("_start", start).withColumn("_block", block)
    at = F.struct(
        F.col("_block").alias("block"), F.floor(F.col("_block") * F.col("period") / n).alias("release"),
        F.ceil((F.col("_block") + 1) * F.col("period") / n).alias("deadline"),
        (F.floor(F.col("_block") / n) * F.col("period") + F.get("at", (F.col("_block") % n).cast("int"))).alias("slot"),
        F.col("_start").alias("block_start"),
    )
    return placed.select("_row", at.alias("_at"))


def mix(
    docs: DataFrame, weights: dict[str, float] | None = None, *, power: float = 0.5, block_chars: int = 1 << 16, period: int | None = None,
    text: str = "text", source: str = "source", key: str = "doc_id", rows_per_bucket: int = 2_000,
) -> DataFrame:
    """``docs`` with the block of its source that each row starts in, and that block's release, deadline and slot.

    A source's rows, in the order of md5 of their key, fill blocks of ``block_chars`` characters. Ordering by (slot,
    block_start) interleaves the sources to their weights: at every slot less than one block off for a source that has
    blocks left; the others keep their proportions when one has run out. With a ``period`` the weights are rounded to
    slots of one period, one slot each source at least, and its schedule repeats: less than one block off the rounded
    weights, but further off the target weights with each period. No row is left out or repeated.

    A null text has no characters; null sources are one source, null keys count as the empty text. Ties of md5 and key
    fall to the length, then to chance among equal rows. Input columns named as an output are replaced. Places are
    counted in buckets of a source, of ``rows_per_bucket`` rows or so, then over the buckets: no source is ever in
    one task.
    """
    placed = _placed(docs, weights, power, block_chars, period, text, source, key, rows_per_bucket)
    return uncarried(placed, docs.columns, *(F.col("_at")[c].alias(c) for c in ADDED), added=ADDED)


def interleaved(
    docs: DataFrame, weights: dict[str, float] | None = None, *, power: float = 0.5, block_chars: int = 1 << 16, period: int | None = None,
    text: str = "text", source: str = "source", key: str = "doc_id", rows_per_bucket: int = 2_000,
) -> DataFrame:
    """``docs`` in the order of the schedule."""
    placed = _placed(docs, weights, power, block_chars, period, text, source, key, rows_per_bucket)
    return placed.orderBy("_at.slot", "_at.block_start").select(*(F.col("_row")[c].alias(c) for c in docs.columns))
