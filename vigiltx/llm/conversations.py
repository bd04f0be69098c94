"""Conversation structure repair: the cheapest edits that make a conversation alternate, by Knuth's lightest derivation.

Items say that the first rows of a piece were edited so that a grammar state is reached; deductions keep, re-role or
delete the next row or insert a turn, and pop from an agenda in order of (cost, audit). Both never fall along a deduction
(superior functions), so the first goal item popped is the lightest. Pieces of one long conversation are derived for
themselves, from every state, and their items combined.

A conversation that lies within one task's share of the sorted rows is repaired there. The few on the border between two
shares, and those beyond ``RepairRules.rows``, are cut into pieces that Spark spreads, whatever their size.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigiltx.llm.common import ship
from vigiltx.sources.shared import materialize

#: Grammar states: nothing yet, after s, after u, after a. A repaired conversation ends in the first or the last.
EMPTY, OPENED, ASKED, ANSWERED = range(4)
#: Where the initial of a kept role leads.
STEP = {(EMPTY, "s"): OPENED, (EMPTY, "u"): ASKED, (OPENED, "u"): ASKED, (ANSWERED, "u"): ASKED, (ASKED, "a"): ANSWERED}
#: Where a user or assistant turn leads, whichever may follow.
NEXT = {EMPTY: ASKED, OPENED: ASKED, ANSWERED: ASKED, ASKED: ANSWERED}
LEGAL = ("su", "ua", "au")
SAID = re.compile(r"[^\x20\x09-\x0D]")
PLAIN, TRUNCATED, GONE = range(3)

ADDED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@dataclass(frozen=True)
class RepairRules:
    """Costs of the edits, and how many rows of a conversation one task holds at a time."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5
    rows: int = 2000


Items = dict[tuple[int, int], tuple[int, str]]


def derive(rows: list[tuple[str, int]], start: int, rules: RepairRules, goals: tuple[int, ...] | None = None) -> dict[int, tuple[int, str]]:
    """The lightest (cost, audit) of each state reached after all ``rows`` (initial, fault) from ``start``.

    With ``goals`` the agenda stops at the first item of a goal state, which is the only one returned.
    """
    size, done = len(rows), set()
    found: dict[int, tuple[int, str]] = {}
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    while agenda:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == size:
            if goals is None or state in goals:
                found[state] = (cost, audit)
                if goals is not None:
                    break
        else:
            initial, fault = rows[at]
            heapq.heappush(agenda, (cost + rules.delete, audit + "D", at + 1, state))
            if fault != GONE:
                more = rules.truncated if fault == TRUNCATED else 0
                kept = state if initial == "" else STEP.get((state, initial))
                if kept is not None:
                    heapq.heappush(agenda, (cost + more, audit + "K", at + 1, kept))
                heapq.heappush(agenda, (cost + more + rules.rerole, audit + "R", at + 1, NEXT[state]))
        if state in NEXT and (at, NEXT[state]) not in done:
            heapq.heappush(agenda, (cost + rules.insert, audit + "I", at, NEXT[state]))
    return found


def combine(before: dict[int, tuple[int, str]], piece: Items) -> dict[int, tuple[int, str]]:
    """The items after one more piece, given those before it."""
    out: dict[int, tuple[int, str]] = {}
    for (start, end), (cost, audit) in piece.items():
        if start in before:
            item = (before[start][0] + cost, before[start][1] + audit)
            out[end] = min(out.get(end, item), item)
    return out


def lightest(items: dict[int, tuple[int, str]]) -> tuple[int, str]:
    return min(items[s] for s in (EMPTY, ANSWERED) if s in items)


class Speaker:
    """Goes along the edits of one conversation and digests the repaired ``role:text`` lines."""

    def __init__(self) -> None:
        self.state, self.digest, self.first = EMPTY, hashlib.sha256(), True

    def say(self, role: str, text: str) -> None:
        self.digest.update((f"{role}:{text}" if self.first else f"\n{role}:{text}").encode("utf-8", "surrogatepass"))
        self.first = False

    def made(self) -> str:
        role = "assistant" if self.state == ASKED else "user"
        self.state = NEXT[self.state]
        return role

    def edit(self, edit: str, role: str, text: str) -> None:
        if edit == "K":
            self.state = STEP.get((self.state, role[:1]), self.state)
            self.say(role, text)
        elif edit == "R":
            self.say(self.made(), text)
        elif edit == "I":
            self.say(self.made(), "")


def fault_of(text: str, again: bool) -> tuple[str, int]:
    """(the row's first fault or "", what the derivation makes of it)."""
    if not SAID.search(text):
        return "blank", GONE
    if again:
        return "duplicate", GONE
    last = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1]
    return ("", PLAIN) if last in ".!?" else ("truncated", TRUNCATED)


class Tally:
    """Faults and illegal neighbours of the rows of a piece, and the rows as the derivation sees them."""

    def __init__(self) -> None:
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.first = self.last = None
        self.rows: list[tuple[str, int]] = []

    def add(self, role: str, text: str, again: bool) -> None:
        name, fault = fault_of(text, again)
        if name:
            self.counts[name] += 1
        if self.last is not None and self.last + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.last = role[:1]
        self.first = self.last if self.first is None else self.first
        self.rows.append((role[:1], fault))


def repaired(rows: list[tuple[str, str]], rules: RepairRules = RepairRules()) -> dict:
    """A whole conversation of (role, text) in order, repaired: the counts, the cost, the audit, the digest."""
    tally, seen = Tally(), set()
    for role, text in rows:
        tally.add(role, text, (role, text) in seen)
        seen.add((role, text))
    cost, audit = lightest(derive(tally.rows, EMPTY, rules, (EMPTY, ANSWERED)))
    speaker, at = Speaker(), 0
    for edit in audit:
        if edit == "I":
            speaker.edit(edit, "", "")
        else:
            speaker.edit(edit, *rows[at])
            at += 1
    return {**tally.counts, "cost": cost, "audit": audit, "repaired_sha256": speaker.digest.hexdigest()}


# Spark


def _spaced(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) of the rows that are left; null roles and texts become one space.

    By the crc32 of ``conv:turn`` modulo 20 a row is dropped (0), emptied (1), loses its [.!?] (2), is there twice (3) or
    becomes a user's (4).
    """
    kind = F.pmod(F.crc32(F.concat(_spaced(F.col(conv)), F.lit(":"), _spaced(F.col(turn)))), F.lit(20)).alias("_kind")
    kept = rows.select(F.col(conv).alias("_conv"), F.col(turn).cast("long").alias("_turn"), _spaced(F.col(role)).alias("_role"), _spaced(F.col(text)).alias("_text"), kind).where("_kind <> 0")
    said = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("_text", "[.!?]", "")).otherwise(F.col("_text"))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    made = kept.select("_conv", "_turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("_role")).alias("role"), said.alias("text"), copies.alias("_copy"))
    return made.select(F.col("_conv").alias("conv"), F.col("_turn").alias("turn"), "role", "text")


#: Rows of a conversation are in this order, null turns first.
ORDER = ["turn", "role", "text"]


def key_of(conv: str = "conv") -> Column:
    """A conversation as text; null and any id differ."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))


WHOLE = "key string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, turn long, role string, text string"


def _rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        yield from batch.itertuples(index=False, name=None)


def _settle(rules: RepairRules):
    """Per task, over rows (key, turn, role, text) in order: a result for every conversation that lies whole within,
    the rows of the others, which are the first and the last and those of too many rows."""

    def settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        nothing = (None,) * 7

        def flush(most: int) -> Iterator[pd.DataFrame]:
            if len(out) > most:
                frame = pd.DataFrame(out, columns=[f.split()[0] for f in WHOLE.split(", ")])
                numbers = ["blank", "duplicate", "truncated", "illegal", "cost", "turn"]
                out.clear()
                yield frame.astype(dict.fromkeys(numbers, "Int64"))

        def opened(held: list[tuple]) -> None:
            out.extend((key, *nothing, turn, role, text) for key, turn, role, text in held)

        key, held, border = None, [], True
        for row in _rows_of(batches):
            if row[0] != key:
                if border:
                    opened(held)
                elif held:
                    done = repaired([(role, text) for _, _, role, text in held], rules)
                    out.append((key, *done.values(), None, None, None))
                border = key is None  # the first conversation may have begun in another task
                key, held = row[0], []
            held.append((row[0], None if pd.isna(row[1]) else int(row[1]), row[2], row[3]))
            if border or len(held) > rules.rows:
                border = True
                opened(held)
                held = []
            yield from flush(2000)
        opened(held)  # the last may go on in another task
        yield from flush(0)

    return settled


PIECE = "key string, part long, blank long, duplicate long, truncated long, illegal long, first string, last string, items array<struct<start: int, end: int, cost: long, audit: string>>"


def _pieces(rules: RepairRules):
    """Per task, over rows (key, part, turn, role, text, copies, again) in order: the counts and items of each conversation's piece."""

    def derived(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in PIECE.split(", ")[:8]] + ["items"]

        def summary(key: str, part: int, tally: Tally, items: dict[int, dict]) -> pd.DataFrame:
            listed = [{"start": s, "end": e, "cost": c, "audit": a} for s, ends in items.items() for e, (c, a) in ends.items()]
            return pd.DataFrame([(key, part, *tally.counts.values(), tally.first, tally.last, listed)], columns=names)

        def go_on(tally: Tally, items: dict[int, dict]) -> dict[int, dict]:
            step = {(s, e): v for s in range(4) for e, v in derive(tally.rows, s, rules).items()}
            tally.rows = []
            return {s: combine(before, step) for s, before in items.items()}

        key, part, tally, items = None, 0, Tally(), {}
        for row in _rows_of(batches):
            if row[0] != key:
                if key is not None:
                    yield summary(key, part, tally, go_on(tally, items))
                key, part, tally, items = row[0], int(row[1]), Tally(), {s: {s: (0, "")} for s in range(4)}
            for copy in range(int(row[5])):
                tally.add(row[3], row[4], bool(row[6]) or copy > 0)
                if len(tally.rows) >= rules.rows:
                    items = go_on(tally, items)
        if key is not None:
            yield summary(key, part, tally, go_on(tally, items))

    return derived


FOLDED = "key string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over pieces in order of (key, part): the sums and the lightest derivation of each conversation."""
    names = [f.split()[0] for f in FOLDED.split(", ")]
    key, counts, last, items = None, None, None, None
    for row in _rows_of(batches):
        if row[0] != key:
            if key is not None:
                yield pd.DataFrame([(key, *counts, *lightest(items))], columns=names)
            key, counts, last, items = row[0], [0, 0, 0, 0], None, {EMPTY: (0, "")}
        counts = [a + int(b) for a, b in zip(counts, row[2:6], strict=True)]
        counts[3] += last is not None and last + row[6] not in LEGAL
        last = row[7]
        items = combine(items, {(i["start"], i["end"]): (i["cost"], i["audit"]) for i in row[8]})
    if key is not None:
        yield pd.DataFrame([(key, *counts, *lightest(items))], columns=names)


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over (key, audit or null, role, text, copies), the audit first and then the rows in order: the digest of each
    conversation. Its rows pass one by one; SHA-256 allows no other way than from the first line to the last."""

    def end(key: str, audit: str, at: int, speaker: Speaker) -> pd.DataFrame:
        for edit in audit[at:]:
            speaker.edit(edit, "", "")
        return pd.DataFrame([(key, speaker.digest.hexdigest())], columns=["key", "repaired_sha256"])

    key, audit, at, speaker = None, "", 0, Speaker()
    for row in _rows_of(batches):
        if row[0] != key:
            if key is not None:
                yield end(key, audit, at, speaker)
            key, audit, at, speaker = row[0], row[1], 0, Speaker()
            continue
        for _ in range(int(row[4])):
            while audit[at] == "I":
                speaker.edit("I", "", "")
                at += 1
            speaker.edit(audit[at], row[2], row[3])
            at += 1
    if key is not None:
        yield end(key, audit, at, speaker)


def _repair_long(rows: DataFrame, rules: RepairRules) -> DataFrame:
    """``repaired`` for conversations of any size: ``rows`` (key, turn, role, text) are written and read several times."""
    rows = materialize(rows.groupBy("key", *ORDER).agg(F.count("*").alias("copies")), "open")
    told = F.xxhash64("role", "text"), F.md5(F.concat_ws(":", F.octet_length("role"), "role", "text"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn").alias("at")
    said = rows.select("key", told[0].alias("hash"), told[1].alias("md5"), turn)
    first = said.groupBy("key", "hash", "md5").agg(F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1")
    marked = rows.withColumns({"hash": told[0], "md5": told[1]}).join(first, ["key", "hash", "md5"], "left")
    again = F.coalesce(turn > F.col("first"), F.lit(False))
    placed = materialize(
        marked.select("key", *ORDER, "copies", again.alias("again")).repartitionByRange("key", *ORDER).sortWithinPartitions("key", *ORDER)
        .select("key", F.spark_partition_id().cast("long").alias("part"), *ORDER, "copies", "again"),
        "pieces",
    )
    # The parts are as written; a conversation's rows of one part meet in one task, in order.
    sorted_rows = placed.repartition("key", "part").sortWithinPartitions("key", "part", *ORDER)
    summaries = materialize(sorted_rows.mapInPandas(_pieces(rules), PIECE), "summaries")
    found = materialize(summaries.repartition("key").sortWithinPartitions("key", "part").mapInPandas(_folded, FOLDED), "folded")
    none = F.lit(None)
    audits = found.select("key", "audit", none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), none.cast("long").alias("turn"), F.lit(0).alias("kind"))
    lines = placed.select("key", none.cast("string").alias("audit"), "role", "text", "copies", "turn", F.lit(1).alias("kind"))
    stream = audits.unionByName(lines).repartition("key").sortWithinPartitions("key", "kind", *ORDER)
    digests = stream.select("key", "audit", "role", "text", "copies").mapInPandas(_digested, "key string, repaired_sha256 string")
    return found.join(digests, "key")


def repair(rows: DataFrame, rules: RepairRules = RepairRules()) -> DataFrame:
    """(key, counts, cost, audit, repaired_sha256) of every conversation of ``rows`` (conv, turn, role, text).

    ``key`` is as ``key_of`` makes it. Rows of one turn are in order of role and text; repeated rows all count. An empty role
    has no initial: it may stay anywhere, and both its neighbours are illegal ones.
    """
    ship(rows.sparkSession)
    keyed = rows.select(key_of().alias("key"), *ORDER)
    ordered = keyed.repartitionByRange("key", *ORDER).sortWithinPartitions("key", *ORDER)
    all_of_it = materialize(ordered.mapInPandas(_settle(rules), WHOLE), "settled")
    names = ["key", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    whole = all_of_it.where("audit is not null").select(*names)
    return whole.unionByName(_repair_long(all_of_it.where("audit is null").select("key", *ORDER), rules).select(*names))


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """One row for every ``conv_id`` of ``conversations`` with ``ADDED`` columns: damaged by ``damage``, then repaired.

    A null ``conv_id`` is a conversation like any other. One without a row after the damage has zeros, an empty audit and
    the digest of nothing. Turns are longs; columns other than conv_id, turn, role and text play no part.
    """
    left = damage(conversations)
    keyed = left.select(key_of().alias("key"), "turn")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    turns = keyed.distinct().groupBy("key").agg(gaps)
    every = conversations.select(F.col("conv_id").alias("conv")).distinct().withColumn("key", key_of())
    joined = every.join(turns, "key", "left").join(repair(left), "key", "left")
    filled = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return joined.select(F.col("conv").alias("conv_id"), *(F.coalesce(F.col(c), filled.get(c, F.lit(0).cast("long"))).alias(c) for c in ADDED))
