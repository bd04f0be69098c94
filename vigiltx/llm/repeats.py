"""Repeated byte strings over a whole corpus, by prefix-free parsing.

Triggers of a rolling hash cut texts into overlapping phrases, so that every string of the least length lies in exactly
one phrase, and equal strings are cut at the same trigger. The dictionary holds each distinct phrase once, at its first
place in the corpus; every later place of a phrase is a repeat as a whole. Strings of different phrases can only be
equal if the phrases share their trigger; only for such phrases are the strings themselves put in order, which is the
order of the dictionary's suffixes as deep as a match needs to be.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigiltx.functions.ranks import dense_index
from vigiltx.llm.common import CHUNK, WORD, let_through, mixed, parts, ship, squeezed, whole_groups
from vigiltx.sources.shared import materialize

#: Phrases of one trigger that are compared in one task.
MANY = 4096
#: Texts that are cut at a time.
ROWS = 256
LAST = (1 << 63) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_TABLE = mixed(np.arange(1, 257, dtype=WORD) * WORD(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D


@dataclass(frozen=True)
class RepeatRule:
    """Strings of ``length`` bytes; a trigger is the least rolling hash of ``gram`` bytes in such a string."""

    length: int = 100
    gram: int = 32

    @property
    def bits(self) -> int:
        """Bits for the number of strings of a phrase, which rows of phrases keep beside its place."""
        return (self.length - self.gram + 1).bit_length()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    size = 1 << max(n, 1 << 12).bit_length()
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _BASE, WORD), np.full(size, pow(_BASE, -1, 1 << 64), WORD)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up, dtype=WORD), np.cumprod(down, dtype=WORD)
    return _powers[size]


def rolling(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which the hash of any stretch follows, and the inverse powers for it."""
    up, down = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, WORD)
    np.cumsum(_TABLE[raw] * up[: len(raw)], dtype=WORD, out=sums[1:])
    return sums, down


def stretch(sums: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(WORD))


def triggers(sums: np.ndarray, down: np.ndarray, n: int, rule: RepeatRule) -> tuple[np.ndarray, np.ndarray]:
    """For each string of a stretch of ``n`` bytes the place of its trigger, and the hash there; the leftmost in a tie."""
    grams = n - rule.gram + 1
    at = np.arange(grams)
    own = stretch(sums, down, at, at + rule.gram)
    span, bits = rule.length - rule.gram + 1, WORD(max(1, int(grams).bit_length()))
    key = (own >> bits << bits) | at.astype(WORD)
    padded = np.full(-(-grams // span) * span + span, np.iinfo(WORD).max, WORD)
    padded[:grams] = key
    table = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    strings = np.arange(n - rule.length + 1)
    least = np.minimum(back[strings], ahead[strings + span - 1])
    place = (least & ((WORD(1) << bits) - WORD(1))).astype(np.int64)
    return place, own


def stretches(raws: list[bytes], rule: RepeatRule) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts put together: bytes, the text each byte is in, and its place there. Long texts come in pieces, which overlap
    so that every string is in one."""
    size = CHUNK // 4  # some twenty numbers a byte are in memory at a time
    parts, owners, places, total = [], [], [], 0
    for i, raw in enumerate(raws):
        if len(raw) < rule.length:
            continue
        for at in range(0, len(raw) - rule.length + 1, size):
            piece = np.frombuffer(raw, np.uint8)[at : at + size + rule.length - 1]
            parts.append(piece)
            owners.append(np.full(len(piece), i, np.int64))
            places.append(at + np.arange(len(piece)))
            total += len(piece)
            if total >= size or at + size < len(raw) - rule.length + 1:
                yield np.concatenate(parts), np.concatenate(owners), np.concatenate(places)
                parts, owners, places, total = [], [], [], 0
    if parts:
        yield np.concatenate(parts), np.concatenate(owners), np.concatenate(places)


def phrases(raws: list[bytes], rule: RepeatRule) -> tuple[np.ndarray, ...]:
    """All phrases: text, place, number of strings, hash at the trigger, hash of the phrase."""
    found = []
    for raw, owner, place in stretches(raws, rule):
        if len(raw) < rule.length:
            continue
        sums, down = rolling(raw)
        trigger, own = triggers(sums, down, len(raw), rule)
        whole = owner[: len(trigger)] == owner[rule.length - 1 :]
        new = np.ones(len(trigger), bool)
        new[1:] = (trigger[1:] != trigger[:-1]) | (owner[1 : len(trigger)] != owner[: len(trigger) - 1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(trigger)))
        keep = whole[first]
        first, count = first[keep], count[keep]
        found.append((owner[first], place[first], count, own[trigger[first]], stretch(sums, down, first, first + count + rule.length - 1)))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, none.view(WORD), none.view(WORD)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, disjoint and not touching."""
    if not len(start):
        return start, end
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(end[by])
    first = np.ones(len(start), bool)
    first[1:] = start[1:] > reach[:-1]
    return start[first], reach[np.append(np.flatnonzero(first)[1:] - 1, len(start) - 1)]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _phrase_rows(texts: DataFrame, rule: RepeatRule) -> DataFrame:
    """(trigger, phrase, doc, at): for each batch the first place of each phrase. What repeats within the batch is known
    at once: such rows have no strings, begin at their place and have their end as phrase."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts(batches, limit=6 * CHUNK):
            docs = batch["doc"].to_numpy(np.int64)
            owner, place, count, trigger, phrase = phrases([_bytes(t) for t in batch["text"]], rule)
            doc = docs[owner]
            by = np.lexsort((place, doc, phrase, trigger))
            owner, place, count, trigger, phrase, doc = (x[by] for x in (owner, place, count, trigger, phrase, doc))
            same = np.zeros(len(by), bool)
            same[1:] = (trigger[1:] == trigger[:-1]) & (phrase[1:] == phrase[:-1])
            # A repeated row is the same document: what stands at the same place is not earlier.
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
            later = same & ((doc != doc[head]) | (place != place[head]))
            one = ~same
            yield pd.DataFrame({"trigger": trigger[one].view(np.int64), "phrase": phrase[one].view(np.int64), "doc": doc[one], "at": (place[one] << rule.bits) | count[one]})
            if later.any():
                owner, place, end = owner[later], place[later], (place + count + rule.length - 1)[later]
                far = 1 << 40
                start, stop = merged(owner * far + place, owner * far + end)
                who = start // far
                yield pd.DataFrame({"trigger": mixed((docs[who] ^ start).view(WORD)).view(np.int64), "phrase": stop - who * far, "doc": docs[who], "at": (start - who * far) << rule.bits})

    return texts.mapInPandas(read, "trigger long, phrase long, doc long, at long")


def _later(trigger: np.ndarray, doc: np.ndarray, place: np.ndarray, count: np.ndarray, content: list[bytes], rule: RepeatRule) -> tuple[np.ndarray, ...]:
    """Of the strings of phrases that come with their content, the ranges of those that an earlier place has too."""
    raw = np.frombuffer(b"".join(content), np.uint8)
    size = np.fromiter(map(len, content), np.int64, len(content))
    count = np.clip(size - rule.length + 1, 0, count)
    sums, down = rolling(raw)
    base = np.concatenate([[0], np.cumsum(size)[:-1]])
    owner = np.repeat(np.arange(len(count)), count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = base[owner] + step
    string = stretch(sums, down, at, at + rule.length)
    group, who, where = trigger[owner], doc[owner], place[owner] + step
    by = np.lexsort((where, who, string, group))
    first = np.ones(len(by), bool)
    first[1:] = (group[by][1:] != group[by][:-1]) | (string[by][1:] != string[by][:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))
    later = np.zeros(len(by), bool)
    later[by] = (who[by] != who[by][head]) | (where[by] != where[by][head])
    # Strings of a phrase that follow each other make one range.
    owner, where = owner[later], where[later]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (where[1:] != where[:-1] + 1)
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(owner)) - 1 if len(start) else start
    return doc[owner[start]], where[start], where[end] + rule.length


def _settled(texts: DataFrame, checks: DataFrame, rule: RepeatRule) -> DataFrame:
    """(doc, start, end): ranges of ``checks`` (doc, at, trigger, hot) whose strings come earlier in another phrase.

    The phrases of a trigger meet with their content. A trigger that more phrases have than one task should hold is
    ``hot``: its strings are shuffled one by one, known by two hashes, those that return within a batch only once.
    """
    asked = checks.groupBy("doc").agg(F.collect_set(F.struct("at", "trigger", "hot")).alias("asked"))
    rows = let_through(texts, checks, "doc", F.col("doc")).where("_met").select("doc", squeezed("text").alias("packed"))
    rows = rows.dropDuplicates(["doc"]).join(asked, "doc").select("doc", "packed", F.col("asked.at").alias("at"), F.col("asked.trigger").alias("trigger"), F.col("asked.hot").alias("hot"))
    bits, mask = rule.bits, (1 << rule.bits) - 1

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cuts = []
            for doc, packed, at, trigger, hot in batch.itertuples(index=False):
                raw = zlib.decompress(packed)
                start = np.asarray(at, np.int64) >> bits
                size = (np.asarray(at, np.int64) & mask) + rule.length - 1
                cuts.append(pd.DataFrame({"trigger": trigger, "hot": hot, "doc": doc, "start": start, "count": size - rule.length + 1, "content": [raw[a : a + n] for a, n in zip(start.tolist(), size.tolist(), strict=True)]}))
                if sum(map(len, cuts)) > 4096:
                    yield pd.concat(cuts, ignore_index=True)
                    cuts = []
            if cuts:
                yield pd.concat(cuts, ignore_index=True)

    found = rows.mapInPandas(cut, "trigger long, hot boolean, doc long, start long, count long, content binary")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, "trigger"):
            doc, start, end = _later(*(frame[c].to_numpy(np.int64) for c in ("trigger", "doc", "start", "count")), frame["content"].to_list(), rule)
            yield pd.DataFrame({"doc": doc, "start": start, "end": end})

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            if not len(frame):
                continue
            content = frame["content"].to_list()
            sums, down = rolling(np.frombuffer(b"".join(content), np.uint8))
            size = np.fromiter(map(len, content), np.int64, len(content))
            count = np.clip(size - rule.length + 1, 0, frame["count"].to_numpy(np.int64))
            owner = np.repeat(np.arange(len(count)), count)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = (np.cumsum(size) - size)[owner] + step
            rows = pd.DataFrame({
                "string": stretch(sums, down, at, at + rule.length).view(np.int64), "more": stretch(sums, down, at, at + rule.length // 2).view(np.int64),
                "doc": frame["doc"].to_numpy(np.int64)[owner], "start": frame["start"].to_numpy(np.int64)[owner] + step,
            }).sort_values(["string", "more", "doc", "start"], kind="stable")
            same = rows.duplicated(["string", "more"]).to_numpy()
            rows["end"] = np.where(same, rows["start"] + rule.length, 0)
            yield rows

    cold = found.where("not hot").select("trigger", "doc", "start", "count", "content")
    cold = cold.repartition("trigger").sortWithinPartitions("trigger").mapInPandas(meet, "doc long, start long, end long")
    hot = materialize(found.where("hot").select("doc", "start", "count", "content").mapInPandas(spread, "string long, more long, doc long, start long, end long"), "strings")
    later = F.rank().over(Window.partitionBy("string", "more").orderBy("doc", "start")) > 1
    slow = hot.where("end = 0").withColumn("later", later).where("later").select("doc", "start", F.col("start") + rule.length)
    return cold.union(hot.where("end > 0").select("doc", "start", "end")).union(slow)


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (_row, doc, _text) with a number of its own for each document; the ids themselves unless one has several texts."""
    rows = rows.withColumn("_hash", F.xxhash64(F.col("_text").cast("string")))
    several = rows.groupBy("doc").agg(F.min("_hash").alias("low"), F.max("_hash").alias("high")).where("low <> high")
    if several.isEmpty():
        return rows.drop("_hash")
    numbers = dense_index(rows.select("doc", "_hash").distinct(), ["doc", "_hash"], "_number")
    return materialize(rows.join(numbers, ["doc", "_hash"]).select("_row", F.col("_number").alias("doc"), "_text"), "documents")


def repeated_spans(docs: DataFrame, rule: RepeatRule = RepeatRule(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``spans``, the byte ranges (start, end) to remove, and ``kept``, the bytes that stay.

    A byte goes if a string of ``rule.length`` bytes covers it that also starts earlier: in a row of a smaller id, or
    before it in the same row. Strings are judged on the input, overlaps count, and none crosses rows. A null text
    counts as empty. Rows of a null id come last, in an order by their text. Rows that repeat an id and text are one
    document: each gets the same result. Different texts under one id are documents of their own, in the order of their
    64-bit hashes. Input columns named as an output are replaced.

    Phrases that return within a batch are settled there, so that a phrase that most documents hold reaches the shuffle
    once for each batch. Texts are read three times; only those with a phrase in question are shuffled.
    """
    ship(docs.sparkSession)
    others = [c for c in docs.columns if c != text]
    unnamed = F.lit(LAST) - F.xxhash64(F.col(text).cast("string")).bitwiseAND(F.lit((1 << 40) - 1).cast("long"))
    rows = docs.select(F.struct(*others).alias("_row"), F.coalesce(F.col(key).cast("long"), unnamed).alias("doc"), F.col(text).alias("_text"))
    rows = _numbered(rows)
    texts = rows.select("doc", F.col("_text").cast("string").alias("text")).where(F.octet_length("text") >= rule.length)
    place = F.rank().over(Window.partitionBy("trigger", "phrase").orderBy("doc", F.shiftright("at", rule.bits)))
    of_trigger = Window.partitionBy("trigger")
    count = F.col("at").bitwiseAND(F.lit((1 << rule.bits) - 1).cast("long"))
    start = F.shiftright("at", rule.bits)
    found = _phrase_rows(texts, rule).withColumn("rank", place)
    found = found.withColumn("several", F.min("phrase").over(of_trigger) != F.max("phrase").over(of_trigger))
    found = found.withColumn("hot", F.count("*").over(of_trigger) > MANY).select(
        "doc", "at", "trigger", "hot", start.alias("start"), F.when(count == 0, F.col("phrase")).when(F.col("rank") > 1, start + count + (rule.length - 1)).alias("end"), "several"
    ).where("end is not null or several")
    found = materialize(found, "phrases")
    more = _settled(texts, found.where("end is null").select("doc", "at", "trigger", "hot"), rule)
    spans = found.where("end is not null").select("doc", "start", "end").union(more)
    spans = materialize(spans.groupBy("doc").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (whole.slice(a, ROWS) for whole in batches for a in range(0, whole.num_rows, ROWS)):
            texts, kept, first, last = [], [], [], []
            for p, s, e in zip(*(part.column(c).to_pylist() for c in ("_packed", "starts", "ends")), strict=True):
                raw = zlib.decompress(p)
                s, e = merged(*(np.minimum(np.asarray([] if x is None else x, np.int64), len(raw)) for x in (s, e)))
                first.append(s)
                last.append(e)
                edges = [0, *np.column_stack([s, e]).ravel().tolist(), len(raw)]
                kept.append(b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]))
                texts.append(raw.decode("utf-8", "surrogatepass"))
            ends = np.concatenate([[0], np.cumsum([len(s) for s in first])]).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (first, last)], ["start", "end"])
            columns = [part.column("_row"), pa.array(texts, pa.string()), pa.ListArray.from_arrays(pa.array(ends), pairs), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "_text", "spans", "kept"])

    rows = let_through(rows, spans, "doc", F.col("doc"))
    packed = F.when(F.col("_text").isNotNull(), squeezed(F.col("_text").cast("string")))
    some = rows.where("_met and _text is not null").select("_row", "doc", packed.alias("_packed")).join(spans, "doc", "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    made = T.StructType([some.schema["_row"], T.StructField("_text", T.StringType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField("kept", T.BinaryType())])
    some = some.select("_row", "_packed", "starts", "ends").mapInArrow(cut, made)
    rest = rows.where("not _met or _text is null").select("_row", F.col("_text").cast("string"), none.alias("spans"), F.encode(F.coalesce(F.col("_text").cast("string"), F.lit("")), "utf-8").alias("kept"))
    out = some.union(rest)
    fields = [c for c in docs.columns if c not in ("spans", "kept")]
    return out.select(*(F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in fields), "spans", "kept")
