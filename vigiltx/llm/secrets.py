"""Secrets in texts: fixed patterns, then how many repositories and owners hold each value decides what it is."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigiltx.llm.common import uncarried
from vigiltx.sources.shared import materialize

# The patterns of the kinds, and the least length of the part that counts.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: Order of the kinds of spans that start together.
KINDS = ["assign", "access", "hex", "live", "example"]

_BARE = r"[A-Za-z0-9+/_=-]{24,}"
#: Kind, a cheap pattern that every text with a match contains, the pattern, and the group that holds the value.
_FAMILIES = [
    ("assign", r"""[:=]\x20*["']?[A-Za-z0-9+/_.=-]""", ASSIGN, 2),
    ("access", ACCESS, ACCESS, 0),
    ("hex", r"[0-9a-f]{32}", r"[0-9a-f]{32,}", 0),
    ("bare", r"[0-9]", _BARE, 0),
]
_PLACEHOLDER = r"(?i)example|sample|dummy|changeme|change_me|placeholder|your|xxxx|test|12345678|abcdef"


@dataclass(frozen=True)
class Ownership:
    """When a value is a widely copied example: ``common_owners`` distinct owners or more hold it in
    ``common_repositories`` distinct repositories or more, or any owners in ``many_repositories`` or more. Below that it
    is live if it has ``least_distinct`` different characters or more and no placeholder word. So a key that a few
    owners each leaked once stays live, and a sample that one owner copied everywhere is an example."""

    common_owners: int = 3
    common_repositories: int = 10
    many_repositories: int = 1000
    least_distinct: int = 7
    least_length: int = 12


def _matches(text: Column, kind: str, sieve: str, pattern: str, group: int) -> Column:
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    rows = F.transform(
        F.arrays_zip(found.alias("m"), value.alias("v")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(F.get(gaps, i)).alias("gap"),
            F.length(x["m"]).alias("size"), x["v"].alias("value"),
        ),
    )
    return F.when(text.rlike(sieve), rows).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,size:int,value:string>>"))


def _occurrences(hits: DataFrame) -> DataFrame:
    """A row for each candidate of each text, with its place in code points."""
    rows = hits.select("_id", "_owner", "_repo", F.inline("_raw"))
    before = Window.partitionBy("_id", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    rows = rows.select("*", end.alias("end")).withColumn("start", F.col("end") - F.col("size"))
    rows = rows.where(
        (F.col("kind") != "assign") & (F.col("kind") != "access") | (F.length("value") >= F.when(F.col("kind") == "assign", LEAST["assign"]).otherwise(LEAST["access"]))
    ).where((F.col("kind") != "bare") | F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]"))
    return rows.select("_id", "_owner", "_repo", "kind", "start", "end", "value", F.sha2("value", 256).alias("hash"))


def find_secrets(
    docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id", rule: Ownership = Ownership(), keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``spans``, an array of (start, end, kind) in order.

    Kinds ``assign``, ``access`` and ``hex`` are the matches of the fixed patterns. Each matched value, and each bare
    run of 24 characters or more that mixes digits and both cases, is then looked up in the whole corpus: distinct
    repositories (of an owner) and owners are counted for its hash. A value that ``rule`` takes for widely copied adds a
    span ``example``, another that looks random adds a span ``live``; both cover the value alone. ``documents`` names
    no repository, so a document stands for one.

    A null text counts as empty and has no spans, a null owner or repository is one of its own. Repeated rows keep
    their own results. A column of ``docs`` named ``spans`` is replaced. Only texts with a candidate are shuffled, and
    they without the text unless it is kept; a value that a third of all rows hold is counted before the shuffle, and
    its rows are split by the adaptive skew join.
    """
    fields = [f for f in docs.columns if keep is None or f in keep]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    raw = F.concat(*(_matches(whole, *family) for family in _FAMILIES))
    none = F.lit("\x00")
    scanned = docs.select(
        F.struct(*fields).alias("_row"), F.monotonically_increasing_id().alias("_id"),
        F.coalesce(F.col(owner).cast("string"), none).alias("_owner"), F.coalesce(F.col(repository).cast("string"), none).alias("_repo"), raw.alias("_raw"),
    )
    scanned = materialize(scanned, "secrets")
    hits = scanned.where(F.size("_raw") > 0)
    rows = _occurrences(hits)
    counted = (
        rows.select("hash", "_owner", "_repo").distinct()
        .groupBy("hash", "_owner").agg(F.count("*").alias("n"))
        .groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    )
    counted = materialize(counted, "owners")
    random = (F.size(F.array_distinct(F.split("value", ""))) >= rule.least_distinct) & (F.length("value") >= rule.least_length) & ~F.col("value").rlike(_PLACEHOLDER)
    common = (F.col("owners") >= rule.common_owners) & (F.col("repositories") >= rule.common_repositories)
    verdict = F.when(common | (F.col("repositories") >= rule.many_repositories), "example").when(random, "live")

    def span(start: Column, kind: Column) -> Column:
        order = F.array_position(F.array(*map(F.lit, KINDS)), kind)
        return F.struct(start.alias("start"), order.alias("order"), F.col("end").alias("end"), kind.alias("kind"))

    judged = rows.join(counted, "hash").withColumn("verdict", verdict)
    base = F.when(F.col("kind") != "bare", span(F.col("start"), F.col("kind")))
    added = F.when(F.col("verdict").isNotNull(), span(F.col("end") - F.length("value"), F.col("verdict")))
    spans = judged.groupBy("_id").agg(F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.collect_list(F.array(base, added)))))).alias("_spans"))
    none_found = F.array().cast("array<struct<start:bigint,order:bigint,end:bigint,kind:string>>")
    out = (
        hits.select("_id", "_row").join(spans, "_id", "left").select("_row", F.coalesce("_spans", none_found).alias("_spans"))
        .unionByName(scanned.where(F.size("_raw") == 0).select("_row", none_found.alias("_spans")))
    )
    plain = F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return uncarried(out, fields, plain.alias("spans"), added=["spans"])


def spelled(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with the spans replaced by ``mark``; overlapping spans become one."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        gap = F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")), F.lit(mark))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(fresh, gap).otherwise(done["out"]).alias("out"))

    end = F.aggregate(spans, start, step)
    rest = F.concat(end["out"], F.substring(text, (end["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def masked(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every found secret replaced in the text, but for values that are widely copied examples."""
    own = "spans" in docs.columns
    found = find_secrets(docs.withColumnRenamed("spans", "_own_spans") if own else docs, text, **options)
    examples = F.filter("spans", lambda s: s["kind"] == "example")
    live = F.filter("spans", lambda s: ~F.exists(examples, lambda e: (e["start"] >= s["start"]) & (e["end"] <= s["end"])))
    found = found.withColumn(text, redacted(F.col(text), live)).drop("spans")
    return (found.withColumnRenamed("_own_spans", "spans") if own else found).select(*docs.columns)
