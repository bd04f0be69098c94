"""The operators over their whole tables, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigiltx.llm import conversations, jaccard, langid, mixing, neighbours, quality, repeats, secrets, sentence_pieces, token_counts, topk, toxicity, whitening


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    aside = langid.held_out(F.col("doc_id"))
    return langid.identify(docs, aside).select("doc_id", aside.alias("held_out"), "lang_pred", "score")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(secrets.spelled(base), 256).alias("base_sha256"), secrets.spelled(F.col("spans")).alias("spans"))


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether decoding them gives the text again (the space mark reads as a space)."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    done = sentence_pieces.decode(sentence_pieces.encode(docs))
    back = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), sentence_pieces.SPACE, " ")
    return done.select("doc_id", "n_pieces", "pieces", back.alias("round_trip"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard.similar_groups(_read(spark, sf_dir, "documents"), jaccard.JaccardRule(words=3, percent=90))
    return groups.withColumnRenamed("id", "doc_id")


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the schedule puts every document; a source's target weight is the square root of its characters."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "source", *mixing.ADDED)


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.repeated_spans(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return cut.select("doc_id", size.alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select("doc_id", *token_counts.ADDED)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    aside = quality.held_out(F.col("doc_id"))
    scored = quality.score_quality(docs, _read(spark, sf_dir, "labels").select("doc_id", "quality"), aside)
    return scored.select("doc_id", aside.alias("held_out"), "score", "predicted")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    aside = toxicity.held_out(F.col("doc_id"))
    scored = toxicity.score_toxicity(docs, _read(spark, sf_dir, "labels").select("doc_id", "toxic"), aside)
    return scored.select("doc_id", aside.alias("held_out"), "score", "predicted")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation as a long, as contracted; beyond a long Spark raises an error, the operator itself goes on to 38 digits."""
    rows = whitening.whiten(_read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return rows.select("vec_id", *whitening.ADDED).withColumn("deviation", F.col("deviation").cast("long"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damaged_and_repaired(_read(spark, sf_dir, "conversations"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_language_id, op2_secret_scans, op3_sentence_pieces, op4_jaccard_join, op5_nearest, op6_mixing, op7_repeats, op8_top_k, op9_token_counts, op10_quality,
        op11_toxicity, op12_whitening, op13_conversation_repair,
    )
}

_MATCHES = r"""
SELECT id, '{kind}' AS kind, i, length(gaps[i]) AS gap, length(m[i]) AS size, v[i] AS value FROM (
  SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS m,
      regexp_extract_all(text, '{pattern}', {group}) AS v
    FROM docs WHERE regexp_matches(text, '{pattern}')))
"""
_ALL_MATCHES = "UNION ALL".join(
    _MATCHES.format(kind=kind, pattern=pattern.replace("'", "''"), group=group)
    for kind, pattern, group in (("assign", secrets.ASSIGN, 2), ("access", secrets.ACCESS, 0), ("hex", secrets.HEX, 0), ("bare", "[A-Za-z0-9+/_=-]{24,}", 0))
)

ORACLES = {
    "op2_secret_scans": f"""
WITH docs AS (SELECT doc_id AS id, coalesce(text, '') AS text, source FROM documents),
placed AS (
  SELECT *, sum(gap + size) OVER (PARTITION BY id, kind ORDER BY i) AS stop FROM ({_ALL_MATCHES})),
found AS (
  SELECT id, kind, stop - size AS start, stop, value, sha256(value) AS hash FROM placed
  WHERE length(value) >= CASE kind WHEN 'assign' THEN 8 WHEN 'access' THEN 16 WHEN 'hex' THEN 32 ELSE 24 END
    AND (kind <> 'bare' OR regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]'))),
held AS (SELECT hash, count(DISTINCT coalesce(source, chr(1))) AS owners, count(DISTINCT (coalesce(source, chr(1)), id)) AS repositories FROM found JOIN docs USING (id) GROUP BY hash),
judged AS (
  SELECT found.*, CASE WHEN owners >= 3 AND repositories >= 10 OR repositories >= 1000 THEN 'example'
    WHEN len(list_distinct(string_split(value, ''))) >= 7 AND length(value) >= 12 AND NOT regexp_matches(value,
      '(?i)example|sample|dummy|changeme|change_me|placeholder|your|xxxx|test|12345678|abcdef') THEN 'live' END AS verdict
  FROM found JOIN held USING (hash)),
spans AS (
  SELECT DISTINCT id, kind, start, stop FROM (
    SELECT id, kind, start, stop FROM judged WHERE kind <> 'bare'
    UNION ALL SELECT id, verdict, stop - length(value), stop FROM judged WHERE verdict IS NOT NULL)),
spelled AS (
  SELECT id, kind, start, stop, list_position(['assign', 'access', 'hex', 'live', 'example'], kind) AS place, kind || ':' || start || ':' || stop AS span FROM spans),
texts AS (
  SELECT id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(span, ',' ORDER BY start, place, stop) FILTER (place <= 3), '') AS base, string_agg(span, ',' ORDER BY start, place, stop) AS spans
  FROM spelled GROUP BY id)
SELECT docs.id AS doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN texts USING (id)
""",
    "op4_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
shingle AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingle a JOIN shingle b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least_id AS component_id
FROM sets JOIN (SELECT a, min(b) AS least_id FROM reach GROUP BY a) ON a = doc_id
""",
    "op6_mixing": """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(source, chr(1)) AS own, coalesce(length(text), 0) AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
total AS (SELECT own, sqrt(greatest(sum(size), 1)::DOUBLE) AS weight, (sum(size) // 65536 + 1)::BIGINT AS blocks FROM sized GROUP BY own),
every AS (
  SELECT list(own ORDER BY own) AS names, list(weight ORDER BY own) AS weights, list(blocks ORDER BY own) AS blocks,
    least(1125899906842624, 2305843009213693952 // (max(blocks) + count(*) + 2)) AS fine FROM total),
grain AS (
  SELECT names, blocks, list_transform(weights, lambda x: greatest(1, round(x / whole * fine)::BIGINT)) AS a
  FROM (SELECT *, list_reduce(weights, lambda x, y: x + y) AS whole FROM every WHERE len(names) > 0)),
plan AS (SELECT *, list_sum(a)::BIGINT AS w, range(1, len(names) + 1) AS each FROM grain),
run AS (
  SELECT 0::BIGINT AS t, list_transform(names, lambda x: 0::BIGINT) AS k, NULL::BIGINT AS pick, NULL::BIGINT AS slot, NULL::BIGINT AS block FROM plan
  UNION ALL
  SELECT now + 1, list_transform(each, lambda i: k[i] + CASE WHEN i = chosen THEN 1 ELSE 0 END), chosen, now, k[chosen] FROM (
    SELECT *, (list_min(list_transform(each, lambda i: CASE WHEN k[i] < blocks[i] AND (k[i] * w) // a[i] <= now
      THEN (((k[i] + 1) * w + a[i] - 1) // a[i])::HUGEINT * 1000000 + i END)) % 1000000)::BIGINT AS chosen
    FROM (
      SELECT *, greatest(t, list_min(list_transform(each, lambda i: CASE WHEN k[i] < blocks[i] THEN (k[i] * w) // a[i] END))) AS now
      FROM run, plan WHERE list_sum(k) < list_sum(blocks)))),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY own ORDER BY hash, k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS block_start FROM sized)
SELECT doc_id, source, run.block, (run.block * w) // a[pick] AS release, ((run.block + 1) * w + a[pick] - 1) // a[pick] AS deadline, slot, block_start
FROM placed CROSS JOIN plan JOIN run ON names[pick] = own AND run.block = block_start // 65536
""",
    "op8_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
}
