"""The registered queries of the numbered operators, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import (
    bpe, divergence, edit_embedding, hnsw, license_scan, merkle, mixing, packing, parity_join, secret_scan, token_counts, tool_calls, toxicity)
from starmill.llm import merkle_sql
from starmill.llm.texts import documents, table
from starmill.queries.base import Registry

REGISTRY = Registry()
query = REGISTRY.add

TOKEN_LIMIT = 512
MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
RANKS, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
SPECIAL = {"<|endoftext|>": 50256}  # fixed value: the special token of that tokenizer


@query("op1_byte_bpe")
def byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    done = bpe.encode(documents(spark, root), public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query("op2_edit_fingerprints")
def edit_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    return edit_embedding.with_edits(documents(spark, root)).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        "near_edited_bands", "near_next_bands")


REPLY = {"reply": {"text": ("STRING", True), "turn": ("BIGINT", True)}}


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """Each user turn as a call of ``reply`` that comes after the one before it, each assistant turn as the result of the turn before."""
    name = lambda back: F.concat_ws(":", "conv_id", (F.col("turn") - back).cast("string"))
    call = F.struct(F.array(F.struct(
        name(0).alias("id"), F.lit("reply").alias("name"), F.struct("text", "turn").alias("arguments"),
        F.array(name(2)).alias("after"))).alias("tool_calls"))
    result = F.struct(name(1).alias("tool_call_id"), F.col("text").alias("content"))
    return conversations.select(
        "conv_id", "turn", F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool")
        .otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", F.to_json(call)).when(F.col("role") == "assistant", F.to_json(result))
        .otherwise(F.col("text")).alias("text"))


@query("op3_tool_calls", """
    WITH RECURSIVE calls AS (
      SELECT conv_id, turn, text, conv_id || ':' || turn AS call_id FROM conversations
      WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL),
    results AS (
      SELECT conv_id, turn, text, conv_id || ':' || (turn - 1) AS call_id FROM conversations
      WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL),
    levels AS (
      SELECT conv_id, turn, 0 AS level FROM calls c
      WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
      UNION ALL
      SELECT c.conv_id, c.turn, l.level + 1 FROM levels l JOIN calls c ON c.conv_id = l.conv_id AND c.turn = l.turn + 2)
    SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS turn,
           CASE WHEN c.call_id IS NOT NULL THEN 0 END::INT AS place, coalesce(c.call_id, r.call_id) AS call_id,
           CASE WHEN c.call_id IS NOT NULL THEN 'reply' END AS name, l.level::INT AS level,
           CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'open' ELSE 'linked' END AS status,
           CASE WHEN c.call_id IS NOT NULL THEN CASE WHEN c.text IS NULL THEN 'missing:text' ELSE '' END END AS errors,
           r.turn AS result_turn,
           '{' || concat_ws(',',
             CASE WHEN c.call_id IS NOT NULL THEN '"arguments":{' || coalesce('"text":' || to_json(c.text) || ',', '')
               || '"turn":' || c.turn || '}' END,
             '"id":' || to_json(coalesce(c.call_id, r.call_id)),
             CASE WHEN c.call_id IS NOT NULL THEN '"name":"reply"' END,
             '"result":' || to_json(r.text)) || '}' AS call_json
    FROM calls c LEFT JOIN levels l USING (conv_id, turn) FULL JOIN results r ON r.call_id = c.call_id
""")
def linked_calls(spark: SparkSession, root: str) -> DataFrame:
    return tool_calls.link(as_tool_messages(table(spark, root, "conversations")), REPLY)


@query("op4_secret_scan")
def secrets(spark: SparkSession, root: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, root))
    spans = F.col("spans")
    return found.select(
        "doc_id", *(secret_scan.count_kind(spans, k).alias(f"n_{k}") for k in secret_scan.BASE_KINDS),
        F.sha2(secret_scan.listed(spans, secret_scan.BASE_KINDS), 256).alias("base_sha256"),
        secret_scan.listed(spans, secret_scan.KINDS).alias("spans"))


@query("op5_license_scan", license_scan.report_sql())
def licenses(spark: SparkSession, root: str) -> DataFrame:
    return license_scan.report(license_scan.scan(documents(spark, root)))


@query("op6_hnsw", """
    WITH v AS (
      SELECT vec_id, label, embedding, row_number() OVER () AS n FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    w AS (SELECT *, embedding::DOUBLE[64] AS e FROM v),
    link AS (SELECT a.n AS a, b.n AS b FROM w a JOIN w b ON a.label = b.label AND a.n <> b.n
             WHERE array_cosine_similarity(a.e, b.e) >= 0.93),
    reach AS (
      WITH RECURSIVE r (n, m) AS (
        SELECT n, n FROM v UNION SELECT r.n, link.b FROM r JOIN link ON link.a = r.m)
      SELECT r.n, min(w.vec_id) AS component_id FROM r JOIN w ON w.n = r.m GROUP BY r.n),
    counts AS (SELECT a AS n, count(*) AS n_links FROM link GROUP BY a)
    SELECT v.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
    FROM v JOIN reach USING (n) LEFT JOIN counts USING (n)
    UNION ALL
    SELECT vec_id, 0::BIGINT, vec_id, true FROM embeddings
    WHERE vec_id IS NULL OR label IS NULL OR embedding IS NULL
      OR len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0
      OR len(list_filter(embedding, lambda x: x <> 0)) = 0
""")
def embedding_duplicates(spark: SparkSession, root: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, root, "embeddings"))


@query("op7_parity_join")
def near_copies(spark: SparkSession, root: str) -> DataFrame:
    return parity_join.join(documents(spark, root)).select("doc_id", "n_shingles", "component_id")


@query("op8_swap_packing")
def swap_packing(spark: SparkSession, root: str) -> DataFrame:
    pieces = packing.tokenise(documents(spark, root), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, SPECIAL)
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text modulo 5; 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model | None:
    labels = labels.filter(fold() != 0)
    return toxicity.fit(toxicity.sample(docs, labels), toxicity.shares(labels))


@query("op9_toxicity")
def toxic(spark: SparkSession, root: str) -> DataFrame:
    docs = documents(spark, root)
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, root, "labels")))
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_token_counts")
def count_tokens(spark: SparkSession, root: str) -> DataFrame:
    counts = token_counts.count_tokens(documents(spark, root), public_tokenizers.path(TOKENIZER))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op11_entropy_mix")
def entropy_mix(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(documents(spark, root))


@query("op12_source_divergence", """
    WITH docs AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        coalesce(text, '') AS text FROM documents),
    words AS (SELECT k, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT k) >= 3),
    langs AS (SELECT lang, sum(n)::HUGEINT AS n, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL),
    chances AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + 1000000000 * (coalesce(c.n, 0) + 1) // (coalesce(t.n, 0) + l.v) AS p,
        1 + 1000000000 * (k.n + 1) // (l.n + l.v) AS q
      FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
      LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
      LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::BIGINT AS value
      FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
      LEFT JOIN chances x ON x.lang = a.lang AND x.source = a.source
      LEFT JOIN chances y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
    terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM chances WHERE n > 0 AND p > q),
    ranks AS (SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
      UNION ALL
      SELECT *, 'term' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms
      QUALIFY rank <= 200)
    SELECT lang, source, part, item, value, rank FROM ranks
""")
def source_divergence(spark: SparkSession, root: str) -> DataFrame:
    return divergence.audit(documents(spark, root))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op13_merkle_manifest", merkle_sql.report())
def merkle_manifest(spark: SparkSession, root: str) -> DataFrame:
    rows = documents(spark, root).select(*merkle.FIELDS)
    wanted = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    changed = F.when(wanted, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    rows = rows.select("doc_id", "lang", merkle.leaf().alias("leaf"),
                       F.when(wanted, merkle.leaf(text=changed)).otherwise(merkle.leaf()).alias("tampered"))
    found = merkle.manifest(rows, "lang", ["doc_id"], "leaf", ["doc_id", "tampered"])
    folded = merkle.fold(F.col("tampered"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = REGISTRY.queries
ORACLES = REGISTRY.oracles
