"""One query for each operator over its whole table, with the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import bpe, dialogue, lines, merkle, mixing, mtree, pii, quality, recompress, reference_sql, rules, sharding, simhash, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Held-out documents: those that no label is learned from.
HELD_OUT = "crc32(CAST(doc_id AS STRING)) % 5 = 0"


@query
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"), "quality", HELD_OUT)
    found = quality.scores(docs, model).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id",
        F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=3, bits=3)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The probability of each category, the last being ``toxic`` as labels mark it, and what follows from it."""
    docs = table(spark, folder, "documents")
    models = toxicity.fit(docs, table(spark, folder, "labels"), "toxic", HELD_OUT)
    found = toxicity.probabilities(docs, models, ["insult_mind", "insult_worth", "toxic"])
    return found.select(
        F.col("id").alias("doc_id"), "insult_mind", "insult_worth", F.col("toxic").alias("score"),
        (F.col("toxic") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return found.withColumnRenamed("id", "doc_id")


@query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.shards_by_bytes(table(spark, folder, "documents"), 24)
    return found.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix(table(spark, folder, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.judged(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior",
    )


#: Key of the pseudonyms in these queries; a user gives a secret one.
PII_KEY = "demonstration key"


@query
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.pseudonymised(docs, PII_KEY, found_col="found")
    return found.select("doc_id", "text", F.size("found").cast("long").alias("n_replaced"), *[
        c.alias(n) for n, c in pii.counts_by_kind("found").items()
    ])


@query
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return recompress.digests(table(spark, folder, "documents"), 20).withColumnRenamed("id", "doc_id")


@query
def op1_mtree_topk(spark: SparkSession, folder: str) -> DataFrame:
    found = mtree.top_k(table(spark, folder, "embeddings"), "id % 20 = 0", k=20, scale=64.0)
    return found.withColumnRenamed("id", "vec_id")


@query
def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.digests(table(spark, folder, "documents"), least_chars=20, documents=3)


ORACLES["op11_line_dedup"] = """
WITH line AS (
    SELECT doc_id, place, lines[place] AS line,
           translate(trim(lines[place], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS place
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents) AS s) AS e
), shared AS (
    SELECT key, max(doc_id) AS last FROM line WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT l.doc_id, count(*) AS n_lines, count(s.key) FILTER (l.doc_id <> s.last) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.place)
                       FILTER (s.key IS NULL OR l.doc_id = s.last), '')) AS kept_sha256
FROM line l LEFT JOIN shared s ON l.key = s.key
GROUP BY l.doc_id
"""


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage that a checksum of conversation and turn decides; dropped ones name their conversation only."""
    rows = dialogue.present(conversations)
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")])
    kind = F.crc32(named.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (kind != 0).alias("here"), F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
    ).drop("col")


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return dialogue.summaries(damaged(table(spark, folder, "conversations")))


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents; where 3 divides the checksum of an id, the text is tampered with before it is verified."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", lines.UPPER, lines.LOWER)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.select(
        F.col("lang").alias("group"), F.col("doc_id").cast("long").alias("id"), merkle.leaf(*values, F.col("text")).alias("leaf"),
        F.when(tampered, merkle.leaf(*values, lowered)).alias("other"),
    )
    found = merkle.Manifest.of(rows).proofs(other_col="other")
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


ORACLES["op12_conversation_repair"] = reference_sql.conversation_repair()
ORACLES["op13_merkle_manifest"] = reference_sql.merkle_manifest()
ORACLES["op1_mtree_topk"] = """
WITH good AS (
    SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM good q JOIN good c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
