"""From raw documents to tokens: five stages, each of which works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.llm import bpe, mixing, pii, quality, simhash
from quern.llm.shared import Stage

#: Documents whose labels nothing is learned from, so that the classifier can be measured on them.
HELD_OUT = "crc32(CAST(doc_id AS STRING)) % 5 = 0"
#: Documents that score less are rejected.
LEAST_QUALITY = 0.3
#: Key of the pseudonyms here; a user gives a secret one.
PII_KEY = "demonstration key"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. Without any usable label all score one half and stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, "quality", HELD_OUT)
    return quality.scored(docs, model, "text", "__score").filter(F.col("__score") >= LEAST_QUALITY).drop("__score")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id.

    Rows that repeat an id and a text are one document and leave one row; rows with one id and different texts are
    different documents. A null id comes after all others. Ties are broken by hashes of the rows, so reruns agree.
    """
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    found = simhash.near_duplicates(keyed, "__key", "text", words=3, bits=3).distinct()
    own = keyed.select("__key", "doc_id").join(found.select(F.col("id").alias("__key"), "component"), "__key")
    first = own.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__key")).alias("__least"))
    rows = keyed.join(first.select(F.col("__least.__key")), "__key", "left_semi")
    order = W.partitionBy("__key").orderBy(F.xxhash64(*docs.columns))
    return rows.withColumn("__row", F.row_number().over(order)).filter("__row = 1").select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms in place of personal numbers, dates and addresses; their lengths follow."""
    found = pii.pseudonymised(docs, PII_KEY)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, once or twice."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and whether they decode to its text."""
    path = public_tokenizers.path(VOCABULARY)
    found = bpe.encoded(docs, path, public_tokenizers.PATTERN, make=bpe.ids_and_digests, schema=bpe.IDS_AND_DIGESTS)
    return found.withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", one_of_each_group),
    ("pii", without_personal_data),
    ("mixing", mixed),
    ("byte-level bpe", tokens),
]

#: Fitted models and links between fingerprints are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again."""
    stage = Stage(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES:
        out = work(spark, docs, sf_dir)
        docs = out if name == STAGES[-1][0] else stage.keep(out)
    return docs
