"""The training-data pipeline: quality, exact copies, near copies, secrets, packing.

Every stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame; all but the last return the
columns of ``documents``. ``run`` applies them one after the other, each over the written output of
the one before.

Defined cases: null and empty texts are scored, are one group of equal texts, are linked with no
near copy, hold no secret, and are packed as an end id; rows with a null id are never removed as
copies of others; repeated rows (same id and text) leave one; empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm import dedup, ngram_join, packing, quality, secret_scan
from tallyspark.llm.queries import QUALITY_THRESHOLD, documents, quality_model
from tallyspark.llm.store import settle


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality model rejects."""
    model = quality_model(spark, sf_dir, settle(quality.feature_table(docs)))
    return quality.keep_good(docs, model, QUALITY_THRESHOLD)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the least id stays."""
    gone = dedup.exact_dedup(docs).filter("not kept and doc_id is not null").select("doc_id", "digest")
    rows = docs.withColumn("_digest", dedup.sha256(dedup.normalized(F.col("text"))))
    same = (F.col("doc_id") == F.col("_gone_id")) & (F.col("_digest") == F.col("_gone_digest"))
    removed = gone.select(F.col("doc_id").alias("_gone_id"), F.col("digest").alias("_gone_digest")).distinct()
    left = rows.join(removed, same, "left_anti")
    # Rows that repeat id and text: the partitioning of the join serves this window too.
    order = Window.partitionBy("doc_id", "_digest").orderBy(F.lit(0))
    first = left.withColumn("_copy", F.row_number().over(order)).filter("_copy = 1 or doc_id is null")
    return first.select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document that names it stays."""
    groups = ngram_join.similar_groups(docs)
    gone = groups.filter("component_id != doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced in the text; documents stay, ``n_chars`` follows the text."""
    if "n_chars" not in docs.columns:
        return secret_scan.redact(docs)
    clean = secret_scan.redact(docs.withColumn("_length", F.length("text")))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    changed = F.when(F.length("text") != F.col("_length"), length).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left as sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Trained models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
