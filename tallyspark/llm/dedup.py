"""Exact dedup by skew-safe combining: local groups, salted digest groups, then salt winners.

Texts are equal when identical after replacing each run of ``[\\x20\\x09-\\x0D]`` by one space;
null counts as empty. Of equal texts the row with the smallest id stays. Each grouping stage keys
on the digest *and* the whole normalised text, so equal digests of different texts never merge:

1. each task merges its own copies (the map side of the first aggregation, salted by task),
2. a salt's groups merge, so a hot text meets in ``SALTS`` tasks and not in one,
3. the salts' winners merge to one row per text: smallest id and number of copies.

Rows then look up their group by digest alone, and by digest and text where a digest has several
texts. Spark splits the side of the documents in that join where one digest is hot.

Defined cases: null and empty texts are one group; a null id sorts after every other id and stays
null in ``keep_id`` only when the whole group has null ids; rows that repeat id and text are each
returned, and of them one is kept when no text column of another row tells them apart (``kept`` is
true for each row whose id is ``keep_id``); an empty table gives an empty result; other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.store import settle

# Parts that a hot text's groups are merged in before the last merge.
SALTS = 64
SPACES = "[\\x20\\x09-\\x0D]+"


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_groups(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per distinct normalised text: ``_digest, _text, keep_id, group_size``."""
    rows = docs.select(
        F.col(id_column).alias("_id"), normalized(F.col(text)).alias("_text"), (F.spark_partition_id() % SALTS).alias("_salt")
    ).withColumn("_digest", digest(F.col("_text")))
    salted = rows.groupBy("_digest", "_salt", "_text").agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return (
        salted.repartition("_digest")
        .groupBy("_digest", "_text")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )


def exact_dedup(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """Every row of ``docs`` by id: ``doc_id, keep_id, group_size, kept, digest``."""
    texts_of = F.count(F.lit(1)).over(Window.partitionBy("_digest"))
    groups = text_groups(docs, text, id_column, digest).withColumn("_texts", texts_of)
    # The text goes on only where its digest does not tell it apart.
    groups = settle(groups.withColumn("_text", F.when(F.col("_texts") > 1, F.col("_text"))))
    rows = docs.select(F.col(id_column).alias("doc_id"), normalized(F.col(text)).alias("_text")).withColumn(
        "_digest", digest(F.col("_text"))
    )
    single = groups.filter("_texts = 1").select("_digest", "keep_id", "group_size")
    result = ["doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), F.col("_digest").alias("digest")]
    found = rows.select("doc_id", "_digest").join(single, "_digest").select(*result)
    shared = groups.filter("_texts > 1").select("_digest", "_text", "keep_id", "group_size")
    if shared.isEmpty():
        return found
    return found.unionAll(rows.join(shared, ["_digest", "_text"]).select(*result))
