"""Evidence documents for questions: exact by metadata first, then the nearest texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.frames import top_rows, union_all
from tallyspark.operators.corpus import BREAK_DOC, EVENT_DOC, QUALITY_DOC
from tallyspark.operators.vectors import Search, knn_topk, parsed_source_tables, query_vectors
from tallyspark.sources.files import stored

# Order in which document types count as exact evidence.
TYPE_PRIORITY = {BREAK_DOC: 0, QUALITY_DOC: 1, EVENT_DOC: 2}
OTHER_PRIORITY = 99

FIELDS = ("account_id", "security_id", "target_date")


def has_all_fields() -> F.Column:
    return F.col("account_id").isNotNull() & F.col("security_id").isNotNull() & F.col("target_date").isNotNull()


def exact_metadata_evidence(parsed: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """Documents with the question's account, security and date, the first k by type
    and id. Documents are cut to k per key before they meet the questions."""
    priority = F.lit(OTHER_PRIORITY)
    for kind, rank in TYPE_PRIORITY.items():
        priority = F.when(F.col("document_type") == kind, rank).otherwise(priority)
    asked = parsed.filter(has_all_fields()).select("query_id", *FIELDS)
    dates = F.array_remove(F.array_distinct(F.array("position_date", "event_date")), "")
    keyed = (
        documents.select(
            "document_id",
            "account_id",
            "security_id",
            F.explode(dates).alias("target_date"),
            priority.alias("priority"),
        )
        .join(asked.select(*FIELDS).distinct(), list(FIELDS), "left_semi")
    )
    first = top_rows(keyed, FIELDS, [F.col("priority"), F.col("document_id")], k, "place")
    return asked.join(first, list(FIELDS)).select("query_id", "document_id", "place")


def security_evidence(parsed: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """For a question with a security but not all three fields: the first k documents
    of the security by id."""
    asked = parsed.filter(F.col("security_id").isNotNull() & ~has_all_fields()).select(
        "query_id", "security_id"
    )
    keyed = documents.select("document_id", "security_id").join(
        asked.select("security_id").distinct(), "security_id", "left_semi"
    )
    first = top_rows(keyed, ["security_id"], [F.col("document_id")], k, "place")
    return asked.join(first, "security_id").select("query_id", "document_id", "place")


EVIDENCE = "query_id string, document_id string, rank int, is_exact boolean"


def hybrid_evidence(
    parsed: DataFrame,
    documents: DataFrame | None,
    k: int = 5,
    order: str = "document_id",
    asked: DataFrame | None = None,
    search: Search | None = None,
) -> DataFrame:
    """Up to k documents per question: (query_id, document_id, rank, is_exact).

    Exact evidence first; a question it leaves short is filled from the nearest
    3k texts. The fill goes by document id; pass ``order="distance"`` to fill by
    nearness instead. ``asked`` (query_id, vector) are the questions' vectors from
    the model that made those of the documents; ``search`` is that of a stored index
    of the documents, and with it the exact evidence is stored once, as a search runs
    jobs of its own. Without a table of documents there is no evidence.
    """
    if documents is None:
        return parsed.sparkSession.createDataFrame([], EVIDENCE)
    exact = union_all(
        [exact_metadata_evidence(parsed, documents, k), security_evidence(parsed, documents, k)]
    )
    if search:
        exact = stored(exact)
    full = exact.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k)
    short = query_vectors(parsed.join(full, "query_id", "left_anti"), asked)
    nearest = search(short, 3 * k) if search else knn_topk(short, documents, 3 * k)
    fill_order = F.col("distance") if order == "distance" else F.lit(0.0)
    candidates = union_all(
        [
            exact.select("query_id", "document_id", F.lit(0).alias("tier"), F.col("place").cast("double").alias("key")),
            nearest.select("query_id", "document_id", F.lit(1).alias("tier"), fill_order.alias("key")),
        ]
    )
    # At most 4k rows per question from here on.
    best = candidates.groupBy("query_id", "document_id").agg(
        F.min(F.struct("tier", "key")).alias("_at")
    )
    ordered = Window.partitionBy("query_id").orderBy("_at.tier", "_at.key", "document_id")
    return (
        best.withColumn("rank", F.row_number().over(ordered))
        .filter(F.col("rank") <= k)
        .select("query_id", "document_id", "rank", (F.col("_at.tier") == 0).alias("is_exact"))
    )


DOCUMENT = (
    "document_id string, text string, document_type string, account_id string, security_id string, "
    "position_date string, event_date string, title string, source_tables string"
)


def evidence_documents(evidence: DataFrame, documents: DataFrame | None) -> DataFrame:
    """The evidence rows with the texts and metadata of their documents."""
    if documents is None:
        documents = evidence.sparkSession.createDataFrame([], DOCUMENT)
    return evidence.join(documents.drop("vector"), "document_id").withColumn(
        "source_tables", parsed_source_tables("source_tables")
    )
