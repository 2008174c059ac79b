"""How well each investigation packet is supported by what was found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.corpus import BREAK_DOC, QUALITY_DOC
from tallyspark.operators.evidence import has_all_fields
from tallyspark.operators.investigation import BREAK_FIELDS

# Recommendation per lowest score, best first.
RECOMMENDATIONS = (
    (0.8, "Investigation packet is well grounded in structured and retrieved evidence."),
    (0.6, "Investigation packet is usable, but review missing support before relying on summary."),
    (0.0, "Investigation packet needs manual review because grounding support is incomplete."),
)
EVIDENCE_CLAIMS = (
    "account_id",
    "security_id",
    "position_date",
    "event_date",
    "document_type",
    "title",
)


def _any(name: str, test) -> Column:
    return F.coalesce(F.exists(F.col(name), test), F.lit(False))


def _size(name: str) -> Column:
    return F.coalesce(F.size(name), F.lit(0))


def _not_empty(name: str) -> Column:
    return F.coalesce(F.size(name) > 0, F.lit(False))


def eval_break_found(packets: DataFrame) -> DataFrame:
    """The packet's break has the very key the question names."""
    found = F.col("structured_break")
    same = (
        (found["account_id"] == F.col("account_id"))
        & (found["security_id"] == F.col("security_id"))
        & (found["position_date"] == F.col("target_date"))
    )
    return packets.withColumn("structured_break_found", F.coalesce(same, F.lit(False)))


def _matches(row: Column) -> Column:
    target = F.col("target_date")
    return (
        (row["account_id"] == F.col("account_id"))
        & (row["security_id"] == F.col("security_id"))
        & ((row["position_date"] == target) | (row["event_date"] == target))
    )


def eval_exact_evidence(packets: DataFrame) -> DataFrame:
    """Evidence with the question's account, security and date, and its document ids."""
    ids = F.transform(F.filter("retrieved_evidence", _matches), lambda row: row["document_id"])
    none = F.array().cast("array<string>")
    return packets.withColumn(
        "matching_document_ids", F.coalesce(F.when(has_all_fields(), ids), none)
    ).withColumn("exact_evidence_found", F.size("matching_document_ids") > 0)


def eval_type_coverage(packets: DataFrame) -> DataFrame:
    """A break asks for a break document, flags ask for a quality document."""
    types = F.transform("retrieved_evidence", lambda row: row["document_type"])

    def has(kind: str) -> Column:
        return F.coalesce(F.array_contains(types, kind), F.lit(False))

    needs_break, needs_quality = F.col("structured_break").isNotNull(), _not_empty("quality_flags")
    return packets.withColumn(
        "evidence_type_coverage",
        (~needs_break | has(BREAK_DOC)) & (~needs_quality | has(QUALITY_DOC)),
    )


def eval_missing_data(packets: DataFrame) -> DataFrame:
    """Passes only without event context and with notes on what is missing."""
    return packets.withColumn(
        "missing_data_coverage", ~_not_empty("event_context") & _not_empty("missing_data_notes")
    )


def eval_claim_risk(packets: DataFrame) -> DataFrame:
    """HIGH without any support; LOW when a supported value occurs in the summary."""
    summary, found = F.col("summary"), F.col("structured_break")

    def occurs(value: Column) -> Column:
        return (value != "") & F.contains(summary, value)

    # A missing value of a break reads None, as in the summary.
    claims = F.array(*[F.coalesce(found[name], F.lit("None")) for name in BREAK_FIELDS])
    from_break = F.exists(claims, occurs)

    def in_row(row: Column) -> Column:
        return F.exists(F.array(*[F.coalesce(row[name], F.lit("")) for name in EVIDENCE_CLAIMS]), occurs)

    nothing = found.isNull() & ~_not_empty("retrieved_evidence")
    supported = F.when(found.isNotNull(), from_break).otherwise(_any("retrieved_evidence", in_row))
    return packets.withColumn(
        "unsupported_claim_risk",
        F.when(nothing & (summary != ""), "HIGH").when(supported, "LOW").otherwise("MEDIUM"),
    )


def groundedness(packets: DataFrame) -> DataFrame:
    """All checks, the share that passes and what to do with the packet."""
    checked = packets
    for check in (
        eval_break_found,
        eval_exact_evidence,
        eval_type_coverage,
        eval_missing_data,
        eval_claim_risk,
    ):
        checked = check(checked)
    passed = [
        F.col("structured_break_found"),
        F.col("exact_evidence_found"),
        F.col("evidence_type_coverage"),
        F.col("missing_data_coverage"),
        F.col("unsupported_claim_risk") == "LOW",
    ]
    score = F.round(sum((test.cast("int") for test in passed), F.lit(0)) / len(passed), 2)
    advice = F.lit(RECOMMENDATIONS[-1][1])
    for lowest, text in reversed(RECOMMENDATIONS[:-1]):
        advice = F.when(F.col("groundedness_score") >= lowest, text).otherwise(advice)
    types = F.array_sort(F.array_distinct(F.transform("retrieved_evidence", lambda r: r["document_type"])))
    return (
        checked.withColumn("groundedness_score", score)
        .withColumn("recommendation", advice)
        .select(
            "query_id",
            "query",
            "account_id",
            "security_id",
            "target_date",
            "structured_break_found",
            "exact_evidence_found",
            "matching_document_ids",
            "evidence_type_coverage",
            F.coalesce(types, F.array().cast("array<string>")).alias("retrieved_types"),
            "missing_data_coverage",
            _size("event_context").alias("event_context_count"),
            _size("missing_data_notes").alias("missing_data_notes_count"),
            "groundedness_score",
            "unsupported_claim_risk",
            "recommendation",
        )
    )
