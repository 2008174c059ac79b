"""The break table and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.expr import key_digest
from tallyspark.operators.positions import BREAK, CELL

# Note text per reason; any other reason takes the last text.
NOTES = {
    "POSITION_NOT_REPORTED": "No reported position exists for this account/security/date.",
    "SPLIT_ADJUSTMENT_BREAK": "Difference aligns with split-adjustment break flags on this date.",
    "DUPLICATE_TRADE": "Difference aligns with duplicate-trade flags on this date.",
    "LATE_ARRIVING_TRADE": "Difference aligns with late-arriving trade flags on this date.",
    "MISSING_PRICE": "Difference aligns with missing-price flags on this date.",
}
OTHER_NOTE = "Expected and reported quantities differ for this date."

# Absolute difference from which a break is HIGH or MEDIUM.
HIGH_FROM = 100
MEDIUM_FROM = 25


def reconciliation_breaks(positions: DataFrame) -> DataFrame:
    """The breaking rows with id, severity and note. An unreported break has no
    difference and is LOW."""
    size = F.abs("position_difference")
    severity = F.when(size >= HIGH_FROM, "HIGH").when(size >= MEDIUM_FROM, "MEDIUM").otherwise("LOW")
    notes = F.create_map(*[F.lit(part) for pair in NOTES.items() for part in pair])
    reason = F.col("break_reason_code")
    return positions.filter(F.col("reconciliation_status") == BREAK).select(
        key_digest(
            F.col("account_id"),
            F.col("security_id"),
            F.col("position_date").cast("string"),
            reason,
            F.col("root_cause_reason_code"),
        ).alias("break_id"),
        *CELL,
        "expected_position",
        "reported_position",
        "position_difference",
        "break_reason_code",
        "root_cause_reason_code",
        "first_break_date",
        "days_since_first_break",
        "is_cascading_break",
        severity.alias("severity"),
        F.coalesce(notes[reason], F.lit(OTHER_NOTE)).alias("investigation_notes"),
        *[name for name in ("_gold_processed_at",) if name in positions.columns],
    )


def break_summary(positions: DataFrame) -> DataFrame:
    """Row counts in total, by status, and of the breaks by reason and by root cause."""
    is_break = F.col("reconciliation_status") == BREAK
    counted = positions.groupBy(
        "reconciliation_status",
        F.when(is_break, F.col("break_reason_code")).alias("reason"),
        F.when(is_break, F.col("root_cause_reason_code")).alias("root"),
    ).agg(F.count(F.lit(1)).alias("rows"))
    measures = {
        "total": F.lit("ALL"),
        "status": F.col("reconciliation_status"),
        "break_reason": F.col("reason"),
        "root_cause": F.col("root"),
    }
    views = F.array(
        *[
            F.struct(F.lit(measure).alias("measure"), value.alias("value"))
            for measure, value in measures.items()
        ]
    )
    return (
        counted.withColumn("view", F.explode(views))
        .filter(F.col("view.value").isNotNull())
        .groupBy("view.measure", "view.value")
        .agg(F.sum("rows").alias("rows"))
        .orderBy("measure", "value")
    )
