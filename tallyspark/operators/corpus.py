"""Text documents about breaks, events and flagged trading days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.expr import key_digest
from tallyspark.functions.frames import union_all

# Document types, titles, text templates and source tables.
BREAK_DOC = "RECONCILIATION_BREAK_SUMMARY"
EVENT_DOC = "EVENT_WINDOW_SUMMARY"
QUALITY_DOC = "TRADE_QUALITY_SUMMARY"
BREAK_TEXT = (
    "Reconciliation break for %s / %s on %s. Expected position was %.4f, "
    "reported position was %.4f, difference was %.4f. Break reason was %s. "
    "Root cause reason was %s."
)
EVENT_TEXT = (
    "Event-window metrics for %s (%s) for %s on %s. Pre-event return was %.6f, "
    "post-event return was %.6f, event-day return was %.6f. Position change around "
    "event was %.4f, exposure change was %.4f. Window completeness status was %s."
)
QUALITY_TEXT = (
    "Trade quality summary for %s / %s on %s. Detected %d quality flags with types [%s]. "
    "Trade count was %d, buy quantity was %.4f, sell quantity was %.4f. Flag details: %s."
)
UNKNOWN_EVENT_TYPE = "UNKNOWN_EVENT_TYPE"


def _document(
    rows: DataFrame,
    kind: str,
    *,
    key: Sequence[str],
    title: Sequence[Column],
    text: str,
    text_values: Sequence[Column],
    sources: Sequence[str],
    metadata: Mapping[str, Column],
) -> DataFrame:
    """Fill one document layout; columns the rows lack are null."""

    def own(name: str, type_name: str) -> Column:
        return (F.col(name) if name in rows.columns else F.lit(None)).cast(type_name).alias(name)

    entries = [part for name, value in metadata.items() for part in (F.lit(name), value.cast("string"))]
    return rows.select(
        key_digest(F.lit(kind), *[F.col(name).cast("string") for name in key]).alias("document_id"),
        F.lit(kind).alias("document_type"),
        own("account_id", "string"),
        own("security_id", "string"),
        own("position_date", "date"),
        own("event_date", "date"),
        F.concat_ws(" ", *title).alias("title"),
        F.format_string(text, *text_values).alias("text"),
        F.array(*[F.lit(source) for source in sources]).alias("source_tables"),
        F.create_map(*entries).alias("metadata"),
    )


def _columns(*names: str) -> list[Column]:
    return [F.col(name) for name in names]


def docs_breaks(breaks: DataFrame) -> DataFrame:
    """One document per break."""
    date = F.col("position_date").cast("string")
    entries = (
        "break_id",
        "break_reason_code",
        "root_cause_reason_code",
        "severity",
        "first_break_date",
        "days_since_first_break",
        "is_cascading_break",
    )
    return _document(
        breaks,
        BREAK_DOC,
        key=("account_id", "security_id", "position_date", "break_reason_code"),
        title=[
            F.lit("Reconciliation break"),
            F.col("account_id"),
            F.lit("/"),
            F.col("security_id"),
            F.lit("on"),
            date,
        ],
        text=BREAK_TEXT,
        text_values=[
            *_columns("account_id", "security_id"),
            date,
            *_columns("expected_position", "reported_position", "position_difference"),
            *_columns("break_reason_code", "root_cause_reason_code"),
        ],
        sources=["gold.reconciliation_breaks"],
        metadata={name: F.col(name) for name in entries},
    )


def docs_events(metrics: DataFrame, events: DataFrame) -> DataFrame:
    """One document per event window. An event id that repeats gives its lowest type."""
    lookup = (
        events.groupBy("event_id")
        .agg(F.min(F.struct("event_type", "event_summary")).alias("_event"))
    )
    kind = F.coalesce("_event.event_type", "event_type", F.lit(UNKNOWN_EVENT_TYPE))
    rows = metrics.join(lookup, "event_id", "left").withColumns(
        {
            "_kind": kind,
            "event_summary": F.col("_event.event_summary"),
            "window_completeness": F.when(F.col("is_full_window"), "FULL").otherwise("PARTIAL"),
        }
    )
    date = F.col("event_date").cast("string")
    measures = (
        "pre_event_return",
        "post_event_return",
        "event_day_return",
        "position_change_around_event",
        "exposure_change_around_event",
    )
    return _document(
        rows,
        EVENT_DOC,
        key=("event_id", "security_id", "event_date"),
        title=[
            F.lit("Event window"),
            F.col("event_id"),
            F.lit("for"),
            F.col("security_id"),
            F.lit("on"),
            date,
        ],
        text=EVENT_TEXT,
        text_values=[
            *_columns("event_id", "_kind", "security_id"),
            date,
            *_columns(*measures, "window_completeness"),
        ],
        sources=["gold.event_window_metrics", "silver.events_clean"],
        metadata={
            "event_id": F.col("event_id"),
            "event_type": F.col("_kind"),
            "window_completeness": F.col("window_completeness"),
            "event_summary": F.col("event_summary"),
            **{name: F.col(name) for name in measures},
        },
    )


def docs_trade_quality(flags: DataFrame, trades: DataFrame) -> DataFrame:
    """One document per account, security and date with flags.

    The sets collected per day hold flag types and their fixed descriptions, a
    handful whatever the number of flags.
    """
    keys = ["account_id", "security_id", "position_date"]
    flagged = flags.withColumnRenamed("flag_date", "position_date").groupBy(*keys).agg(
        F.concat_ws(", ", F.sort_array(F.collect_set("flag_type"))).alias("flag_types"),
        F.count(F.lit(1)).alias("flag_count"),
        F.concat_ws(" | ", F.sort_array(F.collect_set("description"))).alias("flag_descriptions"),
    )

    def total(side: str) -> Column:
        return F.sum(F.when(F.col("side") == side, F.col("quantity")).otherwise(0.0))

    traded = trades.withColumnRenamed("trade_date", "position_date").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trade_count"),
        total("BUY").alias("buy_quantity"),
        total("SELL").alias("sell_quantity"),
    )
    rows = flagged.join(traded, keys, "left").fillna(
        0, ["trade_count", "buy_quantity", "sell_quantity"]
    )
    date = F.col("position_date").cast("string")
    entries = ("flag_types", "flag_count", "trade_count", "buy_quantity", "sell_quantity")
    return _document(
        rows,
        QUALITY_DOC,
        key=keys,
        title=[
            F.lit("Trade quality flags"),
            F.col("account_id"),
            F.lit("/"),
            F.col("security_id"),
            F.lit("on"),
            date,
        ],
        text=QUALITY_TEXT,
        text_values=[
            *_columns("account_id", "security_id"),
            date,
            *_columns("flag_count", "flag_types", "trade_count", "buy_quantity", "sell_quantity"),
            F.col("flag_descriptions"),
        ],
        sources=["silver.trade_quality_flags", "silver.trades_clean"],
        metadata={name: F.col(name) for name in entries},
    )


def investigation_corpus(
    breaks: DataFrame, metrics: DataFrame, events: DataFrame, flags: DataFrame, trades: DataFrame
) -> DataFrame:
    return union_all(
        [docs_breaks(breaks), docs_events(metrics, events), docs_trade_quality(flags, trades)]
    )


def corpus_counts(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("document_type").count().orderBy("document_type")
