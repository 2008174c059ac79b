"""Answers to whole tables of questions about breaks.

Each lookup first cuts its table to the few rows a key may return and only then
joins the questions, so a key that many rows share never multiplies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.expr import python_text
from tallyspark.functions.frames import calendar_of, top_rows
from tallyspark.operators.evidence import FIELDS, evidence_documents, has_all_fields, hybrid_evidence
from tallyspark.operators.vectors import Search

FLAG_LIMIT = 20
EVENT_LIMIT = 10
EVENT_DAYS = 5
ANY = "*"

# What each part of a packet holds.
BREAK_FIELDS = (
    "account_id",
    "security_id",
    "position_date",
    "expected_position",
    "reported_position",
    "position_difference",
    "break_reason_code",
    "root_cause_reason_code",
    "severity",
)
FLAG_FIELDS = (
    "flag_type",
    "account_id",
    "security_id",
    "flag_date",
    "severity",
    "description",
    "affected_entity",
    "affected_record_id",
)
EVENT_FIELDS = (
    "event_id",
    "security_id",
    "event_date",
    "event_type",
    "event_summary",
    "pre_event_return",
    "post_event_return",
    "event_day_return",
    "position_change_around_event",
    "exposure_change_around_event",
    "is_full_window",
)
EVIDENCE_FIELDS = (
    "document_id",
    "document_type",
    "account_id",
    "security_id",
    "position_date",
    "event_date",
    "title",
    "text",
    "source_tables",
    "rank",
)

# Texts of a packet.
FOUND_SUMMARY = (
    "Structured break found and used as primary evidence. For %s / %s on %s, expected position was "
    "%s, reported position was %s, and difference was %s. Break reason is %s with root cause %s and "
    "severity %s."
)
MISSING_SUMMARY = (
    "Structured break not found for parsed fields; investigation relies on retrieved evidence "
    "and any available quality/event context."
)
MISSING_NOTES = {
    "account_id": "account_id not found in query; structured filters are partial.",
    "security_id": "security_id not found in query; structured filters are partial.",
    "target_date": "date not found in query; structured filters are partial.",
    "structured_break": "structured break not found for parsed account/security/date.",
    "quality_flags": "no matching trade quality flags found.",
    "event_context": "no nearby event-window context found for parsed security/date.",
    "retrieved_evidence": "retrieval returned no evidence documents.",
}
CONFIDENCE_NOTES = (
    "Deterministic workflow: regex parsing + direct parquet lookups + vector retrieval.",
    "No LLM generation used; output is template-based.",
)
EXACT_NOTE = "Exact metadata-filtered evidence found."
FALLBACK_NOTE = "Semantic retrieval fallback used."
HIGHER_NOTE = "Confidence higher because exact structured break row was found."
LOWER_NOTE = "Confidence lower because no exact structured break row was found."


def parse_query(queries: DataFrame) -> DataFrame:
    """First account, security and ISO date named in each question; null where none."""

    def first(pattern: str) -> Column:
        found = F.regexp_extract("query", rf"(?i)\b({pattern})\b", 1)
        return F.upper(F.nullif(found, F.lit("")))

    return queries.withColumns(
        {
            "account_id": first(r"ACC\d{3}"),
            "security_id": first(r"SEC\d{3}"),
            "target_date": first(r"\d{4}-\d{2}-\d{2}"),
        }
    )


def stringify_rows(df: DataFrame, *kept: str) -> DataFrame:
    """Every column as the text Python shows for it; null stays null."""
    types = dict(df.dtypes)
    return df.select(
        *[
            F.col(name) if name in kept else python_text(F.col(name), types[name]).alias(name)
            for name in df.columns
        ]
    )


def lookup_break(parsed: DataFrame, breaks: DataFrame) -> DataFrame:
    """The break on the question's account, security and date; needs all three.

    Of several the lowest break id counts, then the lowest reported position.
    """
    asked = parsed.filter(has_all_fields()).select(
        "query_id", "account_id", "security_id", F.try_to_date("target_date").alias("position_date")
    )
    keys = ["account_id", "security_id", "position_date"]
    order = [F.col("break_id"), F.col("reported_position").asc_nulls_first()]
    # The days asked about are known before the scan: other days' folders are not read.
    of_days = breaks.filter(F.array_contains(calendar_of(asked, "position_date"), F.col("position_date")))
    wanted = of_days.join(asked.select(*keys).distinct(), keys, "left_semi")
    first = top_rows(wanted, keys, order, 1, "_place")
    return asked.join(first, keys).select("query_id", *BREAK_FIELDS)


def lookup_flags(parsed: DataFrame, flags: DataFrame, limit: int = FLAG_LIMIT) -> DataFrame:
    """Flags that agree with whichever fields a question names, the first by type and id.

    A field the question leaves out matches everything. Questions are told apart by
    the fields they name; for each such mask that occurs, flags are matched on just
    those fields, the others left null.
    """
    date = F.try_to_date("target_date")
    unusable = F.col("target_date").isNotNull() & date.isNull()
    fields = {"account_id": F.col("account_id"), "security_id": F.col("security_id"), "flag_date": date}
    asked = parsed.filter(~unusable).select("query_id", *[value.alias(f"_{name}") for name, value in fields.items()])
    keys = [f"_{name}" for name in fields]

    def mask() -> Column:
        bits = [F.when(F.col(key).isNotNull(), 1 << bit).otherwise(0) for bit, key in enumerate(keys)]
        return sum(bits[1:], bits[0])

    masked = asked.withColumn("_mask", mask())
    # At most eight numbers, whatever the questions.
    masks = masked.agg(F.collect_set("_mask")).scalar()
    # Where every question names a day, other days' folders are not read.
    undated = masked.agg(F.coalesce(F.max(F.col("_flag_date").isNull()), F.lit(False))).scalar()
    of_days = F.array_contains(calendar_of(masked, "_flag_date"), F.col("flag_date"))
    keyed = flags.filter(undated | of_days).withColumn("_mask", F.explode(masks)).withColumns(
        {
            f"_{name}": F.when(F.col("_mask").bitwiseAND(F.lit(1 << bit)) != 0, F.col(name))
            for bit, name in enumerate(fields)
        }
    )
    wanted = masked.select("_mask", *keys).distinct()
    same = [F.col(f"f.{key}").eqNullSafe(F.col(f"q.{key}")) for key in ("_mask", *keys)]
    keyed = keyed.alias("f").join(wanted.alias("q"), same, "left_semi")
    first = top_rows(keyed, ["_mask", *keys], [F.col("flag_type"), F.col("flag_id")], limit, "rank")
    same = [F.col(f"f.{key}").eqNullSafe(F.col(f"q.{key}")) for key in ("_mask", *keys)]
    return masked.alias("q").join(first.alias("f"), same).select(
        "q.query_id", "f.rank", *[f"f.{name}" for name in FLAG_FIELDS]
    )


def lookup_event_context(
    parsed: DataFrame, metrics: DataFrame, events: DataFrame, limit: int = EVENT_LIMIT
) -> DataFrame:
    """Event windows of the question's security, within five calendar days of its date
    if it names one; the first by date and event id."""
    detail = events.groupBy("event_id", "security_id", "event_date").agg(
        F.min(F.struct("event_type", "event_summary")).alias("_event")
    )
    described = metrics.join(detail, ["event_id", "security_id", "event_date"], "left").withColumns(
        {
            "event_type": F.coalesce("_event.event_type", "event_type"),
            "event_summary": F.col("_event.event_summary"),
        }
    )
    about = parsed.filter("security_id is not null").withColumn("_day", F.try_to_date("target_date"))
    offsets = F.explode(F.sequence(F.lit(-EVENT_DAYS), F.lit(EVENT_DAYS)))
    dated = (
        about.filter("_day is not null")
        .select("query_id", "security_id", "_day", offsets.alias("_offset"))
        .select("query_id", "security_id", F.date_add("_day", F.col("_offset")).alias("event_date"))
    )
    undated = about.filter("target_date is null").select("query_id", "security_id")

    by_id = [F.col("event_id")]
    by_date = [F.col("event_date").asc_nulls_first(), F.col("event_id")]

    def first(asked: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
        wanted = described.join(asked.select(*keys).distinct(), keys, "left_semi")
        cut = top_rows(wanted, keys, order, limit, "_place").select(*EVENT_FIELDS)
        return asked.join(cut, keys).select("query_id", *EVENT_FIELDS)

    found = first(dated, ["security_id", "event_date"], by_id).unionByName(
        first(undated, ["security_id"], by_date)
    )
    return top_rows(found, ["query_id"], by_date, limit, "rank")


def _listed(rows: DataFrame, fields: tuple[str, ...], name: str) -> DataFrame:
    """The ranked rows of each question as one short array."""
    item = F.struct(F.col("rank").alias("_rank"), F.struct(*fields).alias("item"))
    return rows.groupBy("query_id").agg(
        F.transform(F.sort_array(F.collect_list(item)), lambda pair: pair["item"]).alias(name)
    )


def _notes(conditions: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(when, F.lit(text)) for when, text in conditions]))


def investigation_packet(
    queries: DataFrame,
    breaks: DataFrame,
    flags: DataFrame,
    metrics: DataFrame,
    events: DataFrame,
    documents: DataFrame | None,
    k: int = 5,
    asked: DataFrame | None = None,
    search: Search | None = None,
) -> DataFrame:
    """One packet per question: summary, structured break, flags, event context,
    evidence, and notes on confidence and missing data. Without a table of
    documents the evidence is empty; ``asked`` (query_id, vector) are the
    questions' vectors from the model that made those of the documents, ``search``
    that of a stored index of the documents."""
    parsed = parse_query(queries)
    found_breaks = stringify_rows(lookup_break(parsed, breaks), "query_id")
    found_flags = stringify_rows(lookup_flags(parsed, flags), "query_id", "rank")
    found_events = stringify_rows(lookup_event_context(parsed, metrics, events), "query_id", "rank")
    evidence = hybrid_evidence(parsed, documents, k, asked=asked, search=search)
    parts = [
        found_breaks.select("query_id", F.struct(*BREAK_FIELDS).alias("structured_break")),
        _listed(found_flags, FLAG_FIELDS, "quality_flags"),
        _listed(found_events, EVENT_FIELDS, "event_context"),
        _listed(evidence_documents(evidence, documents), EVIDENCE_FIELDS, "retrieved_evidence"),
        evidence.groupBy("query_id").agg(F.max("is_exact").alias("_exact")),
    ]
    joined = reduce(lambda left, right: left.join(right, "query_id", "left"), parts, parsed)
    has_break = F.col("structured_break").isNotNull()
    shown = [F.coalesce(F.col(f"structured_break.{name}"), F.lit("None")) for name in BREAK_FIELDS]
    lists = ("quality_flags", "event_context", "retrieved_evidence")
    missing = [
        (F.col(name).isNull() | (F.size(name) == 0) if name in lists else F.col(name).isNull(), text)
        for name, text in MISSING_NOTES.items()
    ]
    exact = F.coalesce("_exact", F.lit(False))
    confidence = [(F.lit(True), text) for text in CONFIDENCE_NOTES] + [
        (exact, EXACT_NOTE),
        (~exact, FALLBACK_NOTE),
        (has_break, HIGHER_NOTE),
        (~has_break, LOWER_NOTE),
    ]
    return joined.select(
        "query_id",
        "query",
        *FIELDS,
        F.when(has_break, F.format_string(FOUND_SUMMARY, *shown))
        .otherwise(F.lit(MISSING_SUMMARY))
        .alias("summary"),
        "structured_break",
        *lists,
        F.transform("retrieved_evidence", lambda row: row["title"]).alias("retrieved_evidence_titles"),
        _notes(confidence).alias("confidence_notes"),
        _notes(missing).alias("missing_data_notes"),
    )
