"""Raw record schemas, and the registry of ledger tables."""

from __future__ import annotations

from dataclasses import dataclass

# Column names and types of the raw records.
RAW_SCHEMAS = {
    "securities": (
        "security_id string, ticker string, company_name string, exchange string, "
        "sector string, is_active boolean"
    ),
    "prices": (
        "security_id string, price_date string, open_price double, high_price double, "
        "low_price double, close_price double, volume long"
    ),
    "corporate_actions": (
        "corporate_action_id string, security_id string, action_type string, "
        "effective_date string, split_ratio double, description string"
    ),
    "starting_positions": (
        "account_id string, security_id string, position_date string, quantity double"
    ),
    "trades": (
        "trade_id string, account_id string, security_id string, side string, quantity double, "
        "execution_price double, trade_date string, settlement_date string, "
        "event_timestamp string, ingestion_timestamp string, source_system string"
    ),
    "reported_positions": (
        "account_id string, security_id string, position_date string, "
        "reported_quantity double, source_system string"
    ),
    "filing_events": (
        "event_id string, security_id string, event_date string, event_type string, "
        "event_summary string"
    ),
    "injected_issues_manifest": (
        "issue_id string, issue_type string, affected_entity string, affected_record_id string, "
        "account_id string, security_id string, trade_id string, issue_date string, "
        "expected_detection_category string, short_description string"
    ),
}

CORRUPT_RECORD = "_corrupt_record"


@dataclass(frozen=True)
class TableSpec:
    """One raw dataset and where it goes in each layer (paths below the lake root)."""

    name: str
    raw: str
    bronze: str
    silver: str | None

    @property
    def schema(self) -> str:
        return f"{RAW_SCHEMAS[self.name]}, {CORRUPT_RECORD} string"


def _spec(name: str, silver: str | None, raw_folder: str | None = None) -> TableSpec:
    return TableSpec(
        name=name,
        raw=f"raw/{raw_folder or name}",
        bronze=f"bronze/{name}",
        silver=f"silver/{silver}" if silver else None,
    )


TABLES = {
    spec.name: spec
    for spec in (
        _spec("securities", "securities_clean"),
        _spec("prices", "prices_clean"),
        _spec("corporate_actions", "corporate_actions_clean"),
        _spec("starting_positions", "starting_positions_clean"),
        _spec("trades", "trades_clean"),
        _spec("reported_positions", "reported_positions_clean"),
        _spec("filing_events", "events_clean"),
        _spec("injected_issues_manifest", None, raw_folder="manifest"),
    )
}

# Lines that are no records, one table for each dataset that has some.
QUARANTINE = "bronze/quarantine"

SPLIT_FACTORS = "silver/split_factors"
SILVER_FLAGS = "silver/trade_quality_flags"
SILVER_EVENTS = ("silver/events_clean", "silver/filing_events_clean")
GOLD_POSITIONS = "gold/position_reconstruction"
GOLD_BREAKS = "gold/reconciliation_breaks"
GOLD_EVENT_WINDOWS = "gold/event_window_metrics"
CORPUS = "retrieval/investigation_corpus"
VECTORS = "retrieval/vectors"
VECTOR_INDEX = "retrieval/vector_index"


@dataclass(frozen=True)
class Layout:
    """How a stored table is laid out: a folder per value of one column, rows in order within a file.

    The columns are fixed, so an empty table and one with only null dates read back as well.
    """

    partition_by: str
    cluster_by: tuple[str, ...]
    columns: str


_CELL = "account_id string, security_id string, position_date date"
_CAUSE = (
    "break_reason_code string, root_cause_reason_code string, first_break_date date, "
    "days_since_first_break int, is_cascading_break boolean"
)
_QUANTITIES = "expected_position double, reported_position double, position_difference double"

LAYOUTS = {
    SILVER_FLAGS: Layout(
        "flag_date",
        ("account_id", "security_id"),
        "flag_id string, flag_type string, affected_entity string, affected_record_id string, account_id string, "
        "security_id string, flag_date date, severity string, description string, _silver_processed_at timestamp",
    ),
    GOLD_POSITIONS: Layout(
        "position_date",
        ("account_id", "security_id"),
        f"{_CELL}, starting_quantity double, cumulative_buy_quantity double, cumulative_sell_quantity double, "
        f"{_QUANTITIES}, reconciliation_status string, {_CAUSE}, _gold_processed_at timestamp",
    ),
    GOLD_BREAKS: Layout(
        "position_date",
        ("account_id", "security_id"),
        f"break_id string, {_CELL}, {_QUANTITIES}, {_CAUSE}, severity string, investigation_notes string, "
        "_gold_processed_at timestamp",
    ),
}
