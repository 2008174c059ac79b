"""Silver cleaning: one declared rule per column, malformed values become null."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.expr import normalized_id, normalized_text, standard_side
from tallyspark.operators.bronze import BRONZE_METADATA


def _cast_to(type_name: str) -> Callable[[str], Column]:
    return lambda column: F.col(column).try_cast(type_name)


RULES: dict[str, Callable[[str], Column]] = {
    "id": normalized_id,
    "text": normalized_text,
    "side": standard_side,
    "flag": _cast_to("boolean"),
    "date": _cast_to("date"),
    "time": _cast_to("timestamp"),
    "number": _cast_to("double"),
    "whole": _cast_to("long"),
}

# How each column of each table is cleaned.
CLEANING = {
    "securities": "security_id:id ticker:id company_name:text exchange:id sector:text is_active:flag",
    "prices": (
        "security_id:id price_date:date open_price:number high_price:number low_price:number "
        "close_price:number volume:whole"
    ),
    "corporate_actions": (
        "corporate_action_id:text security_id:id action_type:id effective_date:date "
        "split_ratio:number description:text"
    ),
    "starting_positions": "account_id:id security_id:id position_date:date quantity:number",
    "trades": (
        "trade_id:text account_id:id security_id:id side:side quantity:number "
        "execution_price:number trade_date:date settlement_date:date event_timestamp:time "
        "ingestion_timestamp:time source_system:id"
    ),
    "reported_positions": (
        "account_id:id security_id:id position_date:date reported_quantity:number source_system:id"
    ),
    "filing_events": (
        "event_id:text security_id:id event_date:date event_type:id event_summary:text"
    ),
}


def clean(table: str, bronze: DataFrame) -> DataFrame:
    """Typed, normalized columns, then whatever bronze metadata came along."""
    rules = [rule.split(":") for rule in CLEANING[table].split()]
    kept = [name for name in BRONZE_METADATA if name in bronze.columns]
    return bronze.select(
        *[RULES[rule](column).alias(column) for column, rule in rules],
        *kept,
        F.current_timestamp().alias("_silver_processed_at"),
    )


clean_securities = partial(clean, "securities")
clean_prices = partial(clean, "prices")
clean_corporate_actions = partial(clean, "corporate_actions")
clean_starting_positions = partial(clean, "starting_positions")
clean_trades = partial(clean, "trades")
clean_reported_positions = partial(clean, "reported_positions")
clean_events = partial(clean, "filing_events")
