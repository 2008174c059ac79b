"""Weekday calendar and date windows around events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.expr import add_business_days

RADIUS = 5
SETTLEMENT_DAYS = 2


def business_calendar(bounds: DataFrame) -> DataFrame:
    """Weekdays from ``first_date`` to ``last_date`` (one row of bounds), numbered from 0.

    No holidays. Instead of ``last_date`` the row may give ``periods``, the number
    of weekdays wanted.
    """
    if "last_date" in bounds.columns:
        last = F.col("last_date")
    else:
        before_first = F.date_sub("first_date", 1)
        last = F.when(
            F.col("periods") > 0,
            F.date_add(
                "first_date", (F.ceil(F.col("periods") / 5) * 7 + 7).cast("int")
            ),
        ).otherwise(before_first)
    weekdays = F.filter(F.sequence("first_date", last), lambda day: F.weekday(day) < 5)
    if "last_date" not in bounds.columns:
        weekdays = F.slice(weekdays, 1, F.col("periods").cast("int"))
    return bounds.select(F.posexplode(weekdays).alias("day_index", "trading_day"))


def settlement_date(trades: DataFrame, days: int = SETTLEMENT_DAYS) -> DataFrame:
    """Settlement date: the trade date plus so many business days."""
    return trades.withColumn("settlement_date", add_business_days(F.col("trade_date"), days))


def event_window_dates(events: DataFrame, calendar: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct (security, trading day) within the radius of an event on a trading day."""
    offsets = F.explode(F.sequence(F.lit(-radius), F.lit(radius)))
    return (
        events.select("security_id", F.col("event_date").alias("trading_day"))
        .distinct()
        .join(calendar, "trading_day")
        .select("security_id", F.col("day_index"), offsets.alias("_offset"))
        .select("security_id", (F.col("day_index") + F.col("_offset")).alias("day_index"))
        .distinct()
        .join(calendar, "day_index")
        .select("security_id", F.col("trading_day").alias("price_date"))
    )


def price_required_keys(trades: DataFrame, events: DataFrame, calendar: DataFrame) -> DataFrame:
    """(security, date) that need a price: traded, or near an event."""
    traded = trades.select("security_id", F.col("trade_date").alias("price_date"))
    return traded.unionByName(event_window_dates(events, calendar)).distinct()


def price_required_dates(
    prices: DataFrame, trades: DataFrame, events: DataFrame, calendar: DataFrame
) -> DataFrame:
    """The price rows on such keys."""
    keys = price_required_keys(trades, events, calendar)
    return prices.join(keys, ["security_id", "price_date"], "left_semi")
