"""Stock-split adjustment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPLIT = "STOCK_SPLIT"
FACTOR = "split_adjustment_factor"


def daily_split_ratios(corporate_actions: DataFrame) -> DataFrame:
    """One row per security and effective date: the product of its split ratios.

    A ratio that is null or not positive says nothing and is left out.
    """
    return (
        corporate_actions.filter(
            (F.col("action_type") == SPLIT)
            & (F.col("split_ratio") > 0)
            & F.col("security_id").isNotNull()
            & F.col("effective_date").isNotNull()
        )
        .groupBy("security_id", F.col("effective_date").alias("_day"))
        .agg(F.product("split_ratio").alias("_ratio"))
    )


def split_factors(dates: DataFrame, corporate_actions: DataFrame, date: str = "price_date") -> DataFrame:
    """Per distinct (security, date): product of the ratios effective strictly later.

    Dates and splits are collapsed to one row per day and walked once from the
    last day back, so a security costs at most its calendar, not dates x splits.
    """
    days = dates.select("security_id", F.col(date).alias("_day")).distinct()
    merged = (
        days.withColumn("_wanted", F.lit(True))
        .unionByName(
            daily_split_ratios(corporate_actions).withColumn("_wanted", F.lit(False)),
            allowMissingColumns=True,
        )
        .groupBy("security_id", "_day")
        .agg(F.max("_wanted").alias("_wanted"), F.product("_ratio").alias("_ratio"))
    )
    later = (
        Window.partitionBy("security_id")
        .orderBy(F.col("_day").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    factor = F.when(F.col("_day").isNotNull(), F.product("_ratio").over(later))
    return (
        merged.withColumn(FACTOR, F.coalesce(factor, F.lit(1.0)))
        .filter("_wanted")
        .select("security_id", F.col("_day").alias(date), FACTOR)
    )


def attach_split_factor(
    df: DataFrame, date: str, factors: DataFrame, factor_date: str = "price_date"
) -> DataFrame:
    """Left join on (security, date); no factor row means 1.0.

    Rows with factor 1.0 equal absent ones, so only the others are joined: the
    lookup side holds just the securities that split.
    """
    changed = factors.filter(F.col(FACTOR) != 1.0).withColumnRenamed(factor_date, date)
    return df.join(changed, ["security_id", date], "left").withColumn(
        FACTOR, F.coalesce(FACTOR, F.lit(1.0))
    )


def _adjusted(
    df: DataFrame,
    date: str,
    factors: DataFrame,
    scaled_up: Mapping[str, str],
    scaled_down: Mapping[str, str],
) -> DataFrame:
    factor = F.col(FACTOR)
    columns = {new: F.col(old) * factor for new, old in scaled_up.items()}
    columns |= {new: F.col(old) / factor for new, old in scaled_down.items()}
    return attach_split_factor(df, date, factors).withColumns(columns)


def adjust_prices(prices: DataFrame, factors: DataFrame) -> DataFrame:
    names = ("open_price", "high_price", "low_price", "close_price")
    return _adjusted(prices, "price_date", factors, {}, {f"adjusted_{n}": n for n in names})


def adjust_starting_positions(starting: DataFrame, factors: DataFrame) -> DataFrame:
    return _adjusted(starting, "position_date", factors, {"adjusted_quantity": "quantity"}, {})


def adjust_trades(trades: DataFrame, factors: DataFrame) -> DataFrame:
    return _adjusted(
        trades,
        "trade_date",
        factors,
        {"adjusted_quantity": "quantity"},
        {"adjusted_execution_price": "execution_price"},
    )


def adjust_reported_positions(reported: DataFrame, factors: DataFrame) -> DataFrame:
    return _adjusted(
        reported,
        "position_date",
        factors,
        {"adjusted_reported_quantity": "reported_quantity"},
        {},
    )


def own_date_factors(tables: Mapping[str, DataFrame], corporate_actions: DataFrame) -> DataFrame:
    """Factors for every date the given tables hold ({date column: table}).

    With factors on price dates only, a trade on a day without a price keeps
    factor 1.0 even before a split. Pass this instead to adjust such rows too.
    """
    dates = None
    for date, table in tables.items():
        part = table.select("security_id", F.col(date).alias("price_date")).distinct()
        dates = part if dates is None else dates.unionByName(part)
    return split_factors(dates, corporate_actions)
