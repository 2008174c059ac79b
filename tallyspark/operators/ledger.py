"""Ledger views: expected positions by date basis, zero baselines, forward splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.frames import every_date, union_all
from tallyspark.operators.splits import daily_split_ratios

PAIR = ("account_id", "security_id")
CELL = (*PAIR, "position_date")


def _signed(quantity: str = "quantity") -> Column:
    return F.when(F.col("side") == "BUY", F.col(quantity)).otherwise(-F.col(quantity))


def _net_moves(trades: DataFrame, date: str, name: str) -> DataFrame:
    return trades.groupBy(*PAIR, F.col(date).alias("position_date")).agg(F.sum(_signed()).alias(name))


def _pair_days(
    starting: DataFrame, trades: DataFrame, calendar: DataFrame, bases: dict[str, str]
) -> DataFrame:
    """Every pair on every trading day with its net move per basis ({name: date column}),
    the running sum of it and the baseline: one shuffle on the pair."""
    pairs = (
        starting.select(*PAIR, "quantity")
        .unionByName(trades.select(*PAIR), allowMissingColumns=True)
        .groupBy(*PAIR)
        .agg(F.coalesce(F.max("quantity"), F.lit(0.0)).alias("baseline"))
    )
    days = calendar.select(F.col("trading_day").alias("position_date"))
    cells = every_date(pairs, days, "position_date").withColumn("_cell", F.lit(True))
    # Moves off the calendar count nowhere.
    moves = [
        _net_moves(trades, date, name).join(days, "position_date", "left_semi")
        for name, date in bases.items()
    ]
    to_date = Window.partitionBy(*PAIR).orderBy("position_date")
    on_date = Window.partitionBy(*CELL)
    known = {name: F.coalesce(F.col(name), F.lit(0.0)) for name in bases}
    return (
        union_all([cells, *moves])
        .withColumns({f"_run_{name}": F.sum(value).over(to_date) for name, value in known.items()})
        .withColumns({name: F.sum(value).over(on_date) for name, value in known.items()})
        .filter("_cell")
    )


def expected_by_date_basis(
    starting: DataFrame, trades: DataFrame, calendar: DataFrame, date_field: str = "trade_date"
) -> DataFrame:
    """Expected position per pair and trading day, trades counted on the given date."""
    days = _pair_days(starting, trades, calendar, {"net": date_field})
    first = calendar.agg(F.min("trading_day")).scalar()
    return days.select(
        *CELL,
        F.when(F.col("position_date") == first, F.col("baseline")).otherwise(0.0).alias("starting_quantity"),
        F.greatest(F.col("net"), F.lit(0.0)).alias("buy_quantity"),
        F.greatest(-F.col("net"), F.lit(0.0)).alias("sell_quantity"),
        F.round(F.col("baseline") + F.col("_run_net"), 4).alias("expected_position"),
    )


# The dates that trades may be counted on.
BASES = ("trade_date", "settlement_date")


def _both_bases(starting: DataFrame, trades: DataFrame, calendar: DataFrame) -> DataFrame:
    return _pair_days(starting, trades, calendar, {f"net_{basis}": basis for basis in BASES})


def expected_by_both_bases(starting: DataFrame, trades: DataFrame, calendar: DataFrame) -> DataFrame:
    """``expected_by_date_basis`` for either date, told by ``basis``, out of one pass."""
    first = calendar.agg(F.min("trading_day")).scalar()
    start = F.when(F.col("position_date") == first, F.col("baseline")).otherwise(0.0)

    def view(basis: str) -> F.Column:
        net = F.col(f"net_{basis}")
        return F.struct(
            F.lit(basis).alias("basis"),
            start.alias("starting_quantity"),
            F.greatest(net, F.lit(0.0)).alias("buy_quantity"),
            F.greatest(-net, F.lit(0.0)).alias("sell_quantity"),
            F.round(F.col("baseline") + F.col(f"_run_net_{basis}"), 4).alias("expected_position"),
        )

    days = _both_bases(starting, trades, calendar)
    return days.select(*CELL, F.explode(F.array(*map(view, BASES))).alias("_view")).select(*CELL, "_view.*")


def timing_divergence(starting: DataFrame, trades: DataFrame, calendar: DataFrame) -> DataFrame:
    """Days on which the trade-date and the settlement-date view differ.

    Both views come out of the same pass, so they need no join.
    """
    days = _both_bases(starting, trades, calendar)
    return days.select(
        *CELL,
        F.round(F.col("baseline") + F.col("_run_net_trade_date"), 4).alias("expected_position_trade"),
        F.round(F.col("baseline") + F.col("_run_net_settlement_date"), 4).alias("expected_position_settlement"),
    ).filter("expected_position_trade <> expected_position_settlement")


def zero_fill_starting(starting: DataFrame, trades: DataFrame, day_zero: str) -> DataFrame:
    """Add a zero baseline on day zero for every traded pair without one."""
    missing = starting_coverage_gaps(starting, trades).select(
        *PAIR,
        F.lit(day_zero).cast("date").alias("position_date"),
        F.lit(0.0).alias("quantity"),
    )
    return starting.select(*CELL, "quantity").unionByName(missing).orderBy(*PAIR)


def starting_coverage_gaps(starting: DataFrame, trades: DataFrame) -> DataFrame:
    """Traded pairs without a baseline."""
    return trades.select(*PAIR).distinct().join(starting, list(PAIR), "left_anti")


TRADE_ORDER = ("trade_date", "event_timestamp", "trade_id")


def forward_split_prices(prices: DataFrame, corporate_actions: DataFrame) -> DataFrame:
    """Prices on and after a split divided by its ratio, rounded to four places."""
    ratios = daily_split_ratios(corporate_actions)
    days = prices.select("security_id", F.col("price_date").alias("_day")).distinct()
    to_date = Window.partitionBy("security_id").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    in_force = (
        union_all([days, ratios])
        .groupBy("security_id", "_day")
        .agg(F.product("_ratio").alias("_ratio"))
        .withColumn("_in_force", F.product("_ratio").over(to_date))
        .filter("_in_force <> 1.0 and security_id is not null and _day is not null")
        .select("security_id", F.col("_day").alias("price_date"), "_in_force")
    )
    names = ("open_price", "high_price", "low_price", "close_price")
    return prices.join(in_force, ["security_id", "price_date"], "left").withColumns(
        {
            name: F.when(F.col("_in_force").isNull(), F.col(name)).otherwise(
                F.round(F.col(name) / F.col("_in_force"), 4)
            )
            for name in names
        }
    ).drop("_in_force")


def forward_split_positions(
    reported: DataFrame, trades: DataFrame, corporate_actions: DataFrame
) -> DataFrame:
    """Carry splits forward through reported positions; every row and column stays.

    The first report on or after a split is multiplied by the ratio; each later
    one is its predecessor plus the day's net trades. With P the product of the
    ratios met so far, quantity / P grows by net / P(previous), so two running
    windows over the pair give it without stepping row by row. Where one account,
    security and date is reported more than once, the lowest quantity is the
    report that is carried and the others stay as they are, as do rows without an
    account or date.
    """
    splits = daily_split_ratios(corporate_actions).withColumnRenamed("_day", "position_date")
    affected = splits.select("security_id").distinct()
    complete = F.col("account_id").isNotNull() & F.col("position_date").isNotNull()
    # Rows of securities that never split go by as they are, as do rows without a key.
    routed = reported.join(affected.withColumn("_splits", F.lit(True)), "security_id", "left").withColumn(
        "_splits", F.coalesce(F.col("_splits") & complete, F.lit(False))
    )
    untouched = routed.filter(~F.col("_splits")).select(*reported.columns)
    touched = routed.filter("_splits").select(*reported.columns)
    daily = touched.groupBy(*CELL).agg(
        F.min("reported_quantity").alias("reported_quantity"), F.lit(True).alias("_report")
    )
    accounts = touched.select(*PAIR).distinct()
    marks = accounts.join(splits, "security_id").select(*CELL, "_ratio")
    moves = _net_moves(trades.join(affected, "security_id", "left_semi"), "trade_date", "_net")

    ordered = Window.partitionBy(*PAIR).orderBy("position_date")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    days = (
        union_all([daily, marks, moves])
        .groupBy(*CELL)
        .agg(
            F.max("_report").alias("_report"),
            F.max("reported_quantity").alias("reported_quantity"),
            F.max("_ratio").alias("_ratio"),
            F.max("_net").alias("_net"),
        )
        .withColumn("_product", F.product("_ratio").over(so_far))
        .filter("_report")
        .withColumn("_before", F.lag("_product").over(ordered))
    )
    first = F.col("_product").isNotNull() & F.col("_before").isNull()
    step = F.when(first, F.col("reported_quantity")).when(
        F.col("_before").isNotNull(), F.coalesce("_net", F.lit(0.0)) / F.col("_before")
    )
    carried = F.round(F.col("_product") * F.sum(step).over(so_far), 4)
    changed = days.select(*CELL, carried.alias("_carried")).filter("_carried is not null")
    others = [name for name in reported.columns if name not in (*CELL, "reported_quantity")]
    of_day = Window.partitionBy(*CELL).orderBy(F.col("reported_quantity").asc_nulls_last(), *others)
    rows = touched.withColumn("_place", F.row_number().over(of_day)).join(changed, list(CELL), "left")
    quantity = F.when(F.col("_place") == 1, F.coalesce("_carried", "reported_quantity")).otherwise(
        F.col("reported_quantity")
    )
    return untouched.unionByName(rows.withColumn("reported_quantity", quantity).select(*reported.columns))


def canonical_trade_order(trades: DataFrame) -> DataFrame:
    """Trades in the order they happened, however the feed delivered them."""
    return trades.orderBy(*TRADE_ORDER)


def trade_places(trades: DataFrame) -> DataFrame:
    """Each trade's place in that order within its account, security and day; equal ones share it."""
    day = Window.partitionBy("account_id", "security_id", "trade_date").orderBy(*TRADE_ORDER[1:])
    return trades.withColumn("place", F.rank().over(day))
