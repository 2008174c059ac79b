"""Position reconstruction: expected against reported, day by day.

The whole reconciliation is one union and one shuffle on (account, security).
Four kinds of rows meet there: the dense date scaffold, the daily trade totals,
the daily flag signals and the reported snapshots. Running sums, flag spreading
and break segments are windows over that one partitioning, so the dense table is
neither joined nor shuffled again. Everything that enters is reduced before the
shuffle (trades to one row per day, equal snapshots to one row with a count):
a pair that holds a third of all trades still brings one row per date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.frames import calendar_of, every_date, repeat_rows, union_all

PAIR = ("account_id", "security_id")
CELL = (*PAIR, "position_date")

# Flag types that explain a break, in order of priority.
SIGNALS = {
    "SPLIT_ADJUSTMENT_BREAK": "has_split_adjustment_break_flag",
    "DUPLICATE_TRADE": "has_duplicate_trade_flag",
    "LATE_ARRIVING_TRADE": "has_late_arriving_trade_flag",
    "MISSING_PRICE": "has_missing_price_flag",
}
NOT_REPORTED = "POSITION_NOT_REPORTED"
MISMATCH = "QUANTITY_MISMATCH"
MATCH = "MATCH"
BREAK = "BREAK"

# The columns of the reconstruction.
POSITION_COLUMNS = (
    *CELL,
    "starting_quantity",
    "cumulative_buy_quantity",
    "cumulative_sell_quantity",
    "expected_position",
    "reported_position",
    "position_difference",
    "reconciliation_status",
    "break_reason_code",
    "root_cause_reason_code",
    "first_break_date",
    "days_since_first_break",
    "is_cascading_break",
)


def _first_present(df: DataFrame, *names: str) -> Column:
    return F.col(next(name for name in names if name in df.columns))


def _trade_quantity(df: DataFrame) -> Column:
    return _first_present(df, "adjusted_quantity", "quantity")


def valid_trades(trades: DataFrame, securities: DataFrame) -> DataFrame:
    """Trades whose security is known."""
    return trades.join(securities.select("security_id").distinct(), "security_id", "left_semi")


def daily_trade_activity(trades: DataFrame) -> DataFrame:
    """Bought and sold quantity per account, security and trade date."""

    def total(side: str) -> Column:
        return F.sum(F.when(F.col("side") == side, _trade_quantity(trades)).otherwise(0.0))

    return trades.groupBy(*PAIR, F.col("trade_date").alias("position_date")).agg(
        total("BUY").alias("daily_buy_quantity"), total("SELL").alias("daily_sell_quantity")
    )


def starting_baseline(starting: DataFrame) -> DataFrame:
    """The highest baseline of each pair, whatever its date; null counts as zero."""
    return starting.groupBy(*PAIR).agg(
        F.coalesce(F.max(_trade_quantity(starting)), F.lit(0.0)).alias("starting_quantity")
    )


def _pairs(starting: DataFrame, trades: DataFrame, reported: DataFrame) -> DataFrame:
    """Distinct pairs with their baseline, in one aggregation."""
    known = F.col("account_id").isNotNull() & F.col("security_id").isNotNull()
    parts = [
        starting.select(*PAIR, _trade_quantity(starting).alias("_base")),
        trades.select(*PAIR),
        reported.select(*PAIR),
    ]
    base = F.when(known, F.col("_base"))
    return (
        union_all(parts)
        .groupBy(*PAIR)
        .agg(F.coalesce(F.max(base), F.lit(0.0)).alias("starting_quantity"))
    )


def _dates(starting: DataFrame, trades: DataFrame, reported: DataFrame) -> DataFrame:
    return union_all(
        [
            starting.select("position_date"),
            trades.select(F.col("trade_date").alias("position_date")),
            reported.select("position_date"),
        ]
    )


def position_scaffold(starting: DataFrame, trades: DataFrame, reported: DataFrame) -> DataFrame:
    """Every pair on every date seen anywhere; a null date is a date of its own."""
    return every_date(
        _pairs(starting, trades, reported), _dates(starting, trades, reported), "position_date"
    )


def flag_signals(flags: DataFrame) -> DataFrame:
    """Which flag types an account and security have on a date, as 0/1 columns."""
    return flags.groupBy(*PAIR, F.col("flag_date").alias("position_date")).agg(
        *[
            F.max(F.when(F.col("flag_type") == kind, 1).otherwise(0)).alias(name)
            for kind, name in SIGNALS.items()
        ]
    )


def _snapshots(reported: DataFrame) -> DataFrame:
    """Reported rows; equal ones become one row with a count."""
    quantity = _first_present(reported, "adjusted_reported_quantity", "reported_quantity")
    return reported.groupBy(*CELL, quantity.alias("reported_position")).agg(
        F.count(F.lit(1)).alias("_copies")
    )


def _complete_key(df: DataFrame) -> DataFrame:
    """Rows that can meet a scaffold row: null keys equal nothing."""
    return df.dropna(subset=list(CELL))


# Order of a pair's rows; snapshots of one date go from null and low to high.
def _timeline() -> Window:
    return Window.partitionBy(*PAIR).orderBy("position_date", F.col("reported_position").asc_nulls_first())


def _with_cells(rows: DataFrame, calendar: Column) -> DataFrame:
    """The rows of each pair, its baseline on every row, and a cell for every date.

    A pair exists where the baselines, trades or reports name it, not by flags
    alone. One row of each pair writes its cells out after the rows are dealt by
    pair, so pairs need no reading of their own.
    """
    pair = Window.partitionBy(*PAIR)
    signal = F.col("_kind") == "signal"
    first = (F.row_number().over(pair.orderBy(signal)) == 1) & ~signal
    itself = F.array(F.lit(None).cast("date"))
    values = [name for name in rows.columns if name not in (*CELL, "_base", "_kind")]
    cell = F.col("_at") > 0
    return (
        rows.withColumn("starting_quantity", F.coalesce(F.max("_base").over(pair), F.lit(0.0)))
        .withColumn("_days", F.when(first, F.concat(itself, calendar)).otherwise(itself))
        .select("*", F.posexplode("_days").alias("_at", "_day"))
        .select(
            *PAIR,
            F.when(cell, F.col("_day")).otherwise(F.col("position_date")).alias("position_date"),
            "starting_quantity",
            *[F.when(~cell, F.col(name)).alias(name) for name in values],
            F.when(cell, F.lit("cell")).otherwise(F.col("_kind")).alias("_kind"),
        )
        .filter("_kind != 'pair'")
    )


def position_timeline(
    starting: DataFrame,
    trades: DataFrame,
    reported: DataFrame,
    flags: DataFrame | None = None,
) -> DataFrame:
    """One row per scaffold cell and distinct snapshot: running sums, expected
    position, reported position (null where none) and flag signals.

    ``trades`` are the valid trades. ``_copies`` counts equal snapshots.
    """
    kind = F.col("_kind")
    whole = F.lit(True)
    for name in CELL:
        whole = whole & F.col(name).isNotNull()

    def facts(df: DataFrame, name: str) -> DataFrame:
        """Rows that can meet a cell; others only tell that their pair exists."""
        values = [column for column in df.columns if column not in CELL]
        return df.select(
            *CELL,
            *[F.when(whole, F.col(column)).alias(column) for column in values],
            F.when(whole, F.lit(name)).otherwise(F.lit("pair")).alias("_kind"),
        )

    known = F.col("account_id").isNotNull() & F.col("security_id").isNotNull()
    rows = [
        starting.select(
            *PAIR, F.when(known, _trade_quantity(starting)).alias("_base"), F.lit("pair").alias("_kind")
        ),
        facts(daily_trade_activity(trades), "fact"),
        facts(_snapshots(reported), "snapshot"),
    ]
    if flags is not None:
        rows.append(_complete_key(flag_signals(flags)).withColumn("_kind", F.lit("signal")))
    signals = list(SIGNALS.values()) if flags is not None else []
    gathered = _with_cells(union_all(rows), calendar_of(_dates(starting, trades, reported), "position_date"))

    # Range frames: a row sees every row of its own date, whatever its kind.
    to_date = Window.partitionBy(*PAIR).orderBy("position_date")
    on_date = Window.partitionBy(*CELL)

    def running(name: str) -> Column:
        return F.sum(F.coalesce(F.col(name), F.lit(0.0))).over(to_date)

    return (
        gathered.withColumns(
            {
                "cumulative_buy_quantity": running("daily_buy_quantity"),
                "cumulative_sell_quantity": running("daily_sell_quantity"),
            }
        )
        .withColumns(
            {
                "_reported": F.max(kind == "snapshot").over(on_date),
                **{name: F.coalesce(F.max(name).over(on_date), F.lit(0)) for name in signals},
            }
        )
        .filter((kind == "snapshot") | ((kind == "cell") & ~F.col("_reported")))
        .withColumn(
            "expected_position",
            F.col("starting_quantity")
            + F.col("cumulative_buy_quantity")
            - F.col("cumulative_sell_quantity"),
        )
        .select(
            *CELL,
            "starting_quantity",
            "cumulative_buy_quantity",
            "cumulative_sell_quantity",
            "expected_position",
            "reported_position",
            *signals,
            F.coalesce("_copies", F.lit(1)).alias("_copies"),
        )
    )


def reconciliation_status(timeline: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Difference and MATCH/BREAK. Unreported is a break; only |difference| up to
    the tolerance matches."""
    difference = F.col("reported_position") - F.col("expected_position")
    return timeline.withColumn("position_difference", difference).withColumn(
        "reconciliation_status",
        F.when(F.abs("position_difference") <= tolerance, F.lit(MATCH)).otherwise(F.lit(BREAK)),
    )


def break_reason_code(classified: DataFrame) -> DataFrame:
    """Why a row breaks: unreported first, then the flags by priority."""
    reason = F.when(F.col("reported_position").isNull(), F.lit(NOT_REPORTED)).when(
        F.col("reconciliation_status") == MATCH, F.lit(MATCH)
    )
    for kind, name in SIGNALS.items():
        reason = reason.when(F.col(name) == 1, F.lit(kind))
    return classified.withColumn("break_reason_code", reason.otherwise(F.lit(MISMATCH)))


def break_segments(classified: DataFrame) -> DataFrame:
    """Mark where a run of breaks starts and number the runs of a pair.

    A run also holds the matching rows after it, up to the next start.
    """
    ordered = _timeline()
    is_break = F.col("reconciliation_status") == BREAK
    after_break = F.coalesce(F.lag(is_break).over(ordered), F.lit(False))
    return classified.withColumn("_starts", is_break & ~after_break).withColumn(
        "break_segment_id",
        F.sum(F.col("_starts").cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
    )


def root_causes(segmented: DataFrame) -> DataFrame:
    """First date and first reason of the run a break belongs to, and its age.

    Both are carried forward from the row that starts the run, so no second
    partitioning by run is needed. A run that starts on the null date counts from
    the next date.
    """
    ordered = _timeline()
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    is_break = F.col("reconciliation_status") == BREAK
    start_date = F.coalesce("position_date", F.lead("position_date").over(ordered))

    def carried(name: str) -> Column:
        return F.when(is_break, F.last(F.when(F.col("_starts"), F.col(name)), ignorenulls=True).over(so_far))

    date, first = F.col("position_date"), F.col("first_break_date")
    return (
        segmented.withColumn("_start_date", start_date)
        .withColumns(
            {
                "first_break_date": carried("_start_date"),
                "root_cause_reason_code": F.coalesce(carried("break_reason_code"), F.lit(MATCH)),
            }
        )
        .withColumns(
            {
                "days_since_first_break": F.datediff(date, first),
                "is_cascading_break": F.coalesce(date > first, F.lit(False)),
            }
        )
    )


def position_reconstruction(
    securities: DataFrame,
    starting: DataFrame,
    trades: DataFrame,
    reported: DataFrame,
    flags: DataFrame,
    tolerance: float = 0.0,
) -> DataFrame:
    """Expected and reported position per account, security and date, with status,
    reason, root cause and age of each break. Repeated snapshots repeat the row."""
    timeline = position_timeline(starting, valid_trades(trades, securities), reported, flags)
    classified = break_reason_code(reconciliation_status(timeline, tolerance))
    rows = root_causes(break_segments(classified))
    return repeat_rows(rows, "_copies", "_copy").select(*POSITION_COLUMNS)
