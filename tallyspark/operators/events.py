"""Returns, volatility and exposure in trading-day windows around events.

Everything measured depends on the security and the trading day an event falls
on, so it is computed once per distinct (security, trading day) and joined back
to the events. A security that holds a third of all events costs no more than
its calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.expr import guarded_ratio
from tallyspark.functions.frames import asof, repeat_rows

RADIUS = 5
ANCHOR = ("security_id", "event_trading_day_index")

# The metric columns of the event-window table.
METRICS = (
    "pre_event_return",
    "post_event_return",
    "event_day_return",
    "pre_event_volatility",
    "post_event_volatility",
    "position_before_event",
    "position_after_event",
    "position_change_around_event",
    "exposure_before_event",
    "exposure_after_event",
    "exposure_change_around_event",
)


def price_index(prices: DataFrame) -> DataFrame:
    """Number the prices of each security by date and add the daily return.

    Repeated prices of one date keep a number each, from low to high; equal ones
    are counted before the shuffle and written out again after.
    """
    close = "adjusted_close_price" if "adjusted_close_price" in prices.columns else "close_price"
    ordered = Window.partitionBy("security_id").orderBy("price_date", "close_price")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        prices.groupBy("security_id", "price_date", F.col(close).alias("close_price"))
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_copies").over(before), F.lit(0)),
                "_previous": F.lag("close_price").over(ordered),
            }
        )
    )
    previous = F.when(F.col("_copy") == 1, F.col("_previous")).otherwise(F.col("close_price"))
    return (
        repeat_rows(runs, "_copies", "_copy")
        .withColumns(
            {
                "trading_day_index": (F.col("_before") + F.col("_copy")).cast("int"),
                "prev_close_price": previous,
            }
        )
        .withColumn(
            "daily_return",
            guarded_ratio(F.col("close_price") - F.col("prev_close_price"), F.col("prev_close_price")),
        )
        .drop("_before", "_previous", "_copy")
    )


def event_asof_forward(events: DataFrame, prices: DataFrame) -> DataFrame:
    """Each event on its first price date at or after the event date.

    One row per event id and security; where such a key repeats, the row without
    a price date wins, then the earliest.
    """
    days = (
        price_index(prices)
        .groupBy("security_id", "price_date")
        .agg(F.min("trading_day_index").alias("event_trading_day_index"))
    )
    mapped = asof(
        events,
        days.withColumn("event_price_date", F.col("price_date")),
        by="security_id",
        left_on="event_date",
        right_on="price_date",
        take=("event_price_date", "event_trading_day_index"),
        forward=True,
    )
    chosen = ("event_price_date", "event_date", "event_type", "event_trading_day_index")
    return (
        events.select("event_id", "security_id", "event_date", "event_type")
        .join(mapped, ["security_id", "event_date"], "left")
        .groupBy("event_id", "security_id")
        .agg(F.min(F.struct(*chosen)).alias("_row"))
        .select("event_id", "security_id", *[F.col(f"_row.{name}").alias(name) for name in chosen])
    )


def _around(anchors: DataFrame, prices: DataFrame) -> DataFrame:
    """Prices at the trading days around each anchor row, by equi-join on the day number.

    A row without a trading day keeps one row without a price.
    """
    index = F.col("event_trading_day_index")
    offsets = F.when(index.isNull(), F.array(F.lit(None).cast("int"))).otherwise(
        F.sequence(F.lit(-RADIUS), F.lit(RADIUS))
    )
    numbered = price_index(prices)
    return (
        anchors.withColumn("offset", F.explode(offsets))
        .withColumn("trading_day_index", index + F.col("offset"))
        .join(
            numbered.select(
                "security_id",
                "trading_day_index",
                "price_date",
                "close_price",
                "daily_return",
                F.lit(True).alias("_priced"),
            ),
            ["security_id", "trading_day_index"],
            "left",
        )
        .filter(F.col("_priced") | index.isNull())
    )


def event_price_window(mapped_events: DataFrame, prices: DataFrame) -> DataFrame:
    """One row per event and trading day within five of it."""
    return _around(mapped_events, prices).select(
        "event_id",
        "security_id",
        "event_date",
        "event_type",
        "event_trading_day_index",
        "price_date",
        "trading_day_index",
        "close_price",
        "daily_return",
        "offset",
    )


def _anchors(mapped_events: DataFrame) -> DataFrame:
    return mapped_events.select(*ANCHOR).dropna().distinct()


def price_window_metrics(anchors: DataFrame, prices: DataFrame) -> DataFrame:
    """Closes at the marked days, volatility and returns on both sides, completeness."""
    offset, daily = F.col("offset"), F.col("daily_return")
    marks = {"m5": -RADIUS, "m1": -1, "0": 0, "p1": 1, "p5": RADIUS}
    sides = {"pre": offset.between(-RADIUS, -1), "post": offset.between(1, RADIUS)}
    aggregates = [
        F.max(F.when(offset == at, F.col("close_price"))).alias(f"close_{mark}")
        for mark, at in marks.items()
    ]
    for side, within in sides.items():
        aggregates.append(F.stddev_samp(F.when(within, daily)).alias(f"{side}_event_volatility"))
        aggregates.append(F.count(F.when(within, daily)).alias(f"{side}_return_obs"))

    def change(start: str, end: str) -> Column:
        return guarded_ratio(
            F.col(f"close_{end}") - F.col(f"close_{start}"), F.col(f"close_{start}")
        )

    complete = (F.col("pre_return_obs") >= RADIUS) & (F.col("post_return_obs") >= RADIUS)
    for mark in ("m5", "m1", "p1", "p5"):
        complete = complete & F.col(f"close_{mark}").isNotNull()
    return (
        _around(anchors, prices)
        .groupBy(*ANCHOR)
        .agg(*aggregates)
        .withColumns(
            {
                "pre_event_return": change("m5", "m1"),
                "post_event_return": change("p1", "p5"),
                "event_day_return": change("m1", "0"),
                "is_full_window": complete,
            }
        )
    )


def security_positions(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Expected position per security and date over all accounts, with the price row."""
    return (
        positions.groupBy("security_id", F.col("position_date").alias("price_date"))
        .agg(F.sum("expected_position").alias("position_quantity"))
        .join(
            price_index(prices).select(
                "security_id", "price_date", "trading_day_index", "close_price"
            ),
            ["security_id", "price_date"],
            "left",
        )
    )


def _positions_around(anchors: DataFrame, held: DataFrame) -> DataFrame:
    """The positions before and after each anchor, out of one ordered pass.

    An anchor asks twice: at its own day, ahead of that day's position, and at the
    last day of its window, behind it. What stands nearest in front answers.
    """
    index = F.col("event_trading_day_index")
    asks = F.array(
        F.struct(F.lit("before").alias("side"), index.alias("at"), F.lit(0).alias("turn")),
        F.struct(F.lit("after").alias("side"), (index + RADIUS).alias("at"), F.lit(2).alias("turn")),
    )
    asked = anchors.select(*ANCHOR, F.explode(asks).alias("_ask")).select(*ANCHOR, "_ask.*")
    known = held.filter("security_id is not null and trading_day_index is not null").select(
        "security_id",
        F.col("trading_day_index").alias("at"),
        F.lit(1).alias("turn"),
        F.struct("position_quantity", "close_price", F.col("trading_day_index").alias("held_index")).alias("_held"),
    )
    so_far = Window.partitionBy("security_id").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last("_held", ignorenulls=True).over(so_far)
    within = F.col("_after.held_index") > index
    return (
        asked.unionByName(known, allowMissingColumns=True)
        .withColumn("_held", found)
        .filter("side is not null")
        .groupBy(*ANCHOR)
        .agg(*[F.max(F.when(F.col("side") == side, F.col("_held"))).alias(f"_{side}") for side in ("before", "after")])
        .select(
            *ANCHOR,
            F.col("_before.position_quantity").alias("position_before_event"),
            F.col("_before.close_price").alias("close_price_before"),
            F.when(within, F.col("_after.position_quantity")).alias("position_after_event"),
            F.when(within, F.col("_after.close_price")).alias("close_price_after"),
        )
    )


def position_before(anchors: DataFrame, held: DataFrame) -> DataFrame:
    """The last position strictly before the event's trading day."""
    return _positions_around(anchors, held).select(*ANCHOR, "position_before_event", "close_price_before")


def position_after(anchors: DataFrame, held: DataFrame) -> DataFrame:
    """The furthest position after the event's trading day and at most five days on."""
    return _positions_around(anchors, held).select(*ANCHOR, "position_after_event", "close_price_after")


def exposure_metrics(anchors: DataFrame, held: DataFrame) -> DataFrame:
    """Positions and exposures around the event; a null part makes the result null."""
    before, after = F.col("position_before_event"), F.col("position_after_event")
    return (
        _positions_around(anchors, held)
        .withColumns(
            {
                "position_change_around_event": after - before,
                "exposure_before_event": before * F.col("close_price_before"),
                "exposure_after_event": after * F.col("close_price_after"),
            }
        )
        .withColumn(
            "exposure_change_around_event",
            F.col("exposure_after_event") - F.col("exposure_before_event"),
        )
        .drop("close_price_before", "close_price_after")
    )


def event_window_metrics(prices: DataFrame, events: DataFrame, positions: DataFrame) -> DataFrame:
    """One row per event and security with its window metrics."""
    mapped = event_asof_forward(events, prices)
    anchors = _anchors(mapped)
    return (
        mapped.join(price_window_metrics(anchors, prices), list(ANCHOR), "left")
        .join(
            exposure_metrics(anchors, security_positions(positions, prices)), list(ANCHOR), "left"
        )
        .select(
            "event_id",
            "security_id",
            "event_date",
            "event_type",
            "event_trading_day_index",
            *METRICS,
            F.coalesce("is_full_window", F.lit(False)).alias("is_full_window"),
        )
    )


def window_measures() -> dict[str, F.Column]:
    """What a pass over the metrics counts: full windows, and nulls per metric."""
    nulls = {f"null_{name}": F.count_if(F.col(name).isNull()) for name in METRICS}
    return {"full_windows": F.count_if("is_full_window"), **nulls}


def event_keys(events: DataFrame) -> DataFrame:
    """How many event keys there are: one row."""
    keys = events.groupBy("event_id", "security_id").agg(F.lit(1).alias("_"))
    return keys.agg(F.count(F.lit(1)).alias("events"))


def event_window_summary(events: DataFrame, metrics: DataFrame) -> DataFrame:
    """Event keys, output rows, full and partial windows, nulls per metric: one pass each."""
    rows = F.count(F.lit(1))
    measures = window_measures()
    measured = metrics.agg(
        rows.alias("output_rows"),
        (rows - measures["full_windows"]).alias("partial_windows"),
        *[measure.alias(name) for name, measure in measures.items()],
    )
    return measured.withColumn("events", event_keys(events).scalar())
