"""Table checks: one row per rule and record that breaks it, with the rows affected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.frames import union_all


def _record(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys])


def _violations(
    table: str,
    df: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, Column],
    *,
    known: DataFrame | None = None,
    duplicates: Sequence[str] = (),
) -> DataFrame:
    """Test every rule in one pass; a rule names the rows for which it holds.

    ``known`` adds the rule that the security exists, ``duplicates`` the one that
    these columns occur once. Both groupings count before the shuffle.
    """
    rows, tests = df, dict(rules)
    if known is not None:
        ids = known.select("security_id").distinct().withColumn("_known", F.lit(True))
        rows = rows.join(ids, "security_id", "left")
        tests["unknown_security"] = F.col("_known").isNull()
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    parts = [
        rows.select(F.explode(broken).alias("rule"), _record(keys).alias("record_id"))
        .groupBy("rule", "record_id")
        .agg(F.count(F.lit(1)).alias("row_count"))
    ]
    if duplicates:
        parts.append(
            df.dropna(subset=list(duplicates))
            .groupBy(*duplicates)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .filter("row_count > 1")
            .select(F.lit("duplicate").alias("rule"), _record(duplicates).alias("record_id"), "row_count")
        )
    return union_all(parts).select(F.lit(table).alias("table_name"), "rule", "record_id", "row_count")


def _null(name: str) -> Column:
    return F.col(name).isNull()


def check_securities(securities: DataFrame) -> DataFrame:
    rules = {"null_security_id": _null("security_id"), "null_ticker": _null("ticker")}
    return _violations("securities", securities, ["security_id"], rules, duplicates=["security_id"])


def check_prices(prices: DataFrame, securities: DataFrame) -> DataFrame:
    names = ("open_price", "high_price", "low_price", "close_price")
    positive = F.lit(True)
    for name in names:
        positive = positive & F.coalesce(F.col(name) > 0, F.lit(False))
    rules = {
        "invalid_date": _null("price_date"),
        "price_not_positive": ~positive,
        "high_below_low": F.col("high_price") < F.col("low_price"),
    }
    keys = ["security_id", "price_date"]
    return _violations("prices", prices, keys, rules, known=securities, duplicates=keys)


def check_trades(trades: DataFrame) -> DataFrame:
    """Null ids and sides; the other trade rules are the trade flags."""
    rules = {
        "null_trade_id": _null("trade_id"),
        "null_account_id": _null("account_id"),
        "invalid_side": ~F.coalesce(F.col("side").isin("BUY", "SELL"), F.lit(False)),
    }
    return _violations("trades", trades, ["trade_id"], rules)


def check_positions(starting: DataFrame, reported: DataFrame, securities: DataFrame) -> DataFrame:
    keys = ["account_id", "security_id", "position_date"]

    def check(table: str, df: DataFrame, quantity: str) -> DataFrame:
        rules = {
            "null_account_id": _null("account_id"),
            "invalid_date": _null("position_date"),
            "invalid_quantity": _null(quantity),
        }
        return _violations(table, df, keys, rules, known=securities, duplicates=keys)

    return check("starting_positions", starting, "quantity").unionByName(
        check("reported_positions", reported, "reported_quantity")
    )


def check_events(events: DataFrame, securities: DataFrame) -> DataFrame:
    rules = {"null_event_id": _null("event_id"), "invalid_date": _null("event_date")}
    return _violations("filing_events", events, ["event_id"], rules, known=securities)


def check_manifest_unique(manifest: DataFrame) -> DataFrame:
    """Issues recorded more than once."""
    return (
        manifest.groupBy("issue_type", "affected_record_id", "issue_date")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter("row_count > 1")
    )


def check_missing_price_targets(manifest: DataFrame, required: DataFrame) -> DataFrame:
    """MISSING_PRICE issues without keys, or on a key that needs no price.

    ``required`` holds the (security_id, price_date) that need one.
    """
    issues = manifest.filter(F.col("issue_type") == "MISSING_PRICE").select(
        "issue_id", "security_id", F.col("issue_date").try_cast("date").alias("price_date")
    )
    lacks_keys = F.coalesce(F.col("security_id") == "", F.lit(True)) | F.col("price_date").isNull()
    return issues.join(required, ["security_id", "price_date"], "left_anti").select(
        "issue_id",
        "security_id",
        "price_date",
        F.when(lacks_keys, "missing_keys").otherwise("not_required").alias("rule"),
    )


def detection_scorecard(manifest: DataFrame, flags: DataFrame, breaks: DataFrame) -> DataFrame:
    """Per expected category: issues recorded, found by a flag or break, and missed.

    An issue is found by its trade id where it has one, else by the account,
    security and date it names; a key it leaves out matches any.
    """
    detected = union_all(
        [
            flags.select(
                F.col("flag_type").alias("category"),
                "account_id",
                "security_id",
                F.col("flag_date").alias("day"),
                F.when(F.col("affected_entity") == "trades", F.col("affected_record_id")).alias("trade_id"),
            ),
            breaks.select(
                F.col("break_reason_code").alias("category"),
                "account_id",
                "security_id",
                F.col("position_date").alias("day"),
            ),
        ]
    )
    places = ("account_id", "security_id", "day")
    issues = manifest.select(
        F.col("expected_detection_category").alias("category"),
        "trade_id",
        *[F.when(F.col("trade_id").isNull(), F.col(name)).alias(f"_{name}") for name in places[:2]],
        F.when(F.col("trade_id").isNull(), F.col("issue_date").cast("string")).alias("_day"),
    )
    bits = [F.when(F.col(f"_{name}").isNotNull(), 1 << bit).otherwise(0) for bit, name in enumerate(places)]
    by_trade = 1 << len(places)
    issues = issues.withColumn(
        "_mask", F.when(F.col("trade_id").isNotNull(), by_trade).otherwise(sum(bits[1:], bits[0]))
    )
    # Which keys the issues of a category name: at most nine numbers each, whatever the manifest.
    named_by = issues.agg(F.collect_set(F.struct("category", "_mask"))).scalar()

    def named(value: Column, bit: int) -> Column:
        return F.when(F.col("_mask").bitwiseAND(F.lit(1 << bit)) != 0, value)

    keys = ("category", "_mask", "trade_id", *[f"_{name}" for name in places])
    asked = issues.groupBy(*keys).agg(F.count(F.lit(1)).alias("_issues"))
    # A flag or break is written only for the masks of its category, and once a task for equal keys.
    found = (
        detected.withColumn("day", F.col("day").cast("string"))
        .withColumn("_pair", F.explode(named_by))
        .filter(F.col("_pair.category").eqNullSafe(F.col("category")))
        .withColumn("_mask", F.col("_pair._mask"))
        .select(
            "category",
            "_mask",
            *[named(F.col(name), bit).alias(f"_{name}") for bit, name in enumerate(places)],
            named(F.col("trade_id"), len(places)).alias("trade_id"),
        )
        .filter((F.col("_mask") != by_trade) | F.col("trade_id").isNotNull())
        .distinct()
        .withColumn("_found", F.lit(True))
    )
    same = [F.col(f"i.{key}").eqNullSafe(F.col(f"f.{key}")) for key in keys]
    hits = F.sum(F.when(F.col("_found"), F.col("_issues")).otherwise(0))
    rows = F.sum("_issues")
    return (
        asked.alias("i")
        .join(found.alias("f"), same, "left")
        .groupBy(F.col("i.category").alias("category"))
        .agg(rows.alias("issues"), hits.alias("found"), (rows - hits).alias("missed"))
    )
