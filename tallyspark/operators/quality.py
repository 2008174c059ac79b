"""Trade-quality and split flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.expr import key_digest
from tallyspark.operators.splits import SPLIT

# Flag types, their severity and their description.
FLAG_TEXTS = {
    "DUPLICATE_TRADE": ("HIGH", "Duplicate trade_id detected in silver trades."),
    "UNKNOWN_SECURITY": (
        "HIGH",
        "Trade references a security_id not present in securities_clean.",
    ),
    "MISSING_PRICE": (
        "MEDIUM",
        "No matching price record found for trade security_id and trade_date.",
    ),
    "INVALID_QUANTITY": ("HIGH", "Trade quantity is null or not strictly positive."),
    "INVALID_PRICE": ("HIGH", "Execution price is null or not strictly positive."),
    "LATE_ARRIVING_TRADE": ("MEDIUM", "Ingestion timestamp date occurs after the trade date."),
    "SPLIT_ADJUSTMENT_BREAK": (
        "HIGH",
        "Reported position does not align with expected split-adjusted quantity around split date.",
    ),
}
SPLIT_FLAG = "SPLIT_ADJUSTMENT_BREAK"
TRADE_FLAGS = tuple(kind for kind in FLAG_TEXTS if kind != SPLIT_FLAG)

FLAG_COLUMNS = (
    "flag_id",
    "flag_type",
    "affected_entity",
    "affected_record_id",
    "account_id",
    "security_id",
    "flag_date",
    "severity",
    "description",
)


def _text_of(position: int) -> F.Column:
    pairs = [F.lit(part) for kind, texts in FLAG_TEXTS.items() for part in (kind, texts[position])]
    return F.create_map(*pairs)[F.col("flag_type")]


def _finished(flags: DataFrame) -> DataFrame:
    return flags.withColumns({"severity": _text_of(0), "description": _text_of(1)}).select(
        *FLAG_COLUMNS
    )


# Bits of the filter over the hashes of repeated ids: 1 MB, whatever the data.
FILTER_BITS = 1 << 23
WORD = 63


def _word_and_bit(hashed: Column) -> tuple[Column, Column]:
    place = F.pmod(hashed, F.lit(FILTER_BITS))
    return F.floor(place / WORD).cast("int"), (place % WORD).cast("int")


def repeated_ids(trades: DataFrame) -> DataFrame:
    """Ids that stand on more than one row (a null id is no id).

    Only ids are read and shuffled, merged inside the tasks first, so an id that many
    rows share is one row per task.
    """
    counted = trades.filter("trade_id is not null").groupBy("trade_id").agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter("_rows > 1").select("trade_id")


def may_repeat(ids: DataFrame) -> Column:
    """Whether a trade's id may be one of ``ids``: its bit in a filter over their hashes.

    The filter is an array of words of fixed size; it lets through every row of an id and
    some others, which an exact join has to take out.
    """
    word, bit = _word_and_bit(F.xxhash64("trade_id"))
    set_bit = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    met = ids.groupBy(word.alias("_word")).agg(F.bit_or(set_bit).alias("_bits"))
    # As many words as the filter has.
    words = ids.sparkSession.range(FILTER_BITS // WORD + 1).select(F.col("id").cast("int").alias("_word"))
    filled = words.join(met, "_word", "left").select(
        F.struct("_word", F.coalesce("_bits", F.lit(0).cast("long")).alias("_bits")).alias("_at")
    )
    array = filled.agg(F.transform(F.sort_array(F.collect_list("_at")), lambda at: at["_bits"])).scalar()
    is_set = F.call_function("shiftright", F.get(array, word), bit).bitwiseAND(F.lit(1).cast("long")) == 1
    return F.col("trade_id").isNotNull() & is_set


def flag_id_of(*keys: str) -> F.Column:
    """Flag id: type and keys; a null key counts as empty text."""
    return key_digest(
        F.col("flag_type"), *[F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys]
    )


def trade_flags(
    trades: DataFrame,
    securities: DataFrame,
    prices: DataFrame,
    kinds: Sequence[str] = TRADE_FLAGS,
) -> DataFrame:
    """One row per flag id for the asked kinds, all found in a single pass over the trades.

    Repeated trades are suspected by a filter of fixed size over the ids that repeat,
    which takes one more look at the ids alone, and checked once they are few.
    Reference data is looked up from the trade side, so a security or date that
    holds a large share of the trades is split by the skew join. Flag rows are
    reduced on their plain key columns, with partial aggregation before the
    shuffle, and only the survivors are hashed.
    """
    rows = trades
    if "UNKNOWN_SECURITY" in kinds or "MISSING_PRICE" in kinds:
        known = securities.select("security_id").distinct().withColumn("_known", F.lit(True))
        rows = rows.join(known, "security_id", "left")
    if "MISSING_PRICE" in kinds:
        priced = prices.select("security_id", F.col("price_date").alias("trade_date")).distinct()
        rows = rows.join(
            priced.withColumn("_priced", F.lit(True)), ["security_id", "trade_date"], "left"
        )
    conditions = {
        "DUPLICATE_TRADE": lambda: may_repeat(repeated_ids(trades)),
        "UNKNOWN_SECURITY": lambda: F.col("_known").isNull(),
        "MISSING_PRICE": lambda: F.col("_known") & F.col("_priced").isNull(),
        "INVALID_QUANTITY": lambda: F.coalesce(F.col("quantity") <= 0, F.lit(True)),
        "INVALID_PRICE": lambda: F.coalesce(F.col("execution_price") <= 0, F.lit(True)),
        "LATE_ARRIVING_TRADE": lambda: F.to_date("ingestion_timestamp") > F.col("trade_date"),
    }
    tests = [F.when(conditions[kind](), F.lit(kind)) for kind in kinds if kind in conditions]
    raised = F.array(*tests) if tests else F.array().cast("array<string>")
    # Rows without a flag go before they are written out by kind; both filters are compiled, array_compact is a lambda.
    any_raised = F.coalesce(*tests).isNotNull() if tests else F.lit(False)
    # Null and empty text give the same flag id, so they group together; whether a
    # real value was seen is kept beside.
    texts = ("trade_id", "account_id", "security_id")
    keys = ("trade_date", *texts)
    found = rows.filter(any_raised).select(F.explode(raised).alias("flag_type"), *keys).filter("flag_type is not null")
    flagged = (
        found.select(
            "flag_type",
            F.col("trade_date").alias("flag_date"),
            *[F.coalesce(name, F.lit("")).alias(name) for name in texts],
            *[F.col(name).isNotNull().alias(f"_has_{name}") for name in texts],
        )
        .groupBy("flag_type", "flag_date", *texts)
        .agg(*[F.max(f"_has_{name}").alias(f"_has_{name}") for name in texts])
    )
    if "DUPLICATE_TRADE" in kinds:
        suspect = F.col("flag_type") == "DUPLICATE_TRADE"
        exact = repeated_ids(trades).select(F.lit("DUPLICATE_TRADE").alias("flag_type"), "trade_id", F.lit(True).alias("_repeats"))
        flagged = flagged.join(exact, ["flag_type", "trade_id"], "left").filter(~suspect | F.col("_repeats")).drop("_repeats")
    flagged = flagged.withColumn("flag_id", flag_id_of(*texts, "flag_date")).withColumns(
        {name: F.when(F.col(f"_has_{name}"), F.col(name)) for name in texts}
    )
    return _finished(
        flagged.withColumns(
            {"affected_entity": F.lit("trades"), "affected_record_id": F.col("trade_id")}
        )
    )


def split_break_flags(reported: DataFrame, corporate_actions: DataFrame) -> DataFrame:
    """Reported quantity on a split date against the last earlier report times the ratio.

    Reports are first reduced to one per account, security and date (the lowest
    quantity where several differ), then each is compared with its predecessor.
    Of several splits on one date the one with the lowest action id counts.
    """
    splits = (
        corporate_actions.filter(
            (F.col("action_type") == SPLIT) & F.col("effective_date").isNotNull()
        )
        .groupBy("security_id", F.col("effective_date").alias("position_date"))
        .agg(F.min(F.struct("corporate_action_id", "split_ratio")).alias("_split"))
    )
    daily = (
        reported.join(splits.select("security_id").distinct(), "security_id", "left_semi")
        .filter(F.col("account_id").isNotNull() & F.col("position_date").isNotNull())
        .groupBy("account_id", "security_id", "position_date")
        .agg(F.min("reported_quantity").alias("_quantity"))
    )
    by_date = Window.partitionBy("account_id", "security_id").orderBy("position_date")
    expected = F.col("_previous") * F.col("_split.split_ratio")
    keys = ("account_id", "security_id", "position_date")
    return _finished(
        daily.withColumn("_previous", F.lag("_quantity").over(by_date))
        .join(splits, ["security_id", "position_date"])
        .filter(F.abs(F.col("_quantity") - expected) > 1e-9)
        .withColumns({"flag_type": F.lit(SPLIT_FLAG), "affected_entity": F.lit("reported_positions")})
        .withColumns(
            {
                "flag_id": key_digest(
                    F.col("flag_type"),
                    F.col("account_id"),
                    F.col("security_id"),
                    F.col("position_date").cast("string"),
                    F.col("_split.corporate_action_id"),
                ),
                "affected_record_id": F.concat_ws("|", *[F.col(key).cast("string") for key in keys]),
                "flag_date": F.col("position_date"),
            }
        )
    )


def trade_quality_flags(
    trades: DataFrame,
    securities: DataFrame,
    prices: DataFrame,
    reported: DataFrame,
    corporate_actions: DataFrame,
) -> DataFrame:
    """All flags. The two sets are unique on flag id and carry different types."""
    return trade_flags(trades, securities, prices).unionByName(
        split_break_flags(reported, corporate_actions)
    )


def flag_counts(flags: DataFrame) -> DataFrame:
    return flags.groupBy("flag_type").count().orderBy("flag_type")
