"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_id(column: str) -> Column:
    """Identifiers compare trimmed and in upper case."""
    return F.upper(F.trim(F.col(column)))


def normalized_text(column: str) -> Column:
    return F.trim(F.col(column))


def standard_side(column: str) -> Column:
    """BUY or SELL; an unknown side is kept in its normalized form."""
    side = normalized_id(column)
    return (
        F.when(side.isin("B", "BUY"), F.lit("BUY"))
        .when(side.isin("S", "SELL"), F.lit("SELL"))
        .otherwise(side)
    )


def key_digest(*parts: Column) -> Column:
    """SHA-256 of the parts joined by two pipes; null parts are left out."""
    return F.sha2(F.concat_ws("||", *parts), 256)


def guarded_ratio(numerator: Column, base: Column) -> Column:
    """numerator / base, null where the base is null or zero."""
    return F.when(base != 0, numerator / base)


def add_business_days(date: Column, days: int) -> Column:
    """Shift by weekdays (no holidays); a weekend date counts from its Friday."""
    weekday = F.weekday(date)
    friday = F.date_sub(date, F.greatest(weekday - 4, F.lit(0)))
    from_monday = F.least(weekday, F.lit(4)) + days
    return F.date_add(friday, (F.lit(days) + F.floor(from_monday / 5) * 2).cast("int"))


def python_text(column: Column, type_name: str) -> Column:
    """The text Python's ``str`` gives for a value of this type; null stays null."""
    if type_name == "boolean":
        return F.initcap(column.cast("string"))
    text = column.cast("string")
    if type_name not in ("double", "float"):
        return text
    size = F.abs(column)
    plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    exponent = F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    scientific = F.format_string(
        "%se%s%02d", mantissa, F.when(exponent < 0, "-").otherwise("+"), F.abs(exponent)
    )
    return (
        F.when(column.isNull() | ~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )
