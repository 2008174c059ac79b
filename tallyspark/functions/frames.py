"""DataFrame helpers: copies, calendars, as-of lookup, per-key top rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows one generator call writes at most: a row with billions of copies must not
# become one array.
COPY_CHUNK = 4096


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def repeat_rows(df: DataFrame, copies: str, ordinal: str) -> DataFrame:
    """Write each row ``copies`` times, numbered from 1 in ``ordinal``."""
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / COPY_CHUNK).cast("int")))
    left = F.col(copies) - F.col("_chunk").cast("long") * COPY_CHUNK
    within = F.explode(F.sequence(F.lit(1), F.least(left, F.lit(COPY_CHUNK)).cast("int")))
    return (
        df.withColumn("_chunk", chunk)
        .withColumn("_within", within)
        .withColumn(ordinal, F.col("_chunk").cast("long") * COPY_CHUNK + F.col("_within"))
        .drop("_chunk", "_within", copies)
    )


def calendar_of(dates: DataFrame, date: str) -> Column:
    """All distinct dates of a column as one sorted array, a null date last.

    The distinct dates are bounded by the days of a calendar, whatever the data size,
    so they travel as one literal.
    """
    day = F.col(date)
    found = dates.select(day.cast("date").alias(date)).distinct().agg(
        F.when(
            F.max(day.isNull()), F.array_append(F.sort_array(F.collect_list(day)), F.lit(None).cast("date"))
        ).otherwise(F.sort_array(F.collect_list(day)))
    )
    return found.scalar()


def every_date(keys: DataFrame, dates: DataFrame, date: str) -> DataFrame:
    """Each key row once per distinct date, a null date included.

    The key rows are written out in place: no join and no shuffle of the dense result.
    """
    return keys.withColumn(date, F.explode(calendar_of(dates, date)))


def asof(
    left: DataFrame,
    right: DataFrame,
    *,
    by: str,
    left_on: str,
    right_on: str,
    take: Sequence[str],
    forward: bool = False,
    exact: bool = True,
) -> DataFrame:
    """Attach to each distinct (by, left_on) the nearest right row at or before it.

    ``forward`` looks at or after instead; ``exact=False`` leaves equal points
    out. Both sides go through one shuffle and one ordered pass, never through
    row pairs. Callers pass sides already reduced to one row per point, so a
    group holds at most two rows per calendar point.
    """
    points = left.select(F.col(by), F.col(left_on).alias("_at")).distinct()
    asked = points.select(by, "_at", F.lit(True).alias("_asked"))
    known = right.filter(F.col(right_on).isNotNull()).select(
        by,
        F.col(right_on).alias("_at"),
        F.lit(False).alias("_asked"),
        F.struct(*take).alias("_found"),
    )
    at = F.col("_at").desc() if forward else F.col("_at").asc()
    tie = F.col("_asked").asc() if exact else F.col("_asked").desc()
    ordered = Window.partitionBy(by).orderBy(at, tie).rowsBetween(Window.unboundedPreceding, 0)
    usable = F.col("_at").isNotNull() & F.col(by).isNotNull()
    return (
        asked.unionByName(known, allowMissingColumns=True)
        .withColumn("_found", F.last("_found", ignorenulls=True).over(ordered))
        .filter("_asked")
        .select(
            by,
            F.col("_at").alias(left_on),
            *[F.when(usable, F.col("_found")[name]).alias(name) for name in take],
        )
    )


def top_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    """The first k rows of each group, numbered from 1.

    Spark cuts each input partition to k rows per group before the shuffle, so a
    hot group never meets in one task whole.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
