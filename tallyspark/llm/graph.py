"""Connected components by alternating stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyspark.llm.store import settle


def _with_least(edges: DataFrame) -> DataFrame:
    """Each (node, other) with the least of node and its others; partial minima keep a hub cheap."""
    least = edges.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
    return edges.join(least, "node")


def _round(edges: DataFrame) -> DataFrame:
    """Large star, then small star, over edges (a < b)."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    large = _with_least(both).filter("other > node").select(F.col("least").alias("a"), F.col("other").alias("b"))
    small = large.filter("a < b").select(F.col("b").alias("node"), F.col("a").alias("other"))
    starred = _with_least(small)
    return (
        starred.select(F.col("least").alias("a"), F.col("other").alias("b"))
        .unionAll(starred.select(F.col("least").alias("a"), F.col("node").alias("b")))
        .filter("a < b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node with an edge (columns a, b); component is the least node."""
    ordered = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    current, state = _settled(ordered)
    while True:
        following, seen = _settled(_round(current))
        if seen == state:
            break
        current, state = following, seen
    stars = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.unionAll(current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, and what tells whether they changed, seen while they were written."""
    seen = Observation()
    checks = (F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("sum"))
    written = settle(edges.observe(seen, *checks))
    return written, (seen.get["rows"], seen.get["sum"])
