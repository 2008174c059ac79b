"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.schemas import CORRUPT_RECORD
from tallyspark.session import drop_folder, shared_folder, shuffles_go


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def scan_jsonl(spark: SparkSession, dataset: str, path: str, schema: str) -> DataFrame:
    """Read a file or folder of JSON lines under a fixed schema (no inference pass).

    A line that does not parse keeps its text in the corrupt-record column. A
    path that does not exist raises FileNotFoundError naming the dataset.
    """
    try:
        return (
            spark.read.schema(schema)
            .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
            .json(path)
        )
    except AnalysisException as error:
        if _missing(error):
            raise FileNotFoundError(f"Raw path does not exist for {dataset}: {path}") from error
        raise


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_layout(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """A table whose folders carry one of its columns; ``columns`` says what it holds, also where it is empty."""
    return spark.read.schema(columns).parquet(path)


def scan_first(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first of the candidate tables that exists."""
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if not _missing(error):
                raise
    raise FileNotFoundError("None of these tables exists: " + ", ".join(paths))


def count_by(column: str, kinds: Sequence[str], where: Column | None = None) -> dict[str, Column]:
    """Measures for a sink: rows of each of the known kinds, and of any other, where asked."""
    kind, asked = F.col(column), F.lit(True) if where is None else where
    measures = {f"{column}={name}": F.count_if(asked & (kind == name)) for name in kinds}
    other = asked & kind.isNotNull() & ~kind.isin(*kinds)
    return measures | {f"{column}=": F.count_if(other)}


def counted(measured: Mapping[str, int], column: str) -> dict[str, int] | None:
    """The kinds that occurred, from what a sink measured by ``count_by``; None where there were others."""
    if measured[f"{column}="]:
        return None
    found = {name.split("=", 1)[1]: rows for name, rows in measured.items() if name.startswith(f"{column}=")}
    return {kind: rows for kind, rows in sorted(found.items()) if rows}


def _observed(df: DataFrame, measures: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    seen = Observation()
    exprs = [measure.alias(name) for name, measure in measures.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *exprs), seen


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Overwrite the table and return its row count, counted while writing."""
    return sink_measured(df, path, partition_by)["rows"]


def sink_measured(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    measures: Mapping[str, Column] | None = None,
    touched_only: bool = False,
) -> dict[str, int]:
    """Overwrite the table and return ``rows`` and the measures, all taken in the write.

    With ``partition_by`` the rows are dealt by partition first, large partitions over
    several tasks and small ones together, so a partition has few files; within a
    file rows lie in order of ``cluster_by``, so its statistics tell readers which
    parts to skip. ``touched_only`` replaces only the partitions that ``df`` has rows
    of; the others stay as they are.
    """
    if partition_by and cluster_by:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    rows, seen = _observed(df, measures or {})
    # zstd: the same rows on less disk than Spark's default snappy; every reader decodes it.
    writer = rows.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if touched_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with shuffles_go(df.sparkSession):
        writer.parquet(path)
    return seen.get


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back, for who reads it more than once."""
    path = shared_folder(df.sparkSession)
    with shuffles_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sink_jsonl(df: DataFrame, path: str, order: Sequence[str] = ()) -> int:
    """Overwrite a folder of JSON lines, range-sorted over its files, and return its row count."""
    return sink_jsonl_measured(df, path, order)["rows"]


def sink_jsonl_measured(
    df: DataFrame,
    path: str,
    order: Sequence[str] = (),
    measures: Mapping[str, Column] | None = None,
    compression: str = "none",
) -> dict[str, int]:
    """Overwrite a folder of JSON lines, range-sorted over its files; ``rows`` and the measures.

    A range sort reads its input twice, first to sample it; so sorted rows are
    computed once into a table of their own and sorted from there. With
    ``compression`` (e.g. ``gzip``) each file is compressed whole; readers
    decompress by file name, lines and their order stay.
    """
    if order:
        spark = df.sparkSession
        staged = shared_folder(spark)
        measured = sink_measured(df, staged, measures=measures)
        sorted_rows = scan_parquet(spark, staged).orderBy(*order)
        with shuffles_go(spark):
            sorted_rows.write.mode("overwrite").option("compression", compression).json(path)
        drop_folder(spark, staged)
        return measured
    rows, seen = _observed(df, measures or {})
    with shuffles_go(df.sparkSession):
        rows.write.mode("overwrite").option("compression", compression).json(path)
    return seen.get


# Layout of one corpus document.
CORPUS_SCHEMA = (
    "document_id string, document_type string, account_id string, security_id string, "
    "position_date date, event_date date, title string, text string, "
    "source_tables array<string>, metadata map<string,string>"
)
CORPUS_ORDER = ("document_type", "security_id", "account_id", "position_date", "event_date", "document_id", "text")


def sink_corpus(corpus: DataFrame, path: str, measures: Mapping[str, Column] | None = None) -> dict[str, int]:
    """The corpus as gzipped JSON lines: the same lines at a fraction of the disk of plain text."""
    return sink_jsonl_measured(corpus, path, CORPUS_ORDER, measures, "gzip")


def with_places(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a sorted folder with their ``place`` from 0: by file, then by line.

    A task reads the lines of a block of a file in order, so a line's place is the
    rows of all blocks before its own and those before it in the block.
    """
    lines = spark.read.schema(schema).json(path)
    file = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    block = {"_file": file, "_block": F.col("_metadata.file_block_start")}
    located = lines.withColumns({**block, "_at": F.monotonically_increasing_id()})
    sizes = located.groupBy(*block).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    starts = sizes.select(*block, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    first = F.min("_at").over(Window.partitionBy(*block))
    return (
        located.withColumn("_within", F.col("_at") - first)
        .join(starts, list(block))
        .withColumn("place", F.col("_before") + F.col("_within"))
        .drop(*block, "_at", "_within", "_before")
    )


def scan_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Corpus documents; blank lines are skipped. The order is that of the files."""
    return spark.read.schema(CORPUS_SCHEMA).json(path)
