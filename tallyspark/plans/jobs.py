"""The batch jobs. Layers meet only through stored tables, so a lost executor or a
failed job costs at most its own layer; every table is written once, counted while
written and read back by whoever needs it."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.operators import corpus as corpus_ops
from tallyspark.operators import splits
from tallyspark.operators.breaks import break_summary, reconciliation_breaks
from tallyspark.operators.bronze import bronze_metadata, is_no_record, quarantine
from tallyspark.operators.cleaning import clean
from tallyspark.operators.events import event_keys, event_window_metrics, window_measures
from tallyspark.operators.grounding import groundedness
from tallyspark.operators.investigation import investigation_packet
from tallyspark.operators.metric_index import build_index, open_index
from tallyspark.operators.positions import BREAK, MATCH, MISMATCH, NOT_REPORTED, SIGNALS, position_reconstruction
from tallyspark.operators.quality import FLAG_TEXTS, flag_counts, trade_quality_flags
from tallyspark.operators.vectors import Search, similarity_retriever, vector_table
from tallyspark.session import configure
from tallyspark.sources import files


@dataclass
class JobResult:
    """Rows written per table, and the job's summary table as plain rows."""

    rows: dict[str, int] = field(default_factory=dict)
    summary: list[dict] = field(default_factory=list)


class Lake:
    """The stored tables below one root folder.

    ``by_day`` gives positions, breaks and flags a folder per day. Where a day is far
    below a file's size the folders cost more than their rows; without them the rows of
    a file lie by day, then account and security, and days can't be replaced alone.
    """

    def __init__(self, spark: SparkSession, root: str, by_day: bool = True):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.by_day = by_day

    def path(self, relative: str) -> str:
        return f"{self.root}/{relative}"

    def read(self, relative: str) -> DataFrame:
        layout = schemas.LAYOUTS.get(relative)
        if layout:
            return files.scan_layout(self.spark, self.path(relative), layout.columns)
        return files.scan_parquet(self.spark, self.path(relative))

    def write(self, df: DataFrame, relative: str) -> int:
        return self.write_measured(df, relative)["rows"]

    def write_measured(
        self,
        df: DataFrame,
        relative: str,
        measures: Mapping[str, Column] | None = None,
        touched_only: bool = False,
    ) -> dict[str, int]:
        """Write a table in its layout, counted while written."""
        layout = schemas.LAYOUTS.get(relative)
        by, order = ((layout.partition_by,), layout.cluster_by) if layout else ((), ())
        if not self.by_day:
            if touched_only:
                raise ValueError(f"{relative} has no folders by day, so single days can't be replaced")
            by, order = (), (*by, *order)
        return files.sink_measured(df, self.path(relative), by, order, measures, touched_only)

    def bronze(self, name: str) -> DataFrame:
        return self.read(schemas.TABLES[name].bronze)

    def silver(self, name: str) -> DataFrame:
        if name == "filing_events":
            return files.scan_first(self.spark, [self.path(p) for p in schemas.SILVER_EVENTS])
        if name == "flags":
            return self.read(schemas.SILVER_FLAGS)
        return self.read(schemas.TABLES[name].silver)


def _stamped(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def _rows(df: DataFrame) -> list[dict]:
    """A summary table: its size is fixed by the kinds it counts, not by the data."""
    return [row.asDict() for row in df.collect()]


def ingest_dataset(lake: Lake, name: str, load_id: str) -> int:
    spec = schemas.TABLES[name]
    raw = files.scan_jsonl(lake.spark, name, lake.path(spec.raw), spec.schema)
    stamped = bronze_metadata(raw, load_id)
    found = Observation()
    broken = F.col(schemas.CORRUPT_RECORD).isNotNull()
    seen = stamped.observe(
        found,
        F.count_if(broken).alias("broken"),
        F.collect_set(F.when(broken, F.col("_source_file"))).alias("files"),  # the driver lists all files anyway
    )
    rows = lake.write(seen.filter(~is_no_record()), spec.bronze)
    if found.get["broken"]:  # counted in the write; only then are those lines read again, from the files they stand in
        of_files = stamped.filter(F.col("_source_file").isin(*found.get["files"]))
        lake.write(quarantine(name, of_files), f"{schemas.QUARANTINE}/{name}")
    return rows


def run_bronze_ingestion(lake: Lake, load_id: str | None = None) -> JobResult:
    """Raw JSON lines to bronze tables; lines that are no records go to the quarantine."""
    load = load_id or str(uuid.uuid4())
    return JobResult({name: ingest_dataset(lake, name, load) for name in schemas.TABLES})


def run_silver_cleaning(lake: Lake) -> JobResult:
    """Bronze to clean, split-adjusted silver tables, and the quality flags."""
    cleaned = {
        name: clean(name, lake.bronze(name)) for name, spec in schemas.TABLES.items() if spec.silver
    }
    actions = cleaned["corporate_actions"]
    # Stored once: four tables are adjusted by it.
    lake.write(splits.split_factors(cleaned["prices"], actions), schemas.SPLIT_FACTORS)
    factors = lake.read(schemas.SPLIT_FACTORS)
    adjust = {
        "prices": splits.adjust_prices,
        "starting_positions": splits.adjust_starting_positions,
        "trades": splits.adjust_trades,
        "reported_positions": splits.adjust_reported_positions,
    }
    result = JobResult()
    for name, table in cleaned.items():
        adjusted = adjust[name](table, factors) if name in adjust else table
        result.rows[name] = lake.write(adjusted, schemas.TABLES[name].silver)
    flags = trade_quality_flags(
        lake.silver("trades"),
        lake.silver("securities"),
        lake.silver("prices"),
        lake.silver("reported_positions"),
        lake.silver("corporate_actions"),
    )
    measured = lake.write_measured(
        _stamped(flags, "_silver_processed_at"), schemas.SILVER_FLAGS, files.count_by("flag_type", tuple(FLAG_TEXTS))
    )
    result.rows["flags"] = measured["rows"]
    kinds = files.counted(measured, "flag_type")
    result.summary = (
        _rows(flag_counts(lake.silver("flags")))
        if kinds is None
        else [{"flag_type": kind, "count": rows} for kind, rows in kinds.items()]
    )
    return result


REASONS = (NOT_REPORTED, MATCH, *SIGNALS, MISMATCH)


def _reconciled(measured: Mapping[str, int]) -> list[dict] | None:
    """The rows of ``break_summary`` from what the write measured; None where codes are unknown."""
    views = {"status": "reconciliation_status", "break_reason": "break_reason_code", "root_cause": "root_cause_reason_code"}
    found = {measure: files.counted(measured, column) for measure, column in views.items()}
    if None in found.values():
        return None
    total = {"total": {"ALL": measured["rows"]}} if measured["rows"] else {}
    return [
        {"measure": measure, "value": value, "rows": rows}
        for measure, counts in sorted((found | total).items())
        for value, rows in counts.items()
    ]


def run_gold_reconciliation(
    lake: Lake, tolerance: float = 0.0, first: datetime.date | None = None, last: datetime.date | None = None
) -> JobResult:
    """Silver to reconstructed positions and the break table.

    With ``first`` or ``last`` only the days between them are written anew, null dates
    with the first; the other days of both tables stay as they are stored. The summary
    is of the days written.
    """
    days = _between("position_date", first, last)
    some = first is not None or last is not None
    positions = position_reconstruction(
        lake.silver("securities"),
        lake.silver("starting_positions"),
        lake.silver("trades"),
        lake.silver("reported_positions"),
        lake.silver("flags"),
        tolerance,
    )
    is_break = F.col("reconciliation_status") == BREAK
    measures = (
        files.count_by("reconciliation_status", (MATCH, BREAK))
        | files.count_by("break_reason_code", REASONS, is_break)
        | files.count_by("root_cause_reason_code", REASONS, is_break)
    )
    measured = lake.write_measured(
        _stamped(positions.filter(days), "_gold_processed_at"), schemas.GOLD_POSITIONS, measures, some
    )
    stored = lake.read(schemas.GOLD_POSITIONS).filter(days)
    breaks = lake.write_measured(reconciliation_breaks(stored), schemas.GOLD_BREAKS, touched_only=some)
    result = JobResult({"position_reconstruction": measured["rows"], "reconciliation_breaks": breaks["rows"]})
    summary = _reconciled(measured)
    result.summary = _rows(break_summary(stored)) if summary is None else summary
    return result


def _between(column: str, first: datetime.date | None, last: datetime.date | None) -> Column:
    """Whether a date lies between two days; an open end takes all, an open beginning the null date too."""
    date, test = F.col(column), F.lit(True)
    if first is not None:
        test = test & (date >= F.lit(first))
    if last is not None:
        test = test & ((date <= F.lit(last)) | (date.isNull() if first is None else F.lit(False)))
    return test


def run_gold_event_window(lake: Lake) -> JobResult:
    """Event-window metrics from silver prices and events and gold positions."""
    events = lake.silver("filing_events")
    metrics = event_window_metrics(
        lake.silver("prices"), events, lake.read(schemas.GOLD_POSITIONS)
    )
    measured = lake.write_measured(
        _stamped(metrics, "_gold_processed_at"), schemas.GOLD_EVENT_WINDOWS, window_measures()
    )
    output = measured.pop("rows")
    summary = {"output_rows": output, **measured, "partial_windows": output - measured["full_windows"]}
    return JobResult({"event_window_metrics": output}, [summary | {"events": event_keys(events).first()[0]}])


def run_build_investigation_corpus(lake: Lake) -> JobResult:
    """Gold and silver tables to corpus documents as JSON lines."""
    corpus = corpus_ops.investigation_corpus(
        lake.read(schemas.GOLD_BREAKS),
        lake.read(schemas.GOLD_EVENT_WINDOWS),
        lake.silver("filing_events"),
        lake.silver("flags"),
        lake.silver("trades"),
    )
    path = lake.path(schemas.CORPUS)
    kinds = (corpus_ops.BREAK_DOC, corpus_ops.EVENT_DOC, corpus_ops.QUALITY_DOC)
    measured = files.sink_corpus(corpus, path, files.count_by("document_type", kinds))
    counts = files.counted(measured, "document_type") or {}
    summary = [{"document_type": kind, "count": rows} for kind, rows in counts.items()]
    return JobResult({"investigation_corpus": measured["rows"]}, summary)


def run_build_vector_table(lake: Lake, vectors: DataFrame | None = None) -> JobResult:
    """Corpus to the table of documents with vectors."""
    corpus = lake.spark.read.schema(files.CORPUS_SCHEMA).json(lake.path(schemas.CORPUS))
    return JobResult({"vectors": lake.write(vector_table(corpus, vectors), schemas.VECTORS)})


def run_build_vector_index(lake: Lake, metric: str = "l2") -> JobResult:
    """The stored vectors to the index that searches go by; the metric belongs to the index."""
    index = build_index(lake.read(schemas.VECTORS), lake.path(schemas.VECTOR_INDEX), metric)
    return JobResult({"vector_index": index.rows})


def _search(lake: Lake) -> Search | None:
    """The search of the stored index, if one was built."""
    try:
        return open_index(lake.spark, lake.path(schemas.VECTOR_INDEX)).search
    except FileNotFoundError:
        return None


def _vectors(lake: Lake) -> DataFrame | None:
    """The table of document vectors, if one was built."""
    try:
        return files.scan_first(lake.spark, [lake.path(schemas.VECTORS)])
    except FileNotFoundError:
        return None


def query_vector_table(
    lake: Lake, queries: DataFrame, k: int = 5, asked: DataFrame | None = None
) -> DataFrame:
    """Nearest documents with distance and metadata for a table of (query_id, query)."""
    return similarity_retriever(queries, lake.read(schemas.VECTORS), k, asked, _search(lake))


def run_investigation(
    lake: Lake, queries: DataFrame, k: int = 5, asked: DataFrame | None = None
) -> DataFrame:
    """Packets for a table of (query_id, query); without document vectors the evidence is empty."""
    return investigation_packet(
        queries,
        lake.read(schemas.GOLD_BREAKS),
        lake.silver("flags"),
        lake.read(schemas.GOLD_EVENT_WINDOWS),
        lake.silver("filing_events"),
        _vectors(lake),
        k,
        asked,
        _search(lake),
    )


def evaluate_investigation(
    lake: Lake, queries: DataFrame, k: int = 5, asked: DataFrame | None = None
) -> DataFrame:
    """Packets for a table of questions, scored."""
    return groundedness(run_investigation(lake, queries, k, asked))
