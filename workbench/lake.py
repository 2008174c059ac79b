"""The stored ledger of one test folder, built once per session layer by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions.frames import union_all
from tallyspark.operators.metric_index import open_index
from tallyspark.plans import jobs
from tallyspark.session import drop_folder, shared_folder, shuffles_go
from workbench.views import RAW_TABLES, RawLedger

QUESTIONS = "retrieval/questions"


def _write_questions(lake: jobs.Lake) -> jobs.JobResult:
    """One question per pair with a break, on its last break date, and vaguer ones per
    security and per account."""
    last = F.max("position_date").cast("string")
    breaks = lake.read(schemas.GOLD_BREAKS).filter("position_date is not null")
    pairs = breaks.groupBy("account_id", "security_id").agg(last.alias("day"))
    securities = breaks.groupBy("security_id").agg(last.alias("day"))
    accounts = breaks.select(F.lower("account_id").alias("account_id")).distinct()
    texts = [
        pairs.select(F.format_string("Why is %s %s broken on %s?", "account_id", "security_id", "day")),
        securities.select(F.format_string("What happened to %s on %s?", "security_id", "day")),
        securities.select(F.format_string("Show event context for %s", F.lower("security_id"))),
        accounts.select(F.format_string("List duplicate trade flags of %s", "account_id")),
        breaks.groupBy().agg(F.max(F.lit("Summarise all open breaks"))),
    ]
    table = union_all([part.toDF("query") for part in texts])
    rows = lake.write(table.select(F.sha2("query", 256).alias("query_id"), "query"), QUESTIONS)
    return jobs.JobResult({"questions": rows})


LAYERS = {
    "raw": (None, None),
    "bronze": ("raw", jobs.run_bronze_ingestion),
    "silver": ("bronze", jobs.run_silver_cleaning),
    "positions": ("silver", jobs.run_gold_reconciliation),
    "events": ("positions", jobs.run_gold_event_window),
    "corpus": ("events", jobs.run_build_investigation_corpus),
    "vectors": ("corpus", jobs.run_build_vector_table),
    "index": ("vectors", jobs.run_build_vector_index),
    "questions": ("positions", _write_questions),
}


class LedgerLake(jobs.Lake):
    def __init__(self, spark: SparkSession, sf_dir: str):
        # A day of the test tables is some hundred rows.
        super().__init__(spark, shared_folder(spark), by_day=False)
        self.raw = RawLedger(spark, sf_dir)
        self.results: dict[str, jobs.JobResult] = {}
        self._frames: dict[str, DataFrame] = {}

    def read(self, relative: str) -> DataFrame:
        """Each table is written once, so its DataFrame may be kept."""
        if relative not in self._frames:
            self._frames[relative] = super().read(relative)
        return self._frames[relative]

    def ensure(self, layer: str) -> "LedgerLake":
        if layer in self.results:
            return self
        before, job = LAYERS[layer]
        if before is None:
            # Raw files are gzipped JSON lines, as feeds often come: their rows are the same,
            # their disk a fraction of plain text. The readers decompress by file name.
            self.raw.keep_lines()
            for name in RAW_TABLES:
                path = self.path(schemas.TABLES[name].raw)
                with shuffles_go(self.spark):
                    self.raw.table(name).write.mode("overwrite").option("compression", "gzip").json(path)
            broken = self.path(schemas.TABLES["trades"].raw)
            self.raw.broken_lines().select("line").write.mode("append").option("compression", "gzip").text(broken)
            self.raw.drop_lines()
            self.results[layer] = jobs.JobResult()
        else:
            self.ensure(before)
            self.results[layer] = job(self)
        return self

    def positions(self) -> DataFrame:
        return self.ensure("positions").read(schemas.GOLD_POSITIONS)

    def breaks(self) -> DataFrame:
        return self.ensure("positions").read(schemas.GOLD_BREAKS)

    def metrics(self) -> DataFrame:
        return self.ensure("events").read(schemas.GOLD_EVENT_WINDOWS)

    def corpus(self) -> DataFrame:
        path = self.ensure("corpus").path(schemas.CORPUS)
        return jobs.files.scan_corpus(self.spark, path)

    def documents(self) -> DataFrame:
        return self.ensure("vectors").read(schemas.VECTORS)

    def search(self):
        """The search of the stored index of the documents."""
        return open_index(self.spark, self.ensure("index").path(schemas.VECTOR_INDEX)).search

    def clean(self, name: str) -> DataFrame:
        """A silver table."""
        return self.ensure("silver").silver(name)

    def questions(self) -> DataFrame:
        """The stored table of questions."""
        return self.ensure("questions").read(QUESTIONS)


_OPEN: dict[tuple[str, str], LedgerLake] = {}


def lake_for(spark: SparkSession, sf_dir: str) -> LedgerLake:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = LedgerLake(spark, sf_dir)
    return _OPEN[key]


def drop_lakes(spark: SparkSession) -> None:
    """Remove the stored layers of this session."""
    for key in [key for key in _OPEN if key[0] == spark.sparkContext.applicationId]:
        drop_folder(spark, _OPEN.pop(key).root)
