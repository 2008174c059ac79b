import datetime

import pytest
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.operators import bronze, breaks, corpus, investigation, quality
from tallyspark.plans import jobs
from tallyspark.sources import files

DAYS = [datetime.date(2024, 1, day) for day in range(1, 11)]


def positions(spark, days=DAYS):
    rows = [
        (f"ACC00{a}", f"SEC00{s}", day, 1.0, 0.0, 0.0, 5.0, None if a == s else 5.0 + a, None if a == s else float(a),
         "BREAK", "POSITION_NOT_REPORTED" if a == s else "QUANTITY_MISMATCH", "QUANTITY_MISMATCH", day, 0, False, None)
        for day in days for a in (1, 2) for s in (1, 2, 3)
    ]
    return spark.createDataFrame(rows, schemas.LAYOUTS[schemas.GOLD_POSITIONS].columns)


@pytest.fixture
def lake(spark, tmp_path):
    return jobs.Lake(spark, str(tmp_path))


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [part for part in plan.split("FileScan")[1:]]


def test_one_day_is_rewritten_alone(spark, lake):
    lake.write(positions(spark), schemas.GOLD_POSITIONS)
    before = {r.file: r.time for r in _files(lake)}
    day = positions(spark, [DAYS[4]]).withColumn("expected_position", F.lit(9.0))
    assert lake.write_measured(day, schemas.GOLD_POSITIONS, touched_only=True)["rows"] == 6
    after = {r.file: r.time for r in _files(lake)}
    untouched = {file for file in before if "2024-01-05" not in file}
    assert len(untouched) >= 9 and all(after[file] == before[file] for file in untouched)
    stored = lake.read(schemas.GOLD_POSITIONS)
    assert stored.count() == 60
    assert {r.position_date for r in stored.filter("expected_position = 9.0").collect()} == {DAYS[4]}


def _files(lake):
    names = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("time")
    return lake.read(schemas.GOLD_POSITIONS).select(*names).distinct().collect()


def test_without_folders_by_day(spark, lake):
    flat = jobs.Lake(spark, lake.path("flat"), by_day=False)
    flat.write(positions(spark), schemas.GOLD_POSITIONS)
    stored = flat.read(schemas.GOLD_POSITIONS)
    assert sorted(stored.collect(), key=str) == sorted(positions(spark).select(*stored.columns).collect(), key=str)
    rows = stored.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), "position_date", "account_id")
    by_file = {}
    for r in rows.orderBy("file", "at").collect():
        by_file.setdefault(r.file, []).append((r.position_date, r.account_id))
    assert by_file and all(found == sorted(found) for found in by_file.values())
    with pytest.raises(ValueError, match="by day"):
        flat.write_measured(positions(spark), schemas.GOLD_POSITIONS, touched_only=True)


def test_full_write_drops_days_that_are_gone(spark, lake):
    lake.write(positions(spark), schemas.GOLD_POSITIONS)
    lake.write(positions(spark, DAYS[:2]), schemas.GOLD_POSITIONS)
    assert lake.read(schemas.GOLD_POSITIONS).count() == 12


def test_empty_tables_and_null_dates_read_back(spark, lake):
    lake.write(positions(spark).filter("false"), schemas.GOLD_POSITIONS)
    stored = lake.read(schemas.GOLD_POSITIONS)
    assert stored.count() == 0 and dict(stored.dtypes)["position_date"] == "date"
    lake.write(positions(spark, [None]), schemas.GOLD_POSITIONS)
    assert [r.position_date for r in lake.read(schemas.GOLD_POSITIONS).collect()] == [None] * 6


def test_rows_lie_in_order_within_a_file(spark, lake):
    lake.write(positions(spark).repartition(5), schemas.GOLD_POSITIONS)
    rows = lake.read(schemas.GOLD_POSITIONS).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), "account_id", "security_id"
    )
    by_file = {}
    for r in rows.orderBy("file", "at").collect():
        by_file.setdefault(r.file, []).append((r.account_id, r.security_id))
    assert by_file and all(found == sorted(found) for found in by_file.values())
    assert len(by_file) == len(DAYS)  # a small day is one file


def test_lookups_read_only_the_days_asked_about(spark, lake):
    lake.write(positions(spark), schemas.GOLD_POSITIONS)
    lake.write(breaks.reconciliation_breaks(lake.read(schemas.GOLD_POSITIONS)), schemas.GOLD_BREAKS)
    stored = lake.read(schemas.GOLD_BREAKS)
    queries = [("q1", "Why is ACC001 SEC002 broken on 2024-01-03?"), ("q2", "acc002 sec001 2024-01-04"), ("q3", "ACC001")]
    parsed = investigation.parse_query(spark.createDataFrame(queries, "query_id string, query string"))
    found = investigation.lookup_break(parsed, stored)
    assert sorted((r.query_id, r.position_date.day) for r in found.collect()) == [("q1", 3), ("q2", 4)]
    assert any("PartitionFilters: [isnotnull(position_date" in scan or "array_contains" in scan for scan in scans(found))
    between = stored.filter((F.col("position_date") >= F.lit(DAYS[2])) & (F.col("position_date") < F.lit(DAYS[4])))
    documents = corpus.docs_breaks(between)
    assert documents.count() == 12
    assert any("PartitionFilters: [isnotnull(position_date" in scan for scan in scans(documents))


def test_flag_lookup_reads_all_days_only_for_an_undated_question(spark, lake):
    rows = [
        (f"f{day.day}", "INVALID_PRICE", "trades", "t", "ACC001", "SEC001", day, "HIGH", "x", None) for day in DAYS
    ]
    lake.write(spark.createDataFrame(rows, schemas.LAYOUTS[schemas.SILVER_FLAGS].columns), schemas.SILVER_FLAGS)
    flags = lake.read(schemas.SILVER_FLAGS)

    def found(text):
        parsed = investigation.parse_query(spark.createDataFrame([("q", text)], "query_id string, query string"))
        result = investigation.lookup_flags(parsed, flags)
        assert any("array_contains" in scan for scan in scans(result))
        return result.count()

    assert found("ACC001 on 2024-01-03") == 1 and found("ACC001") == 10 and found("ACC001 on 2031-01-03") == 0


def test_days_between(spark, lake):
    df = spark.createDataFrame([(day,) for day in [*DAYS, None]], "position_date date")

    def count(first, last):
        return df.filter(jobs._between("position_date", first, last)).count()

    assert count(None, None) == 11 and count(DAYS[3], None) == 7
    assert count(None, DAYS[3]) == 5 and count(DAYS[3], DAYS[5]) == 3


def test_summaries_come_from_the_write(spark, lake):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3), (None, 4), ("?", 5)], "kind string, n int")
    path = lake.path("table")
    measured = files.sink_measured(df, path, measures=files.count_by("kind", ("A", "B", "C")))
    assert measured["rows"] == 5 and files.counted(measured, "kind") is None
    known = df.filter("kind is null or kind <> '?'")
    measured = files.sink_measured(known, path, measures=files.count_by("kind", ("A", "B", "C"), F.col("n") > 1))
    assert files.counted(measured, "kind") == {"A": 1, "B": 1}
    table = positions(spark)
    is_break = F.col("reconciliation_status") == "BREAK"
    measures = (
        files.count_by("reconciliation_status", ("MATCH", "BREAK"))
        | files.count_by("break_reason_code", jobs.REASONS, is_break)
        | files.count_by("root_cause_reason_code", jobs.REASONS, is_break)
    )
    measured = lake.write_measured(table, schemas.GOLD_POSITIONS, measures)
    want = [row.asDict() for row in breaks.break_summary(table).collect()]
    assert sorted(map(str, jobs._reconciled(measured))) == sorted(map(str, want))


def test_broken_lines_go_to_the_quarantine(spark, lake, tmp_path):
    folder = tmp_path / "raw" / "starting_positions"
    folder.mkdir(parents=True)
    lines = [
        '{"account_id": "ACC001", "security_id": "SEC001", "position_date": "2024-01-01", "quantity": 3.0}',
        '{"account_id": "ACC002", "security_id": "SEC001", "position_date": "2024-01-01", "quantity": "many"}',
        '{"account_id": "ACC0', "plain text", '"a string"', "17",
    ]
    (folder / "part.jsonl").write_text("\n".join(lines) + "\n\n")
    assert jobs.ingest_dataset(lake, "starting_positions", "load") == 2
    kept = {r.account_id: r.quantity for r in lake.bronze("starting_positions").collect()}
    assert kept == {"ACC001": 3.0, "ACC002": None}
    found = lake.read(f"{schemas.QUARANTINE}/starting_positions").collect()
    assert {(r.line, r.reason) for r in found} == {
        (lines[1], bronze.OTHER_TYPE),
        (lines[2], bronze.NOT_JSON),
        (lines[3], bronze.NOT_JSON),
        (lines[4], bronze.NOT_A_RECORD),
        (lines[5], bronze.NOT_A_RECORD),
    }
    assert all(r._source_file.endswith("part.jsonl") and r.dataset == "starting_positions" for r in found)


def test_only_files_with_broken_lines_are_read_again(spark, lake, tmp_path, monkeypatch):
    folder = tmp_path / "raw" / "starting_positions"
    folder.mkdir(parents=True)
    fine = '{"account_id": "ACC00%d", "security_id": "SEC001", "position_date": "2024-01-01", "quantity": 3.0}'
    for at in range(4):
        (folder / f"fine {at}.jsonl").write_text(fine % at + "\n")
    (folder / "odd name%20\u00e9.jsonl").write_text(fine % 7 + "\nplain text\nplain text\n")
    (folder / "other.jsonl").write_text("17\n")
    read = []
    whole = jobs.quarantine
    monkeypatch.setattr(jobs, "quarantine", lambda name, rows: read.append(rows) or whole(name, rows))
    assert jobs.ingest_dataset(lake, "starting_positions", "load") == 5
    found = [(r.line, r.reason) for r in lake.read(f"{schemas.QUARANTINE}/starting_positions").collect()]
    assert sorted(found) == [("17", bronze.NOT_A_RECORD)] + [("plain text", bronze.NOT_JSON)] * 2
    again = {r._source_file.rsplit("/", 1)[1][:5] for r in read[0].select("_source_file", "_bronze_load_id").collect()}
    assert again == {"odd%2", "other"}


def test_places_of_sorted_lines(spark, tmp_path):
    df = spark.range(1000).select(F.format_string("k%05d", (F.col("id") * 7919) % 1000).alias("k"))
    path = str(tmp_path / "sorted")
    assert files.sink_jsonl(df.repartition(6), path, ["k"]) == 1000
    for size in ("128m", "2k"):  # whole files, and files in several blocks
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = sorted((r.place, r.k) for r in files.with_places(spark, path, "k string").collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert found == [(i, f"k{i:05d}") for i in range(1000)]


def test_repeated_trades_by_a_small_filter(spark, monkeypatch):
    """Ids that share a bit with a repeated one are suspects, and no more than that."""
    monkeypatch.setattr(quality, "FILTER_BITS", 64)
    rows = [(f"t{i}", "a", "s", DAYS[0], 1.0, 1.0) for i in range(300)]
    rows += [("t7", "b", "s", DAYS[1], 1.0, 1.0), ("t8", "a", "s", DAYS[0], 1.0, 1.0), (None, "a", "s", DAYS[0], 1.0, 1.0)] * 2
    trades = spark.createDataFrame(
        rows, "trade_id string, account_id string, security_id string, trade_date date, quantity double, execution_price double"
    ).withColumn("ingestion_timestamp", F.lit(None).cast("timestamp"))
    flags = quality.trade_flags(trades, None, None, kinds=("DUPLICATE_TRADE",)).collect()
    assert sorted((r.affected_record_id, r.account_id) for r in flags) == [("t7", "a"), ("t7", "b"), ("t8", "a")]


def test_corpus_sink_is_gzipped_with_same_lines_and_places(spark, tmp_path):
    """The corpus folder is gzipped JSON lines; rows and their places by file and line stay."""
    n = 500
    df = spark.range(n).select(
        F.lit("break").alias("document_type"),
        F.format_string("S%03d", F.col("id") % 7).alias("security_id"),
        F.format_string("A%03d", F.col("id") % 11).alias("account_id"),
        F.lit(None).cast("date").alias("position_date"),
        F.lit(None).cast("date").alias("event_date"),
        F.format_string("d%04d", "id").alias("document_id"),
        F.format_string("text %d", "id").alias("text"),
    )
    path = str(tmp_path / "corpus")
    assert files.sink_corpus(df.repartition(5), path)["rows"] == n
    parts = [p.name for p in (tmp_path / "corpus").iterdir() if p.name.startswith("part-")]
    assert parts and all(name.endswith(".json.gz") for name in parts)
    for size in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = sorted((r.place, r.document_id) for r in files.with_places(spark, path, files.CORPUS_SCHEMA).collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        ordered = sorted(df.collect(), key=lambda r: (r.security_id, r.account_id, r.document_id))
        assert found == [(i, r.document_id) for i, r in enumerate(ordered)]
    assert files.scan_corpus(spark, path).count() == n
