import hashlib

import pytest
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.operators import bronze, checks, cleaning, quality, splits
from tallyspark.sources import files

TRADES = (
    "trade_id string, account_id string, security_id string, side string, quantity double, "
    "execution_price double, trade_date date, settlement_date date, ingestion_timestamp timestamp"
)
PRICES = "security_id string, price_date date, close_price double"
ACTIONS = "corporate_action_id string, security_id string, action_type string, effective_date date, split_ratio double"
REPORTS = "account_id string, security_id string, position_date date, reported_quantity double"


def trade(id="T1", account="A", security="S", side="BUY", q=1.0, p=1.0, day="2025-01-02", seen=None):
    return (id, account, security, side, q, p, day, day, f"{seen or day} 10:00:00")


def test_malformed_values_become_null(spark):
    raw = spark.createDataFrame(
        [(" t1 ", " acc1", "sec1 ", " b ", "x", "2.5", "2025-13-45", "2025-01-04", "nope", "2025-01-02T10:00:00", "oms")],
        "trade_id string, account_id string, security_id string, side string, quantity string, "
        "execution_price string, trade_date string, settlement_date string, event_timestamp string, "
        "ingestion_timestamp string, source_system string",
    )
    row = cleaning.clean_trades(raw).first()
    assert (row.trade_id, row.account_id, row.security_id, row.side) == ("t1", "ACC1", "SEC1", "BUY")
    assert row.quantity is None and row.trade_date is None and row.event_timestamp is None
    assert row.execution_price == 2.5 and str(row.settlement_date) == "2025-01-04"


def test_scan_keeps_corrupt_lines_and_names_missing_sources(spark, tmp_path):
    path = tmp_path / "starting.jsonl"
    path.write_text('{"account_id":"a","security_id":"s","position_date":"2025-01-02","quantity":3}\n{bad\n')
    spec = schemas.TABLES["starting_positions"]
    rows = files.scan_jsonl(spark, spec.name, str(path), spec.schema).collect()
    assert sorted((r.quantity, r._corrupt_record) for r in rows if r.quantity) == [(3.0, None)]
    assert [r._corrupt_record for r in rows if r.account_id is None] == ["{bad"]
    with pytest.raises(FileNotFoundError, match="starting_positions"):
        files.scan_jsonl(spark, spec.name, str(tmp_path / "none"), spec.schema)
    with pytest.raises(FileNotFoundError):
        files.scan_first(spark, [str(tmp_path / "x"), str(tmp_path / "y")])


def test_sinks_count_while_writing(spark, tmp_path):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    assert files.sink_parquet(df, str(tmp_path / "p"), ["k"]) == 100
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100
    assert files.sink_jsonl(df.repartition(5), str(tmp_path / "j"), ["k", "id"]) == 100


def test_hash_ignores_nulls_and_metadata(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    row = bronze.bronze_metadata(df, "load", F.lit("f")).first()
    assert row._raw_record_hash == hashlib.sha256(b'{"a":"x"}').hexdigest()
    assert row._bronze_load_id == "load" and row._ingested_at is not None


def test_trade_flags(table):
    trades = table(
        TRADES,
        [
            trade("T1"),
            trade("T1"),
            trade("T1", account="B"),
            trade(None, account="C"),
            trade(None, account="C"),
            trade("T2", security="X"),
            trade("T3", day="2025-01-03"),
            trade("T4", q=0.0, p=None),
            trade("T5", q=None, p=-1.0),
            trade("T6", seen="2025-01-03"),
            trade("", q=-1.0),
            trade(None, q=-1.0),
        ],
    )
    securities = table("security_id string", [("S",), ("S",)])
    prices = table(PRICES, [("S", "2025-01-02", 1.0), ("S", "2025-01-02", 2.0)])
    flags = quality.trade_flags(trades, securities, prices).collect()
    got = sorted((r.flag_type, r.affected_record_id or "", r.account_id) for r in flags)
    assert got == [
        ("DUPLICATE_TRADE", "T1", "A"),
        ("DUPLICATE_TRADE", "T1", "B"),
        ("INVALID_PRICE", "T4", "A"),
        ("INVALID_PRICE", "T5", "A"),
        ("INVALID_QUANTITY", "", "A"),
        ("INVALID_QUANTITY", "T4", "A"),
        ("INVALID_QUANTITY", "T5", "A"),
        ("LATE_ARRIVING_TRADE", "T6", "A"),
        ("MISSING_PRICE", "T3", "A"),
        ("UNKNOWN_SECURITY", "T2", "A"),
    ]
    assert len({r.flag_id for r in flags}) == len(flags)
    digest = hashlib.sha256(b"DUPLICATE_TRADE||T1||A||S||2025-01-02").hexdigest()
    assert digest in {r.flag_id for r in flags}


def test_kinds_of_a_trade_without_a_lambda(table):
    """Several kinds, one or none on a trade; the plan holds no lambda over a row's kinds."""
    trades = table(
        "trade_id string, account_id string, security_id string, quantity double, execution_price double, trade_date date, ingestion_timestamp timestamp",
        [
            ("none", "A", "S", 1.0, 1.0, "2024-01-02", "2024-01-02T09:00:00"),
            ("all", "A", "X", None, -1.0, "2024-01-02", "2024-01-03T09:00:00"),
            ("late", "A", "S", 1.0, 1.0, "2024-01-02", "2024-01-03T09:00:00"),
            (None, None, None, 0.0, 1.0, None, None),
        ],
    )
    kinds = ("UNKNOWN_SECURITY", "INVALID_QUANTITY", "INVALID_PRICE", "LATE_ARRIVING_TRADE")
    securities = table("security_id string", [("S",)])
    flags = quality.trade_flags(trades, securities, table("security_id string, price_date date", []), kinds)
    assert sorted(((r.affected_record_id or "", r.flag_type) for r in flags.collect())) == sorted(
        [("all", kind) for kind in kinds]
        + [("late", "LATE_ARRIVING_TRADE"), ("", "UNKNOWN_SECURITY"), ("", "INVALID_QUANTITY")]
    )
    assert "lambda" not in flags._jdf.queryExecution().optimizedPlan().toString()
    assert quality.trade_flags(trades, securities, securities, ()).collect() == []


def test_split_flags(table):
    actions = table(
        ACTIONS,
        [
            ("C2", "S", "STOCK_SPLIT", "2025-01-10", 9.0),
            ("C1", "S", "STOCK_SPLIT", "2025-01-10", 2.0),
            ("C3", "S", "CASH_DIVIDEND", "2025-01-08", None),
        ],
    )
    reports = table(
        REPORTS,
        [
            ("A", "S", "2025-01-08", 10.0),
            ("A", "S", "2025-01-10", 20.0),
            ("B", "S", "2025-01-08", 10.0),
            ("B", "S", "2025-01-10", 21.0),
            ("C", "S", "2025-01-10", 21.0),
            ("D", "S", "2025-01-08", None),
            ("D", "S", "2025-01-10", 21.0),
            ("E", "T", "2025-01-10", 21.0),
        ],
    )
    flags = quality.split_break_flags(reports, actions).collect()
    assert [(r.account_id, r.affected_record_id, r.affected_entity) for r in flags] == [
        ("B", "B|S|2025-01-10", "reported_positions")
    ]
    digest = hashlib.sha256(b"SPLIT_ADJUSTMENT_BREAK||B||S||2025-01-10||C1").hexdigest()
    assert flags[0].flag_id == digest


def test_split_factors_are_exact_products(table):
    prices = table(PRICES, [("S", d, 1.0) for d in ("2025-01-01", "2025-01-05", "2025-01-10", None)] + [("T", "2025-01-01", 1.0)])
    actions = table(
        ACTIONS,
        [
            ("1", "S", "STOCK_SPLIT", "2025-01-05", 3.0),
            ("2", "S", "STOCK_SPLIT", "2025-01-07", 5.0),
            ("3", "S", "STOCK_SPLIT", "2025-01-07", -2.0),
            ("4", "S", "STOCK_SPLIT", None, 7.0),
            ("5", "S", "OTHER", "2025-01-09", 7.0),
        ],
    )
    factors = splits.split_factors(prices, actions)
    got = {(r.security_id, str(r.price_date)): r.split_adjustment_factor for r in factors.collect()}
    assert got == {
        ("S", "2025-01-01"): 15.0,
        ("S", "2025-01-05"): 5.0,
        ("S", "2025-01-10"): 1.0,
        ("S", "None"): 1.0,
        ("T", "2025-01-01"): 1.0,
    }
    trades = table(TRADES, [trade("a", day="2025-01-01"), trade("b", day="2025-01-02")])
    adjusted = {r.trade_id: r.adjusted_quantity for r in splits.adjust_trades(trades, factors).collect()}
    assert adjusted == {"a": 15.0, "b": 1.0}
    own = splits.own_date_factors({"price_date": prices, "trade_date": trades}, actions)
    adjusted = {r.trade_id: r.adjusted_quantity for r in splits.adjust_trades(trades, own).collect()}
    assert adjusted == {"a": 15.0, "b": 15.0}


def test_checks(table):
    securities = table("security_id string, ticker string", [("S", "s"), ("S", None), (None, "x")])
    got = sorted((r.rule, r.record_id, r.row_count) for r in checks.check_securities(securities).collect())
    assert got == [("duplicate", "S", 2), ("null_security_id", "", 1), ("null_ticker", "S", 1)]
    events = table("event_id string, security_id string, event_date date", [(None, "S", None), ("E", "Q", "2025-01-01")])
    got = sorted((r.rule, r.record_id) for r in checks.check_events(events, securities).collect())
    assert got == [("invalid_date", ""), ("null_event_id", ""), ("unknown_security", "E")]
    manifest = table(
        "issue_id string, issue_type string, affected_record_id string, issue_date string, security_id string",
        [("1", "A", "r", None, None), ("2", "A", "r", None, None), ("3", "MISSING_PRICE", "p", "2025-01-01", "S"),
         ("4", "MISSING_PRICE", "q", None, "S"), ("5", "MISSING_PRICE", "z", "2025-01-09", "S")],
    )
    assert [(r.issue_type, r.row_count) for r in checks.check_manifest_unique(manifest).collect()] == [("A", 2)]
    required = table("security_id string, price_date date", [("S", "2025-01-01")])
    got = sorted((r.issue_id, r.rule) for r in checks.check_missing_price_targets(manifest, required).collect())
    assert got == [("4", "missing_keys"), ("5", "not_required")]
