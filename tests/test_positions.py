"""Reconstruction against a plain Python walk over random small ledgers."""

import random
from datetime import date, timedelta
from itertools import groupby

import pytest

from tallyspark.operators import breaks, positions

TRADES = "account_id string, security_id string, side string, quantity double, trade_date date"
STARTING = "account_id string, security_id string, position_date date, quantity double"
REPORTS = "account_id string, security_id string, position_date date, reported_quantity double"
FLAGS = "account_id string, security_id string, flag_date date, flag_type string"


def day(i):
    return None if i is None else str(date(2025, 1, 1) + timedelta(i))


def random_ledger(seed, empty_dates=False):
    rng = random.Random(seed)
    accounts, securities = ["A", "B", None], ["S", "T", "U"]

    def maybe(i):
        return None if empty_dates and rng.random() < 0.1 else i

    trades = [
        (rng.choice(accounts), rng.choice(securities), rng.choice(["BUY", "SELL", "HOLD"]),
         rng.choice([1.0, 2.0, 5.0, None]), day(maybe(rng.randint(0, 9))))
        for _ in range(25)
    ]
    starting = [(rng.choice("AB"), rng.choice("ST"), day(rng.randint(0, 3)), rng.choice([3.0, 4.0, None])) for _ in range(3)]
    reported = [
        (rng.choice("AB"), rng.choice("STU"), day(maybe(rng.randint(0, 9))), rng.choice([0.0, 1.0, 3.0, 4.0, 7.0, None]))
        for _ in range(30)
    ]
    flags = [
        (rng.choice("AB"), rng.choice("ST"), day(rng.randint(0, 9)),
         rng.choice(["DUPLICATE_TRADE", "MISSING_PRICE", "LATE_ARRIVING_TRADE", "SPLIT_ADJUSTMENT_BREAK", "INVALID_PRICE"]))
        for _ in range(15)
    ]
    return ["S", "T"], starting, trades, reported, flags


PRIORITY = ["SPLIT_ADJUSTMENT_BREAK", "DUPLICATE_TRADE", "LATE_ARRIVING_TRADE", "MISSING_PRICE"]


def walk(securities, starting, trades, reported, flags):
    trades = [t for t in trades if t[1] in securities]
    pairs = {r[:2] for r in starting} | {t[:2] for t in trades} | {r[:2] for r in reported}
    days = {r[2] for r in starting} | {t[4] for t in trades} | {r[2] for r in reported}
    out = []
    for a, s in pairs:
        base = max((q or 0.0 for x, y, _, q in starting if (x, y) == (a, s) and q is not None), default=0.0)
        buy = sell = 0.0
        rows = []
        for d in sorted(days, key=lambda d: d or ""):
            if a is not None and d is not None:
                todays = [t for t in trades if t[:2] == (a, s) and t[4] == d]
                buy += sum(t[3] or 0.0 for t in todays if t[2] == "BUY")
                sell += sum(t[3] or 0.0 for t in todays if t[2] == "SELL")
                seen = [r[3] for r in reported if r[:2] == (a, s) and r[2] == d]
                kinds = {f[3] for f in flags if f[:2] == (a, s) and f[2] == d}
            else:
                seen, kinds = [], set()
            expected = base + buy - sell
            for value in sorted(seen, key=lambda v: (v is not None, v or 0.0)) or [None]:
                difference = None if value is None else value - expected
                reason = (
                    "POSITION_NOT_REPORTED" if value is None
                    else "MATCH" if difference == 0
                    else next((k for k in PRIORITY if k in kinds), "QUANTITY_MISMATCH")
                )
                rows.append([a, s, d, base, buy, sell, expected, value, difference,
                             "MATCH" if reason == "MATCH" else "BREAK", reason])
        segments, current = [], []
        for i, row in enumerate(rows):
            if row[9] == "BREAK" and (i == 0 or rows[i - 1][9] == "MATCH"):
                segments.append(current)
                current = []
            current.append(row)
        segments.append(current)
        for segment in segments:
            dates = [r[2] for r in segment if r[2] is not None]
            for row in segment:
                if row[9] == "MATCH":
                    out.append(tuple(row + ["MATCH", None, None, False]))
                else:
                    first = min(dates, default=None)
                    age = None if row[2] is None or first is None else (date.fromisoformat(row[2]) - date.fromisoformat(first)).days
                    out.append(tuple(row + [segment[0][10], first, age, bool(age and age > 0)]))
    return out


def key(row):
    return tuple(str(v) for v in row)


@pytest.mark.parametrize("seed,empty", [(1, False), (2, False), (3, True), (4, True)])
def test_reconstruction_matches_a_plain_walk(table, seed, empty):
    securities, starting, trades, reported, flags = random_ledger(seed, empty)
    # Copies of one snapshot and of one trade's day.
    reported += [reported[0]] * 5
    got = positions.position_reconstruction(
        table("security_id string", [(s,) for s in securities]),
        table(STARTING, starting),
        table(TRADES, trades),
        table(REPORTS, reported),
        table(FLAGS, flags),
    ).collect()
    mine = sorted(key([str(v) if isinstance(v, date) else v for v in row]) for row in got)
    assert mine == sorted(key(row) for row in walk(securities, starting, trades, reported, flags))


def test_no_shuffle_of_the_dense_rows(table):
    securities, starting, trades, reported, flags = random_ledger(1)
    df = positions.position_reconstruction(
        table("security_id string", [(s,) for s in securities]),
        table(STARTING, starting),
        table(TRADES, trades),
        table(REPORTS, reported),
        table(FLAGS, flags),
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    main = "\n".join(line for line in plan.splitlines() if ":" not in line.split("+-")[0])  # without subqueries
    assert "Exchange" not in main[: main.index("posexplode")]  # the cells are written out after the deal by pair
    assert main[: main.index("Union")].count("Exchange") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_tolerance(table):
    got = positions.position_reconstruction(
        table("security_id string", [("S",)]),
        table(STARTING, [("A", "S", day(0), 10.0)]),
        table(TRADES, []),
        table(REPORTS, [("A", "S", day(0), 10.4), ("A", "S", day(1), 11.0)]),
        table(FLAGS, []),
        tolerance=0.5,
    ).collect()
    assert sorted((str(r.position_date), r.reconciliation_status) for r in got) == [(day(0), "MATCH"), (day(1), "BREAK")]


def test_breaks_and_summary(table):
    rows = [
        ("A", "S", "2025-01-01", None, "BREAK", "POSITION_NOT_REPORTED", "POSITION_NOT_REPORTED"),
        ("A", "S", "2025-01-02", -100.0, "BREAK", "DUPLICATE_TRADE", "POSITION_NOT_REPORTED"),
        ("A", "S", "2025-01-03", 25.0, "BREAK", "QUANTITY_MISMATCH", "POSITION_NOT_REPORTED"),
        ("A", "S", "2025-01-04", 0.0, "MATCH", "MATCH", "MATCH"),
    ]
    df = table(
        "account_id string, security_id string, position_date date, position_difference double, "
        "reconciliation_status string, break_reason_code string, root_cause_reason_code string",
        rows,
    )
    extra = ("expected_position", "reported_position", "first_break_date", "days_since_first_break", "is_cascading_break")
    for name in extra:
        df = df.withColumn(name, df.position_difference)
    got = sorted((str(r.position_date), r.severity) for r in breaks.reconciliation_breaks(df).collect())
    assert [s for _, s in got] == ["LOW", "HIGH", "MEDIUM"]
    summary = {(r.measure, r.value): r.rows for r in breaks.break_summary(df).collect()}
    assert summary[("total", "ALL")] == 4 and summary[("status", "BREAK")] == 3
    assert summary[("root_cause", "POSITION_NOT_REPORTED")] == 3 and ("break_reason", "MATCH") not in summary
