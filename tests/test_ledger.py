import random
from datetime import date, timedelta

import pytest

from tallyspark.operators import calendar, checks, ledger

STARTING = "account_id string, security_id string, position_date date, quantity double"
TRADES = (
    "trade_id string, account_id string, security_id string, side string, quantity double, trade_date date, "
    "settlement_date date"
)
REPORTS = "account_id string, security_id string, position_date date, reported_quantity double"
ACTIONS = "corporate_action_id string, security_id string, action_type string, effective_date date, split_ratio double"


def day(i):
    return str(date(2025, 1, 1) + timedelta(i))


def test_bases_and_divergence(table):
    days = calendar.business_calendar(table("first_date date, last_date date", [(day(0), day(8))]))
    starting = table(STARTING, [("A", "S", day(0), 10.0)])
    trades = table(
        TRADES,
        [
            ("1", "A", "S", "BUY", 5.0, day(1), day(5)),
            ("2", "A", "S", "SELL", 2.0, day(1), day(6)),
            ("3", "A", "S", "BUY", 7.0, day(3), day(5)),
            ("4", "B", "S", "HOLD", 1.0, day(0), day(0)),
        ],
    )
    rows = ledger.expected_by_date_basis(starting, trades, days).collect()
    got = {(r.account_id, str(r.position_date)): (r.starting_quantity, r.buy_quantity, r.sell_quantity, r.expected_position) for r in rows}
    assert got["A", day(0)] == (10.0, 0.0, 0.0, 10.0)
    assert got["A", day(1)] == (0.0, 3.0, 0.0, 13.0)
    assert got["A", day(8)] == (0.0, 0.0, 0.0, 13.0)  # day 3 is a Saturday and counts nowhere
    assert got["B", day(0)] == (0.0, 0.0, 1.0, -1.0)
    found = {str(r.position_date): (r.expected_position_trade, r.expected_position_settlement) for r in ledger.timing_divergence(starting, trades, days).collect()}
    assert found[day(1)] == (13.0, 10.0) and found[day(5)] == (13.0, 22.0) and found[day(8)] == (13.0, 20.0)
    assert day(0) not in found
    filled = ledger.zero_fill_starting(starting, trades, day(0)).collect()
    assert [(r.account_id, r.quantity) for r in filled] == [("A", 10.0), ("B", 0.0)]
    assert [r.account_id for r in ledger.starting_coverage_gaps(starting, trades).collect()] == ["B"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_forward_splits_match_a_step_by_step_walk(table, seed):
    rng = random.Random(seed)
    actions = [("1", "S", "STOCK_SPLIT", day(4), 2.0), ("2", "S", "STOCK_SPLIT", day(9), 4.0), ("3", "T", "OTHER", day(4), 2.0)]
    reports = [(a, s, day(i), float(rng.randint(1, 50))) for a in "AB" for s in "ST" for i in range(15) if rng.random() > 0.3]
    trades = [("x", rng.choice("AB"), rng.choice("ST"), rng.choice(["BUY", "SELL"]), float(rng.randint(1, 9)), day(rng.randint(0, 14)), day(0)) for _ in range(30)]
    expected = {r[:3]: r[3] for r in reports}
    for _, security, kind, effective, ratio in actions:
        if kind != "STOCK_SPLIT":
            continue
        for account in "AB":
            value = None
            for i in range(15):
                k = (account, security, day(i))
                if k not in expected or day(i) < effective:
                    continue
                net = sum(t[4] if t[3] == "BUY" else -t[4] for t in trades if t[1:3] == (account, security) and t[5] == day(i))
                value = expected[k] * ratio if value is None else value + net
                expected[k] = value
    got = ledger.forward_split_positions(table(REPORTS, reports), table(TRADES, trades), table(ACTIONS, actions))
    assert {(r.account_id, r.security_id, str(r.position_date)): r.reported_quantity for r in got.collect()} == expected


def test_forward_splits_keep_every_report(table):
    schema = REPORTS + ", source_system string"
    reports = [("A", "S", day(2), 5.0, "x"), ("A", "S", day(4), 7.0, "y"), ("A", "S", day(4), 6.0, "x"), ("A", "U", day(4), 1.0, "x"),
               ("A", "U", day(4), 1.0, "x"), (None, "S", day(5), 3.0, "x"), ("A", "S", None, 4.0, "x")]
    trades = table(TRADES, [("x", "A", "S", "BUY", 1.0, day(4), day(4))])
    actions = table(ACTIONS, [("1", "S", "STOCK_SPLIT", day(4), 2.0)])
    got = ledger.forward_split_positions(table(schema, reports), trades, actions)
    assert got.columns == ["account_id", "security_id", "position_date", "reported_quantity", "source_system"]
    assert sorted((r.reported_quantity, r.source_system) for r in got.collect()) == [
        (1.0, "x"), (1.0, "x"), (3.0, "x"), (4.0, "x"), (5.0, "x"), (7.0, "y"), (12.0, "x")
    ]


def test_both_bases_are_the_single_views(table):
    starting = table("account_id string, security_id string, position_date date, quantity double", [("A", "S", day(0), 10.0)])
    trades = table(TRADES, [("x", "A", "S", "BUY", 3.0, day(1), day(4)), ("y", "A", "S", "SELL", 2.0, day(4), day(7))])
    days = table("day_index int, trading_day date", [(i, day(n)) for i, n in enumerate((0, 1, 4, 5, 7))])
    both = ledger.expected_by_both_bases(starting, trades, days).collect()
    for basis in ledger.BASES:
        single = ledger.expected_by_date_basis(starting, trades, days, basis)
        assert sorted(tuple(r[c] for c in single.columns) for r in both if r.basis == basis) == sorted(map(tuple, single.collect()))


def test_trade_places(table):
    schema = "trade_id string, account_id string, security_id string, trade_date date, event_timestamp timestamp"
    trades = table(schema, [("b", "A", "S", day(1), f"{day(1)} 10:00:00"), ("a", "A", "S", day(1), f"{day(1)} 10:00:00"), ("c", "A", "S", day(1), f"{day(1)} 09:00:00")])
    assert {r.trade_id: r.place for r in ledger.trade_places(trades).collect()} == {"c": 1, "a": 2, "b": 3}


def test_forward_split_prices(table):
    columns = "security_id string, price_date date, open_price double, high_price double, low_price double, close_price double"
    prices = table(columns, [("S", day(i), 9.0, 9.0, 9.0, 10.0) for i in (1, 4, 6)])
    got = ledger.forward_split_prices(prices, table(ACTIONS, [("1", "S", "STOCK_SPLIT", day(4), 3.0)]))
    assert sorted((str(r.price_date), r.open_price, r.close_price) for r in got.collect()) == [
        (day(1), 9.0, 10.0), (day(4), 3.0, 3.3333), (day(6), 3.0, 3.3333)
    ]


def test_scorecard(table):
    manifest = table(
        "issue_id string, account_id string, security_id string, trade_id string, issue_date string, expected_detection_category string",
        [("1", None, None, "T1", None, "DUPLICATE_TRADE"), ("2", None, None, "T2", None, "DUPLICATE_TRADE"),
         ("3", None, "S", None, day(1), "MISSING_PRICE"), ("4", "A", "S", None, day(2), "QUANTITY_MISMATCH"),
         ("5", None, None, None, None, "OUT_OF_ORDER")],
    )
    flags = table(
        "flag_type string, account_id string, security_id string, flag_date date, affected_entity string, affected_record_id string",
        [("DUPLICATE_TRADE", "A", "S", day(1), "trades", "T1"), ("MISSING_PRICE", "A", "S", day(1), "trades", "T3")],
    )
    breaks = table("break_reason_code string, account_id string, security_id string, position_date date", [("QUANTITY_MISMATCH", "A", "S", day(2))])
    got = {r.category: (r.issues, r.found, r.missed) for r in checks.detection_scorecard(manifest, flags, breaks).collect()}
    assert got == {"DUPLICATE_TRADE": (2, 1, 1), "MISSING_PRICE": (1, 1, 0), "QUANTITY_MISMATCH": (1, 1, 0), "OUT_OF_ORDER": (1, 0, 1)}


def test_scorecard_matches_every_shape_of_keys(table):
    schema = "issue_id string, account_id string, security_id string, trade_id string, issue_date string, expected_detection_category string"
    named = ("A", "S", day(1))
    shapes = [[value if mask >> bit & 1 else None for bit, value in enumerate(named)] for mask in range(8)]
    issues = [(f"hit{i}", a, s, None, d, "FOUND") for i, (a, s, d) in enumerate(shapes)]
    issues += [("miss", "B", None, None, None, "FOUND"), ("star", "*", None, None, None, "FOUND"), ("t", None, None, "A", None, "FOUND")]
    flags = table(
        "flag_type string, account_id string, security_id string, flag_date date, affected_entity string, affected_record_id string",
        [("FOUND", *named, "prices", "T1")],
    )
    breaks = table("break_reason_code string, account_id string, security_id string, position_date date", [])
    got = checks.detection_scorecard(table(schema, issues), flags, breaks).collect()
    assert [(r.category, r.issues, r.found, r.missed) for r in got] == [("FOUND", 11, 8, 3)]
