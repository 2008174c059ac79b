"""Event windows against a plain Python reading of the rules."""

import math
import random
import statistics
from datetime import date, timedelta

import pytest

from tallyspark.operators import calendar, events

PRICES = "security_id string, price_date date, close_price double"
EVENTS = "event_id string, security_id string, event_date date, event_type string"
POSITIONS = "account_id string, security_id string, position_date date, expected_position double"


def day(i):
    return str(date(2025, 1, 1) + timedelta(i))


def test_price_index_numbers_copies(table):
    prices = table(PRICES, [("S", day(0), 10.0), ("S", day(1), 12.0), ("S", day(1), 12.0), ("S", day(1), 11.0), ("S", day(2), 0.0), ("S", day(3), 5.0)])
    rows = sorted(events.price_index(prices).collect(), key=lambda r: r.trading_day_index)
    assert [r.trading_day_index for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r.close_price for r in rows] == [10.0, 11.0, 12.0, 12.0, 0.0, 5.0]
    assert [r.prev_close_price for r in rows] == [None, 10.0, 11.0, 12.0, 12.0, 0.0]
    assert rows[3].daily_return == 0.0 and rows[5].daily_return is None


def brute(prices, event_rows, held_rows):
    index = {}
    for s in {p[0] for p in prices}:
        own = sorted((p for p in prices if p[0] == s), key=lambda p: (p[1], p[2]))
        index[s] = [
            (i + 1, p[1], p[2], (p[2] - own[i - 1][2]) / own[i - 1][2] if i and own[i - 1][2] else None)
            for i, p in enumerate(own)
        ]
    totals = {}
    for _, s, d, q in held_rows:
        totals[s, d] = totals.get((s, d), 0.0) + q
    out = {}
    for event_id, s, d, _ in event_rows:
        rows = index.get(s, [])
        at = next((i for i, x, _, _ in rows if x >= d), None)
        closes = {i - at: c for i, _, c, _ in rows if abs(i - at) <= 5} if at else {}
        returns = {i - at: r for i, _, _, r in rows if abs(i - at) <= 5 and r is not None} if at else {}

        def change(a, b):
            a, b = closes.get(a), closes.get(b)
            return None if not a or b is None else (b - a) / a

        def spread(low, high):
            values = [r for o, r in returns.items() if low <= o <= high]
            return statistics.stdev(values) if len(values) > 1 else None

        held = [(i, totals[s, x], c) for i, x, c, _ in rows if (s, x) in totals]
        before = max((h for h in held if at and h[0] < at), default=None)
        after = max((h for h in held if at and at < h[0] <= at + 5), default=None)
        full = (
            all(o in closes for o in (-5, -1, 1, 5))
            and sum(-5 <= o <= -1 for o in returns) >= 5
            and sum(1 <= o <= 5 for o in returns) >= 5
        )
        exposure = [h and h[1] * h[2] for h in (before, after)]
        both = before is not None and after is not None
        out[event_id] = (
            at, change(-5, -1), change(1, 5), change(-1, 0), spread(-5, -1), spread(1, 5),
            before and before[1], after and after[1], after[1] - before[1] if both else None,
            exposure[0], exposure[1], exposure[1] - exposure[0] if both else None, full,
        )
    return out


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("seed", [1, 2])
def test_metrics_match_brute_force(table, seed):
    rng = random.Random(seed)
    prices = [(s, day(i), float(rng.randint(8, 16))) for s in "ST" for i in range(40) if rng.random() > 0.25]
    prices += [prices[3], (prices[5][0], prices[5][1], 20.0)]
    event_rows = [(f"E{i}", rng.choice("STU"), day(rng.randint(0, 45)), "X") for i in range(40)]
    held_rows = [(a, s, day(i), float(rng.randint(-5, 9))) for a in "AB" for s in "ST" for i in range(0, 40, 3) if rng.random() > 0.3]
    got = events.event_window_metrics(table(PRICES, prices), table(EVENTS, event_rows), table(POSITIONS, held_rows))
    expected = brute(prices, event_rows, held_rows)
    rows = got.collect()
    assert len(rows) == len(event_rows)
    for row in rows:
        mine = (row.event_trading_day_index, *[row[name] for name in events.METRICS], row.is_full_window)
        assert all(same(a, b) for a, b in zip(mine, expected[row.event_id])), (row, expected[row.event_id])


def test_repeated_event_ids_leave_one_row(table):
    prices = table(PRICES, [("S", day(i), 1.0) for i in range(5)])
    rows = table(EVENTS, [("E", "S", day(3), "X"), ("E", "S", day(1), "Y"), ("F", "S", day(9), "X"), ("F", "S", day(1), "X"), (None, "S", day(2), "Z")])
    got = {r.event_id: (r.event_trading_day_index, r.event_type) for r in events.event_asof_forward(rows, prices).collect()}
    assert got == {"E": (2, "Y"), "F": (None, "X"), None: (3, "Z")}


def test_price_window_keeps_events_without_a_price(table):
    prices = table(PRICES, [("S", day(i), 1.0) for i in range(4)])
    mapped = events.event_asof_forward(table(EVENTS, [("E", "S", day(1), "X"), ("F", "U", day(1), "X")]), prices)
    got = sorted((r.event_id, r.offset) for r in events.event_price_window(mapped, prices).collect())
    assert got == [("E", -1), ("E", 0), ("E", 1), ("E", 2), ("F", None)]


def test_calendar(spark, table):
    bounds = table("first_date date, periods int", [("2025-01-03", 4)])
    got = [(r.day_index, str(r.trading_day)) for r in calendar.business_calendar(bounds).orderBy("day_index").collect()]
    assert got == [(0, "2025-01-03"), (1, "2025-01-06"), (2, "2025-01-07"), (3, "2025-01-08")]
    days = calendar.business_calendar(table("first_date date, last_date date", [("2025-01-01", "2025-01-31")]))
    near = calendar.event_window_dates(table(EVENTS, [("E", "S", "2025-01-02", "X"), ("F", "S", "2025-01-04", "X")]), days, 2)
    assert sorted(str(r.price_date) for r in near.collect()) == ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-06"]
