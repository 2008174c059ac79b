import datetime
from collections import Counter
from pathlib import Path

import pytest

from workbench.views import LINE, RawLedger

DAY = datetime.datetime(1996, 3, 4)
TABLES = {
    "nation": ("n_nationkey int, n_regionkey int", [(1, 0), (2, 2), (3, 2), (None, 1)]),
    "customer": ("c_custkey long, c_nationkey int", [(1, 1), (2, 2), (2, 3), (None, 1), (3, None)]),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderdate timestamp",
        [(1, 1, DAY), (2, 2, DAY), (2, 2, DAY), (3, None, DAY), (4, 3, DAY), (5, 1, None), (None, 1, DAY)],
    ),
    "part": ("p_partkey long, p_brand string", [(1, "Brand#11"), (2, "Brand#25"), (2, "Brand#3"), (None, "Brand#4")]),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, "
        "l_returnflag string, l_linestatus string",
        [
            (order, part, line, 3.0, 12.0, tax, "A", "O")
            for order in (1, 2, 3, 4, 5, None)
            for part in (1, 2, None)
            for line, tax in ((1, 0.08), (1, 0.08), (7, 0.0), (None, None))
        ],
    ),
}
MADE_OF_LINES = ("starting_positions", "trades", "reported_positions", "injected_issues_manifest")


@pytest.fixture
def folder(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def joined():
    rows = {name: rows for name, (_, rows) in TABLES.items()}
    number = {brand: int(brand[6:8]) for _, brand in rows["part"]}
    return Counter(
        (order, line, quantity, price, tax, flag, status, region + 1, number[brand], day.date() if day else None)
        for order, part, line, quantity, price, tax, flag, status in rows["lineitem"]
        for key, customer, day in rows["orders"]
        if key is not None and key == order
        for owner, nation in rows["customer"]
        if owner is not None and owner == customer
        for place, region in rows["nation"]
        if place is not None and place == nation
        for bought, brand in rows["part"]
        if bought is not None and bought == part
    )


def test_lines_are_joined_once_for_all_tables(spark, folder):
    """Repeated and null keys included: stored lines and tables made of them are those joined anew."""
    anew, kept = RawLedger(spark, folder), RawLedger(spark, folder).keep_lines()
    wanted = joined()
    assert wanted and Counter(map(tuple, anew._lines().select(*LINE).collect())) == wanted
    assert Counter(map(tuple, kept._lines().select(*LINE).collect())) == wanted
    for name in MADE_OF_LINES:
        assert Counter(kept.table(name).collect()) == Counter(anew.table(name).collect()), name
        plan = kept.table(name)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" in anew.table(name)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" not in plan, name  # parts are not joined again
    path = Path(kept._kept)
    kept.drop_lines()
    assert not path.exists() and Counter(map(tuple, kept._lines().collect())) == wanted
