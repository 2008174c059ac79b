"""Rows that break the checks' rules, made from the test tables' own rows, in both engines.

Each entry is a condition on rows and what is replaced in their copies; an empty
replacement repeats them. Conditions and values are SQL that Spark and DuckDB share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.frames import union_all

NO_TEXT, NO_DATE, NO_NUMBER = "cast(null as string)", "cast(null as date)", "cast(null as double)"
_POSITIONS = "security_id = 'SEC002' and dayofmonth(position_date) = "
_WRONG = "issue_type = 'WRONG_REPORTED_POSITION' and account_id = 'ACC001' and "
_KEYS = ("account_id", "security_id", "issue_date")

FLAWS: dict[str, list[tuple[str, dict[str, str]]]] = {
    "securities": [
        ("security_id = 'SEC001'", {"security_id": NO_TEXT}),
        ("security_id = 'SEC002'", {"ticker": NO_TEXT}),
        ("security_id = 'SEC003'", {}),
    ],
    "prices": [
        ("security_id = 'SEC001' and dayofmonth(price_date) = 2", {"price_date": NO_DATE}),
        ("security_id = 'SEC002' and dayofmonth(price_date) = 3", {"open_price": NO_NUMBER}),
        ("security_id = 'SEC003' and dayofmonth(price_date) = 4", {"close_price": "-close_price"}),
        ("security_id = 'SEC004' and dayofmonth(price_date) = 5", {"high_price": "low_price / 2"}),
        ("security_id = 'SEC005' and dayofmonth(price_date) = 6", {"security_id": "'SEC999'"}),
        ("security_id = 'SEC006' and dayofmonth(price_date) = 7", {"security_id": NO_TEXT}),
    ],
    "trades": [
        ("security_id = 'SEC001'", {"trade_id": NO_TEXT}),
        ("security_id = 'SEC002'", {"account_id": NO_TEXT}),
        ("security_id = 'SEC003'", {"side": "'HOLD'"}),
        ("security_id = 'SEC004'", {"side": NO_TEXT}),
    ],
    "starting_positions": [
        ("security_id = 'SEC001'", {"account_id": NO_TEXT}),
        ("security_id = 'SEC002'", {"position_date": NO_DATE}),
        ("security_id = 'SEC003'", {"quantity": NO_NUMBER}),
        ("security_id = 'SEC004'", {"security_id": "'SEC999'"}),
    ],
    "reported_positions": [
        (_POSITIONS + "1", {"account_id": NO_TEXT}),
        (_POSITIONS + "2", {"position_date": NO_DATE}),
        (_POSITIONS + "3", {"reported_quantity": NO_NUMBER}),
        (_POSITIONS + "4", {"security_id": NO_TEXT}),
    ],
    "filing_events": [
        ("security_id = 'SEC001'", {"event_id": NO_TEXT}),
        ("security_id = 'SEC002'", {"event_date": NO_DATE}),
        ("security_id = 'SEC003'", {"security_id": "'SEC999'"}),
    ],
    "injected_issues_manifest": [
        ("issue_type = 'MISSING_PRICE' and security_id = 'SEC001'", {}),
        ("issue_type = 'MISSING_PRICE' and security_id = 'SEC002'", {"issue_date": "'1900-01-01'"}),
        ("issue_type = 'MISSING_PRICE' and security_id = 'SEC003'", {"security_id": NO_TEXT}),
        ("issue_type = 'MISSING_PRICE' and security_id = 'SEC004'", {"issue_date": NO_TEXT}),
        # Every shape of an issue's keys, found and missed.
        *(
            (_WRONG + who, {key: NO_TEXT for bit, key in enumerate(_KEYS) if not mask >> bit & 1} | other)
            for mask in range(8)
            for who, other in (
                ("issue_date like '%-01-%'", {}),
                ("issue_date like '%-02-%'", {"account_id": "'ACC999'"} if mask & 1 else {"expected_detection_category": "'NONE'"}),
            )
        ),
    ],
}


def flawed(df: DataFrame, table: str) -> DataFrame:
    """The rows and their flawed copies."""
    copies = [
        df.filter(condition).withColumns({name: F.expr(value) for name, value in changes.items()})
        if changes
        else df.filter(condition)
        for condition, changes in FLAWS[table]
    ]
    return union_all([df, *copies])


def flawed_sql(source: str, table: str) -> str:
    """The same in SQL, as a query in brackets."""
    parts = [f"select * from {source}"]
    for condition, changes in FLAWS[table]:
        listed = ", ".join(f"{value} as {name}" for name, value in changes.items())
        parts.append(f"select *{f' replace ({listed})' if changes else ''} from {source} where {condition}")
    return "(" + " union all ".join(parts) + ")"
