import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tallyspark.functions.expr import add_business_days, python_text
from tallyspark.functions.frames import COPY_CHUNK, asof, every_date, repeat_rows, top_rows


def test_repeat_rows_beyond_one_chunk(spark):
    copies = 2 * COPY_CHUNK + 3
    df = spark.createDataFrame([("a", 1), ("b", copies), ("c", COPY_CHUNK)], "k string, n long")
    out = repeat_rows(df, "n", "i").groupBy("k").agg(
        F.count("*").alias("n"), F.countDistinct("i").alias("d"), F.max("i").alias("m")
    )
    assert {r.k: (r.n, r.d, r.m) for r in out.collect()} == {
        "a": (1, 1, 1),
        "b": (copies, copies, copies),
        "c": (COPY_CHUNK, COPY_CHUNK, COPY_CHUNK),
    }


def test_every_date_keeps_the_null_date(table):
    keys = table("k string", [("a",), ("b",)])
    dates = table("d date", [("2025-01-02",), (None,), ("2025-01-02",), ("2025-01-01",)])
    out = every_date(keys, dates, "d")
    got = sorted((r.k, str(r.d)) for r in out.collect())
    assert got == sorted((k, d) for k in "ab" for d in ("2025-01-01", "2025-01-02", "None"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_asof_against_brute_force(spark):
    rng = random.Random(3)
    left = [(rng.choice("abc"), rng.randint(0, 40)) for _ in range(60)]
    right = sorted({(rng.choice("ab"), rng.randint(0, 40)) for _ in range(25)})
    l = spark.createDataFrame(left, "k string, at int")
    r = spark.createDataFrame([(k, t, f"{k}{t}") for k, t in right], "k string, t int, v string")
    for forward in (False, True):
        for exact in (False, True):
            out = asof(l, r, by="k", left_on="at", right_on="t", take=("v",), forward=forward, exact=exact)
            for row in out.collect():
                ok = [
                    t
                    for k, t in right
                    if k == row["k"]
                    and ((t > row["at"]) if forward else (t < row["at"]) or False or (exact and t == row["at"]))
                    or (forward and exact and k == row["k"] and t == row["at"])
                ]
                best = (min(ok) if forward else max(ok)) if ok else None
                assert row["v"] == (f"{row['k']}{best}" if best is not None else None)


def test_top_rows(spark):
    df = spark.createDataFrame([("a", i) for i in (5, 3, 9, 1)] + [("b", 2)], "k string, v int")
    out = top_rows(df, ["k"], [F.col("v")], 2, "rank").collect()
    assert sorted((r["k"], r["v"], r["rank"]) for r in out) == [("a", 1, 1), ("a", 3, 2), ("b", 2, 1)]


def test_business_days_match_pandas(spark):
    import pandas as pd

    days = [date(2025, 1, 1) + timedelta(i) for i in range(30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for n in (0, 1, 2, 5, 7):
        got = {r.d: r.s for r in df.select("d", add_business_days(F.col("d"), n).alias("s")).collect()}
        for d in days:
            if n == 0 and d.weekday() > 4:
                continue
            assert got[d] == (pd.Timestamp(d) + pd.tseries.offsets.BDay(n)).date()


def test_python_text(spark):
    values = [0.0, 12.0, 1234567.0, 12345678.0, 0.25, 0.0001, 0.00012345, 1e-05, 2.5e-7, 1e16, 1.5e17, -3e7, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: r.t for r in df.select("i", python_text(F.col("v"), "double").alias("t")).collect()}
    assert [got[i] for i in range(len(values))] == [None if v is None else str(v) for v in values]
    flags = df.select(python_text(F.col("v") > 1, "boolean").alias("t")).distinct().collect()
    assert {r.t for r in flags} == {"True", "False", None}
