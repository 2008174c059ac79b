import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import evidence, grounding, investigation, vectors


def brute(queries, documents, k, metric):
    out = set()
    for q, a in queries:
        a = np.array(a)
        scored = []
        for d, b in documents:
            b = np.array(b)
            distance = {
                "l2": lambda: float(((a - b) ** 2).sum()),
                "ip": lambda: float(1 - a @ b),
                "cosine": lambda: float(1 - a @ b / np.sqrt((a @ a) * (b @ b))),
            }[metric]()
            scored.append((round(distance, 9), d))
        out |= {(q, d, rank) for rank, (_, d) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("metric", ["l2", "ip", "cosine"])
def test_nearest_whatever_the_cells(spark, metric):
    rng = random.Random(5)
    queries = [(f"q{i}", [float(rng.randint(1, 3)) for _ in range(4)]) for i in range(7)]
    documents = [(f"d{i:03d}", [float(rng.randint(1, 3)) for _ in range(4)]) for i in range(150)]
    documents += [(f"copy{i:03d}", documents[0][1]) for i in range(60)]
    q = spark.createDataFrame(queries, "query_id string, vector array<double>")
    d = spark.createDataFrame(documents, "document_id string, vector array<double>").repartition(5)
    pick = lambda df: {(r.query_id, r.document_id, r["rank"]) for r in df.collect()}
    found = [vectors.knn_topk(q, d, 6, metric, cells=cells).cache() for cells in (1, 3, 50)]
    rows = [sorted(tuple(r) for r in df.collect()) for df in found]
    assert rows[0] == rows[1] == rows[2]
    if metric != "cosine":  # there rounding may order equal distances otherwise than plain Python
        assert pick(found[0]) == brute(queries, documents, 6, metric)


def _nearest(spark, queries, documents, k, metric="l2"):
    q = spark.createDataFrame(queries, "query_id string, vector array<double>")
    d = spark.createDataFrame(documents, "document_id string, vector array<double>")
    rows = vectors.knn_topk(q, d, k, metric, cells=2).collect()
    return [(r.document_id, r.distance) for r in sorted(rows, key=lambda r: (r.query_id, r["rank"]))]


def test_large_numbers_do_not_cancel(spark):
    found = _nearest(spark, [("q", [1e8, 1.0])], [("near", [1e8, 1.0]), ("a", [1e8, 3.0]), ("b", [1e8, 2.0])], 2)
    assert found == [("near", 0.0), ("b", 1.0)]


def test_zero_vectors_stay_and_null_vectors_go(spark):
    documents = [("zero", [0.0, 0.0]), ("same", [2.0, 2.0]), ("none", None), ("back", [-1.0, -1.0])]
    found = _nearest(spark, [("q", [1.0, 1.0]), (None, [1.0, 1.0]), ("empty", None)], documents, 3, "cosine")
    assert [name for name, _ in found] == ["same", "zero", "back"] and found[1][1] == 1.0


@pytest.mark.parametrize("bad", [[1.0], [1.0, None], [float("nan"), 1.0]])
def test_odd_vectors_are_named(spark, bad):
    with pytest.raises(Exception, match="odd"):
        _nearest(spark, [("q", [1.0, 1.0])], [("fine", [1.0, 2.0]), ("odd", bad)], 2)


def test_building_a_search_starts_no_job(spark):
    q = spark.createDataFrame([("q", "ACC001")], "query_id string, query string")
    d = spark.createDataFrame([("d", [1.0] * 64)], "document_id string, vector array<float>")
    spark.sparkContext.setJobGroup("building", "plan only")
    vectors.knn_topk(vectors.query_vectors(q), d, 3)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("building") == []
    spark.sparkContext.setJobGroup("after", "")


def test_vectors_from_outside(spark):
    text = ("document_type", "account_id", "security_id", "position_date", "event_date", "title", "source_tables")
    d = spark.createDataFrame([("d1", [1.0] * 384), ("d2", [0.0] * 384)], "document_id string, vector array<double>")
    d = d.withColumns({name: F.lit("") for name in (*text, "text")})
    q = spark.createDataFrame([("q", "anything")], "query_id string, query string")
    asked = spark.createDataFrame([("q", [0.9] * 384)], "query_id string, vector array<double>")
    found = vectors.similarity_retriever(q, d, 1, asked).collect()
    assert [(r.document_id, round(r.distance, 6)) for r in found] == [("d1", 3.84)]
    assert "title" in found[0] and "source_tables" in found[0]
    rows = evidence.hybrid_evidence(investigation.parse_query(q), d, 1, asked=asked).collect()
    assert [(r.document_id, r.is_exact) for r in rows] == [("d1", False)]


def test_no_queries(spark):
    q = spark.createDataFrame([], "query_id string, vector array<float>")
    d = spark.createDataFrame([("d", [1.0])], "document_id string, vector array<float>")
    assert vectors.knn_topk(q, d, 3).collect() == []
    assert vectors.knn_topk(d.withColumnRenamed("document_id", "query_id"), q.withColumnRenamed("query_id", "document_id"), 3).collect() == []


def test_term_vector_counts_tokens(spark):
    df = spark.createDataFrame([("a", "Why why 2025-01-02?"), ("b", None)], "id string, text string")
    got = {r.id: list(r.v) for r in df.select("id", vectors.term_vector("text").alias("v")).collect()}
    assert sum(got["a"]) == 3.0 and max(got["a"]) >= 2.0 and sum(got["b"]) == 0.0


def test_term_vector_of_odd_texts(spark, monkeypatch):
    """The same counts as SQL's md5 of each token gives, also when the places known are dropped meanwhile."""
    monkeypatch.setattr(vectors, "KNOWN", 3)
    texts = ["A--b a.-b x. .y 1.2.3-z", "\u0130STANBUL caf\u00e9 \u212a9 \U0001f600x9", "", None, " ", "a a a-a a.a"]
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "id int, text string")
    tokens = F.expr(r"explode(regexp_extract_all(lower(text), '[a-z0-9]+(?:[.-][a-z0-9]+)*', 0))")
    place = F.expr("cast(conv(substring(md5(token), 1, 8), 16, 10) as bigint) % 64")
    counted = df.select("id", tokens.alias("token")).groupBy("id", place.alias("place")).count().collect()
    wanted = {i: [0.0] * 64 for i in range(len(texts))}
    for row in counted:
        wanted[row["id"]][row["place"]] = float(row["count"])
    shown = df.select("id", vectors.term_vector("text").alias("v"))
    assert {row["id"]: row["v"] for row in shown.collect()} == wanted
    assert "ArrowEvalPython" in shown._jdf.queryExecution().executedPlan().toString()  # no lambda over each token


def test_source_tables_parse_back(spark):
    df = spark.createDataFrame([('["a","b"]',), ("",), ("plain",)], "s string")
    got = {r.s: r.p for r in df.select("s", vectors.parsed_source_tables("s").alias("p")).collect()}
    assert got == {'["a","b"]': ["a", "b"], "": [], "plain": ["plain"]}


DOC = (
    "document_id string, document_type string, account_id string, security_id string, position_date string, "
    "event_date string, title string, text string, source_tables string"
)


@pytest.fixture(scope="module")
def documents(spark):
    rows = [
        ("z1", "RECONCILIATION_BREAK_SUMMARY", "ACC001", "SEC001", "2025-01-02", "", "Doc one", "break acc001", "[]"),
        ("a1", "TRADE_QUALITY_SUMMARY", "ACC001", "SEC001", "2025-01-02", "", "Doc two", "flags acc001", "[]"),
        ("b1", "EVENT_WINDOW_SUMMARY", "", "SEC001", "", "2025-01-02", "Doc three", "event sec001", "[]"),
        ("c1", "RECONCILIATION_BREAK_SUMMARY", "ACC002", "SEC002", "2025-01-05", "", "Doc four", "summary of break", "[]"),
    ]
    return spark.createDataFrame(rows, DOC).withColumn("vector", vectors.term_vector("text"))


@pytest.fixture(scope="module")
def questions(spark):
    rows = [
        ("q1", "why is acc001 / SEC001 off on 2025-01-02"),
        ("q2", "events of sec001?"),
        ("q3", "anything"),
        ("q4", "ACC0011 SEC00 25-01-02"),
        ("q5", "ACC001 SEC001 on 2025-13-45"),
    ]
    return spark.createDataFrame(rows, "query_id string, query string")


def test_parse_query(questions):
    got = {r.query_id: (r.account_id, r.security_id, r.target_date) for r in investigation.parse_query(questions).collect()}
    assert got == {
        "q1": ("ACC001", "SEC001", "2025-01-02"),
        "q2": (None, "SEC001", None),
        "q3": (None, None, None),
        "q4": (None, None, None),
        "q5": ("ACC001", "SEC001", "2025-13-45"),
    }


def test_evidence_tiers(questions, documents):
    rows = evidence.hybrid_evidence(investigation.parse_query(questions), documents, 3).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.document_id, r.is_exact))
    assert got["q1"] == [("z1", True), ("a1", True), ("b1", False)]
    assert got["q2"] == [("a1", True), ("b1", True), ("z1", True)]
    assert got["q3"] == [("a1", False), ("b1", False), ("c1", False)]


def test_packets_and_scores(spark, table, questions, documents):
    breaks = table(
        "break_id string, account_id string, security_id string, position_date date, expected_position double, "
        "reported_position double, position_difference double, break_reason_code string, "
        "root_cause_reason_code string, severity string",
        [("b", "ACC001", "SEC001", "2025-01-02", 5.0, None, None, "POSITION_NOT_REPORTED", "POSITION_NOT_REPORTED", "LOW")],
    )
    flags = table(
        "flag_id string, flag_type string, account_id string, security_id string, flag_date date, severity string, "
        "description string, affected_entity string, affected_record_id string",
        [(f"f{i:02d}", "LATE", "ACC001", "SEC001", "2025-01-02", "H", "d", "trades", f"T{i}") for i in range(30)]
        + [("g", "DUP", "ACC009", "SEC009", "2025-02-02", "H", "d", "trades", "T9"), ("h", "DUP", None, "SEC001", None, "H", "d", "trades", "T8")],
    )
    numbers = {name: F.lit(0.5) for name in investigation.EVENT_FIELDS[5:10]}
    metrics = table("event_id string, security_id string, event_date date, event_type string", [
        ("e1", "SEC001", "2025-01-07", "X"), ("e2", "SEC001", "2025-01-08", "X"),
    ]).withColumns(numbers).withColumn("is_full_window", F.lit(True))
    events = table("event_id string, security_id string, event_date date, event_type string, event_summary string", [
        ("e1", "SEC001", "2025-01-07", "Y", "text"),
    ])
    packets = investigation.investigation_packet(questions, breaks, flags, metrics, events, documents, 3)
    got = {r.query_id: r for r in packets.collect()}
    first = got["q1"]
    assert "reported position was None, and difference was None." in first.summary
    assert first.structured_break.expected_position == "5.0"
    assert [f.affected_record_id for f in first.quality_flags] == [f"T{i}" for i in range(20)]
    assert [(e.event_id, e.event_type, e.event_summary, e.is_full_window) for e in first.event_context] == [("e1", "Y", "text", "True")]
    assert first.missing_data_notes == [] and first.retrieved_evidence_titles == ["Doc one", "Doc two", "Doc three"]
    assert [e.event_id for e in got["q2"].event_context] == ["e1", "e2"]
    assert [f.flag_type for f in got["q2"].quality_flags][:2] == ["DUP", "LATE"] and len(got["q2"].quality_flags) == 20
    assert [f.affected_record_id for f in got["q3"].quality_flags][:2] == ["T9", "T8"]
    assert got["q5"].quality_flags is None and got["q5"].event_context is None
    scores = {r.query_id: r for r in grounding.groundedness(packets).collect()}
    assert scores["q1"].groundedness_score == 0.8 and scores["q1"].matching_document_ids == ["z1", "a1"]
    assert scores["q1"].unsupported_claim_risk == "LOW" and not scores["q1"].missing_data_coverage
    assert scores["q3"].unsupported_claim_risk == "MEDIUM" and scores["q3"].missing_data_coverage
    assert scores["q3"].evidence_type_coverage and scores["q3"].groundedness_score == 0.4
    assert scores["q3"].recommendation.startswith("Investigation packet needs manual review")
    # Without a table of documents the packet still answers.
    bare = investigation.investigation_packet(questions, breaks, flags, metrics, events, None, 3)
    got = {r.query_id: r for r in bare.collect()}
    assert got["q1"].structured_break.expected_position == "5.0" and got["q1"].retrieved_evidence is None
    assert "retrieval returned no evidence documents." in got["q1"].missing_data_notes
    risks = {r.query_id: r.unsupported_claim_risk for r in grounding.groundedness(bare).collect()}
    assert risks["q1"] == "LOW" and risks["q3"] == "HIGH"


def test_a_literal_star_is_an_ordinary_value(spark, table, questions):
    flags = table(
        "flag_id string, flag_type string, account_id string, security_id string, flag_date date, severity string, "
        "description string, affected_entity string, affected_record_id string",
        [("f", "LATE", "*", "*", "2025-01-02", "H", "d", "trades", "T1"), ("n", "LATE", None, None, None, "H", "d", "trades", "T2")],
    )
    rows = investigation.lookup_flags(investigation.parse_query(questions), flags).collect()
    assert sorted((r.query_id, r.affected_record_id) for r in rows) == [("q3", "T1"), ("q3", "T2"), ("q4", "T1"), ("q4", "T2")]
