import numpy as np
import pytest

from tallyspark.operators import metric_index, vectors
from tallyspark.session import shared_folder


def frame(spark, named, column):
    rows = [(name, None if v is None else [float(x) for x in v]) for name, v in named]
    return spark.createDataFrame(rows, f"{column} string, vector array<double>").repartition(3)


def rows(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "document_id", "distance").collect())


def clustered(seed, documents, width=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(12, width)) * 20
    points = middle[rng.integers(0, 12, documents)] + rng.normal(size=(documents, width))
    return points, middle


@pytest.mark.parametrize("metric", ["l2", "ip", "cosine"])
def test_same_rows_as_a_scan(spark, metric, monkeypatch):
    """Copies, ties on a grid, null and zero vectors, hot cells in parts and hot questions in blocks."""
    monkeypatch.setattr(metric_index, "BLOCK_ROWS", 7)
    points, middle = clustered(1, 600)
    named = [(f"d{i:04d}", p) for i, p in enumerate(points)]
    named += [(f"copy{i:04d}", points[0]) for i in range(300)]
    named += [(f"grid{i:04d}", [i % 3, i % 2, i % 5, 0, 0, 1]) for i in range(120)]
    named += [(f"zero{i}", [0.0] * 6) for i in range(3)] + [("none", None), (None, points[1])]
    asked = [(f"q{i:02d}", m) for i, m in enumerate(middle)] + [(f"same{i:02d}", points[0]) for i in range(40)]
    asked += [("zero", [0.0] * 6), ("grid", [1, 1, 1, 0, 0, 1]), ("far", [1e4] * 6), ("none", None), (None, points[1])]
    documents, queries = frame(spark, named, "document_id"), frame(spark, asked, "query_id")
    index = metric_index.build_index(documents, shared_folder(spark), metric, cell_rows=20, part_rows=30)
    assert index.rows == len(named) - 2 and len(index.cells.cell) > 20
    for k in (1, 8):
        assert rows(index.search(queries, k)) == rows(vectors.knn_topk(queries, documents, k, metric, cells=3))
    again = metric_index.open_index(spark, index.path)
    assert again.metric == metric and rows(again.search(queries, 2)) == rows(index.search(queries, 2))


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_far_cells_are_not_measured(spark, metric):
    points, middle = clustered(2, 3000)
    documents = frame(spark, [(f"d{i:04d}", p) for i, p in enumerate(points)], "document_id")
    queries = frame(spark, [(f"q{i}", m) for i, m in enumerate(middle)], "query_id")
    index = metric_index.build_index(documents, shared_folder(spark), metric, cell_rows=50)
    pairs = index.measured(queries, 5)
    assert 12 * 5 <= pairs < 0.25 * 12 * 3000


def test_questions_do_not_go_where_their_bound_rules_out(spark):
    points, middle = clustered(3, 2000)
    documents = frame(spark, [(f"d{i:04d}", p) for i, p in enumerate(points)], "document_id")
    index = metric_index.build_index(documents, shared_folder(spark), "l2", cell_rows=50)
    queries = vectors.checked_vectors(frame(spark, [("q", points[0])], "query_id"), "query_id")
    best = rows(index.search(queries.withColumnRenamed("id", "query_id"), 5))[-1][3]
    from pyspark.sql import functions as F

    limited = queries.withColumn("limit", F.lit(float(best)))
    visited = index._asked(limited, 5, False).count() + index._asked(limited, 5, True).count()
    assert 1 <= visited < len(index.cells.cell) / 3


def test_more_neighbours_than_documents(spark):
    documents = frame(spark, [("a", [0.0]), ("b", [3.0])], "document_id")
    queries = frame(spark, [("q", [1.0])], "query_id")
    index = metric_index.build_index(documents, shared_folder(spark))
    assert rows(index.search(queries, 5)) == [("q", 1, "a", 1.0), ("q", 2, "b", 4.0)]


def test_nothing_stored_and_nothing_asked(spark):
    none = frame(spark, [("a", None)], "document_id")
    queries = frame(spark, [("q", [1.0])], "query_id")
    index = metric_index.build_index(none, shared_folder(spark))
    assert index.rows == 0 and index.search(queries, 5).collect() == []
    index = metric_index.build_index(frame(spark, [("a", [1.0])], "document_id"), shared_folder(spark))
    assert index.search(frame(spark, [("q", None)], "query_id"), 5).collect() == []


def test_only_zero_vectors_by_direction(spark):
    documents = frame(spark, [("a", [0.0, 0.0]), ("b", [0.0, 0.0])], "document_id")
    index = metric_index.build_index(documents, shared_folder(spark), "cosine")
    found = rows(index.search(frame(spark, [("q", [1.0, 2.0])], "query_id"), 1))
    assert found == [("q", 1, "a", 1.0)]


@pytest.mark.parametrize("bad", [[1.0], [float("nan"), 1.0]])
def test_odd_vectors_are_named(spark, bad):
    documents = frame(spark, [(f"fine{i}", [1.0, 2.0 + i]) for i in range(20)] + [("odd", bad)], "document_id")
    with pytest.raises(Exception, match="odd"):
        metric_index.build_index(documents, shared_folder(spark), cell_rows=5)


def test_large_numbers_do_not_cancel(spark):
    named = [(f"d{i:03d}", [1e8, 1.0 + i]) for i in range(100)]
    index = metric_index.build_index(frame(spark, named, "document_id"), shared_folder(spark), cell_rows=10)
    found = rows(index.search(frame(spark, [("q", [1e8, 1.0])], "query_id"), 3))
    assert [r[2:] for r in found] == [("d000", 0.0), ("d001", 1.0), ("d002", 4.0)]


def test_a_small_cell_is_one_file(spark):
    """A folder of a few rows in many files costs more than its rows."""
    from pathlib import Path

    points, _ = clustered(4, 2000)
    documents = frame(spark, [(f"d{i:04d}", p) for i, p in enumerate(points)], "document_id")
    index = metric_index.build_index(documents, shared_folder(spark), "l2", cell_rows=50)
    folders = [*Path(index.path, "documents").glob("cell=*")]
    assert len(folders) == len(index.cells.cell) > 20
    assert all(len([*folder.glob("*.parquet")]) == 1 for folder in folders)
    assert index.cells.longest == pytest.approx(float(np.sqrt((points**2).sum(axis=1).max())))


def test_nearest_pivot_block_by_block(monkeypatch):
    points, pivots = clustered(5, 500)
    whole = ((points[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
    for values in (1, 7 * len(pivots), 1 << 18):
        monkeypatch.setattr(metric_index, "NEAR_VALUES", values)
        assert metric_index._nearest_pivot(points, pivots).tolist() == whole.tolist()
