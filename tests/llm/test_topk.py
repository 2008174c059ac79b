import math

import numpy as np
import pytest

from tallyspark.llm import topk


def brute(rows, k, every=1):
    good = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in good:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def result(spark, rows, k, every=1, parts=3):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, terms string, score int")
    vectors = topk.quantize(df.repartition(parts))
    got = topk.top_k(vectors.filter(f"vec_id % {every} = 0"), vectors, k)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(0)
    vectors = np.round(random.normal(0, 1, (500, 8)), 1).astype(np.float32)
    vectors[40:60] = vectors[7]  # ties
    return [(int(i), [float(x) for x in v]) for i, v in zip(random.permutation(500), vectors)]


def test_against_brute_force(spark, rows):
    assert result(spark, rows, 20, 20) == brute(rows, 20, 20)


def test_query_blocks_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_VALUES", 64)
    monkeypatch.setattr(topk, "BLOCK", 16)
    assert result(spark, rows[:200], 5, 7) == brute(rows[:200], 5, 7)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0])]
    rows += [(5, [0.5, -0.01, 3.0]), (6, []), (7, [1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0]), (9, [0.0, 0.0])]
    assert result(spark, rows, 3) == brute(rows, 3)


def test_fewer_candidates_and_empty_tables(spark):
    assert result(spark, [(0, [1.0])], 3) == []
    assert result(spark, [], 3) == []
    assert result(spark, [(1, [1.0]), (2, [1.0])], 3, 5) == []


def test_large_components_are_exact(spark):
    rows = [(i, [float(2**24 + 2 * i), float(-(2**23) - i)]) for i in range(6)]
    assert result(spark, rows, 4) == brute(rows, 4)


def test_blocks_are_left_once_bounds_fall_below():
    """Bounds never cut a result: with the best block first the others are not needed."""
    ids = np.arange(1000)
    vectors = np.zeros((1000, 4), dtype=np.int64)
    vectors[:, 0] = 1000 - ids
    row, found, score = topk.search(np.array([-1]), np.array([[1, 0, 0, 0]]), ids, vectors, 5)
    assert found.tolist() == [0, 1, 2, 3, 4] and score.tolist() == [1000, 999, 998, 997, 996]
