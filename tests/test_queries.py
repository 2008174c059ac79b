"""Queries beside their SQL twins. All of them: TALLY_ALL=1, on $TALLY_DIR."""

import os
import sys

import pytest

import __spark_entry__ as contract
from workbench.compare import connect, difference
from workbench.registry import ORACLES, QUERIES

FOLDER = os.environ.get("TALLY_DIR", "/root/testdata/sf0.001")
SHORT = (
    "clean_trades",
    "raw_record_hash",
    "trade_quality_flags",
    "split_factors",
    "position_reconstruction",
    "break_summary",
    "event_window_metrics",
    "investigation_corpus",
    "knn_topk",
    "groundedness",
    "timing_divergence",
    "forward_split_positions",
    "detection_scorecard",
)
NAMES = tuple(QUERIES) if os.environ.get("TALLY_ALL") else SHORT

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, duck, name):
    assert difference(spark, duck, FOLDER, name) is None


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("missing", ["tallyspark.llm", "corpus_pipeline"])
def test_contract_without_the_training_data_part(monkeypatch, missing):
    monkeypatch.setitem(sys.modules, missing, None)
    monkeypatch.delitem(sys.modules, "tallyspark.llm.queries", raising=False)
    assert set(QUERIES) <= set(contract.queries()) and "pipeline" not in contract.queries()
    assert set(contract.oracle_sql()) >= set(ORACLES)
