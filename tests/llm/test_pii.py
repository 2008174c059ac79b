"""Personal data: labels reach every mention of a long document."""

import numpy as np
import pytest

from tallyspark.llm import pii


@pytest.fixture
def weights():
    """Nothing learned: similar mentions prefer equal labels."""
    size = len(pii.KINDS) + 1
    return pii.Weights(np.zeros((pii.WIDTH, size)), np.zeros((size, size)), pii.SAME * np.eye(size))


@pytest.mark.parametrize("before", [0, 30])
def test_labels_reach_fifty_mentions(weights, before):
    mention = "then we spoke of 017-555-7713 again. "
    text = mention * before + "Call +1 (017) 555-7713 now. " + mention * 50
    spans = pii.find_spans([text], weights)[0]
    assert sum(not s[3] and s[0] == "phone" for s in spans) == before + 50


def test_each_mention_is_next_to_its_base_span():
    text = "+1 (017) 555-7713 " + "and 017-555-7713 " * 20
    graph = pii.document_graph(text, pii.base_spans(text))
    assert set(np.unique(graph.skip[(graph.skip == 0).any(axis=1)])) == set(range(21))
    assert len(graph.skip) <= 4 * len(graph.spans)


def test_rare_findings_are_learned_from(documents):
    rows = [(k, f"lot {k * 7919} of {k}") for k in range(300)]
    rows += [(1000, "at 10.0.0.1 and " + "then 5 " * 200), (1001, "then 5 " * 200 + "mail a.b@c.org"), (1002, "+1 (017) 555-7713")]
    docs = documents(rows).repartition(3)
    assert pii.learn(docs, limit=4) is not None
    keys = {r["key"] for r in pii.training_keys(docs, limit=4).collect()}
    held = {r["doc_id"] for r in docs.selectExpr("doc_id", "xxhash64(text) as key").collect() if r["key"] in keys}
    assert held >= {1000, 1001, 1002} and len(held) <= 7


def test_nodes_come_from_whole_texts():
    label = np.zeros(500, dtype=np.int64)
    label[[300, 499]] = 1, 4
    chosen = pii._chosen(label)
    assert len(chosen) == pii.NODES_A_DOC and {300, 499} <= set(chosen.tolist()) and (chosen >= 64).sum() > 40


def test_copies_are_learned_from_once(documents):
    rows = [(k, "Mail a.b@c.org or 10.0.0.1 and +1 (017) 555-7713, 12") for k in range(40)] + [(99, "in 2024")]
    weights = [pii.learn(documents(rows[n:]).repartition(3)) for n in (0, 39)]
    for a, b in zip(*(vars(w).values() for w in weights)):
        assert np.allclose(a, b)
