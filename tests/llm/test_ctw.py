"""The context tree's deep nodes: equal to a walk, and long contexts, capitals and digits tell."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import ctw

HALF = math.log(0.5)


def steps(text):
    padded = b"\n" * 7 + text
    return [(padded[i : i + 7][::-1], padded[i + 7]) for i in range(len(text))]  # nearest byte first


def name(context, depth):
    """What the node of a depth knows: classes of the last 1 to 3 bytes, then the last 4 to 7 bytes themselves."""
    return tuple(int(ctw._CLASS[b]) for b in context[:depth]) if depth <= 3 else context[:depth]


def walk(corpus, text):
    counts, children = {}, {}
    for t in corpus:
        for context, byte in steps(t):
            path = 1
            for k in range(7, -1, -1):
                bit = byte >> k & 1
                for depth in range(8):
                    node = (path, depth, name(context, depth))
                    counts.setdefault(node, [0, 0])[bit] += 1
                    if depth < 7:
                        children.setdefault(node, set()).add((path, depth + 1, name(context, depth + 1)))
                path = path * 2 + bit

    def kt(node):
        a, b = counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    known = {}

    def weighted(node):
        if node not in known:
            below = [weighted(c) for c in children.get(node, ())]
            known[node] = float(np.logaddexp(HALF + kt(node), HALF + sum(below))) if below else kt(node)
        return known[node]

    total = 0.0
    for context, byte in steps(text):
        path = 1
        for k in range(7, -1, -1):
            one, rest = 0.0, 1.0
            for depth in range(8):
                node = (path, depth, name(context, depth))
                a, b = counts.get(node, (0, 0))
                deeper = (path, depth + 1, name(context, depth + 1)) in counts
                # Depth 3 always stands; below it the deepest node that was seen ends the path.
                own = 1.0 if depth == 7 or depth >= 3 and not deeper else 0.5 if not a + b else math.exp(HALF + kt(node) - weighted(node))
                one, rest = one + rest * own * (b + 0.5) / (a + b + 1), rest * (1 - own)
            bit = byte >> k & 1
            total += math.log10(one if bit else 1 - one)
            path = path * 2 + bit
    return total


@pytest.mark.parametrize("block", [4 << 20, 16])
def test_deep_tree_equals_a_walk(documents, monkeypatch, block):
    monkeypatch.setattr(ctw, "DEEP_BLOCK", block)
    texts = ["Ab Ab1.é the cat sat", "", "the cat sat on the mat, the cat 17 and 18", "THE CAT", "abba\n the mat", "", "the cat was at é 17"]
    got = ctw.score_documents(documents(list(enumerate(texts))).repartition(2), F.col("doc_id") >= 4).collect()
    train = [t.encode() for t in texts[:4]]
    assert len(got) == len(texts)
    for row in got:
        assert row["score"] == pytest.approx(walk(train, texts[row["doc_id"]].encode()), rel=1e-5), row["doc_id"]


def test_contexts_of_a_word_capitals_and_digits_tell(documents):
    random = np.random.default_rng(3)
    # After "x" or "y", six bytes alike, then a byte that only the seventh byte before tells.
    pairs = {"x": "q", "y": "k", "1": "j", "2": "v", "A": "w", "a": "z"}
    line = lambda: "".join(f"{c}......{pairs[c]}" for c in random.choice(list(pairs), 40))
    got = ctw.score_documents(documents([(i, line()) for i in range(60)]), F.col("doc_id") >= 50)
    bits = got.filter("held_out").agg(F.avg("bits_per_byte").alias("b")).first()["b"]
    assert bits < (math.log2(6) + 0.4) / 8  # the choice of the pair is all that is left open


def test_dealt_cells_come_back(documents):
    random = np.random.default_rng(0)
    texts = [bytes(random.integers(97, 100, n, dtype=np.uint8)) for n in (0, 1, 300, 5)]
    parts = list(ctw.pack_pieces(texts, np.array([True, False, True, True]), 7))
    table = lambda p: {"size": [p[1]], "keys": [p[2]], "counts": [p[3]]}
    import pyarrow as pa

    total = sum(int(ctw._merged(pa.table(table(p)))[1].sum()) for p in parts)
    assert total == 305 and len({p[0] for p in parts}) == len(parts)
