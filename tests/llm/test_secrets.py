"""Secrets: the threshold reaches its recall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import secret_scan


@pytest.mark.parametrize("share", [0.1, 0.3])
def test_threshold_reaches_recall_where_labels_overlap(share):
    random = np.random.default_rng(5)
    codes = random.integers(1, secret_scan.CODES, (1500, secret_scan.LENGTH)).astype(np.uint8)
    label = (random.random(len(codes)) < share).astype(np.int64)  # nothing tells them apart
    net = secret_scan.train(codes, label)
    held = secret_scan.held_out(codes, label, np.random.default_rng(7))
    assert (net.probability(codes[held & (label == 1)]) >= net.threshold).mean() >= secret_scan.RECALL


def test_copies_do_not_fill_the_training_rows(documents, monkeypatch):
    seen = {}
    monkeypatch.setattr(secret_scan, "train", lambda codes, label: seen.update(codes=codes, label=label))
    rows = [(k, f"see {k:03d}aBcDeFgHiJkLmNo{k} or token = 9x{k:03d}yyyyzzzzwwwwqqqq{k} end") for k in range(12)]
    secret_scan.learn(documents(rows * 10).repartition(3), rows=6)
    for value in (0, 1):
        mine = seen["codes"][seen["label"] == value]
        assert len(mine) == 6 and len(np.unique(mine, axis=0)) == 6


def test_copies_are_held_out_together():
    random = np.random.default_rng(1)
    windows = random.integers(1, secret_scan.CODES, (40, secret_scan.LENGTH)).astype(np.uint8)
    of = random.integers(0, 40, 600)
    label = (of < 15).astype(np.int64)
    label[of == 20] = random.integers(0, 2, (of == 20).sum())  # the same window with both labels
    held = secret_scan.held_out(windows[of], label, np.random.default_rng(7))
    assert not set(of[held]) & set(of[~held])
    assert {0, 1} == set(label[held]) == set(label[~held])


def test_every_window_of_a_candidate_is_learned_from(documents):
    blob = "".join(f"Zz{k:03d}Qq" for k in range(40))  # 280 characters, five windows
    late = "x9" * 70 + " token=" + "Ab3" * 50  # the second candidate is a finding from end to end
    got = secret_scan.labelled_windows(documents([(1, f"see {blob} end"), (2, late)])).collect()
    found = sorted((bytes(r["codes"]), r["label"]) for r in got)
    wanted = [(w, 0) for w in secret_scan.windows(f"see {blob} end", 4, 4 + len(blob))]
    for a, b in secret_scan.candidates(late):
        parts = secret_scan.windows(late, a, b)
        starts = range(a, b, secret_scan.INSIDE)
        base = secret_scan.base_spans(late)
        wanted += [(w, int(any(s < min(b, at + secret_scan.INSIDE) and e > at for s, _, e in base))) for w, at in zip(parts, starts)]
    assert len(wanted) == 5 + 3 + 3 and sum(label for _, label in wanted) == 3
    assert found == sorted(wanted)


def test_every_distinct_window_is_trained_on(documents, monkeypatch):
    seen = []
    averaged = secret_scan._averaged
    monkeypatch.setattr(secret_scan, "_averaged", lambda rows, state: seen.append(sum(r["n"] for r in rows)) or averaged(rows, state))
    rows = [(k, f"see {k:05d}aBcDeFgHiJkLmNo or token = 9x{k:05d}yyyyzzzzwwww end") for k in range(secret_scan.TRAINING_ROWS * 3 // 2)]
    docs = documents(rows + rows[:50]).repartition(3)
    net = secret_scan.learn(docs)
    found = secret_scan.labelled_windows(docs).distinct()
    fit = found.where(F.pmod(F.xxhash64("codes"), F.lit(5)) != 0)
    assert net is not None and seen and set(seen) == {fit.count()}
    assert fit.where("label = 1").count() > secret_scan.TRAINING_ROWS
