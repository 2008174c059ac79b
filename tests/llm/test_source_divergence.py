import random
import re
from collections import Counter, defaultdict

import pytest

from tallyspark.llm import source_divergence

SCHEMA = "source string, term string, text string, lang string, doc_id long, n int, no int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least):
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = [t.translate(LOWER) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        counts[lang or "", source or ""].update(terms)
        documents[lang or ""].update(set(terms))
        groups[lang or ""].add(source or "")
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= least]

        def shares(count):
            below = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // below for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources - {s}]
            terms = [(-gap(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(s, "x", t, g, 1, 2, 3) for t, g, s in rows], SCHEMA)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def made(n, seed):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh日É" for b in ("x", "Yz", "é", "z")]
    rows = []
    for _ in range(n):
        source = rng.choice(["s1", "s2", "S1", "", None, "ä"])
        some = rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=rng.randint(0, 30))
        rows.append((" 1_".join(some), rng.choice(["en", "en", "de", None, "a\0b"]), source))
    return rows + [("rareterm", "it", "s1"), (None, "it", "s2"), ("", "nl", "only"), ("word\0other", "en", "s9")]


@pytest.mark.parametrize("slice_terms", [source_divergence.SLICE_TERMS, 30])
def test_groups_and_slices(spark, slice_terms, monkeypatch):
    monkeypatch.setattr(source_divergence, "SAMPLED", 1)
    rows = made(300, 1)
    found = source_divergence.divergence(table(spark, rows).repartition(5), slice_terms=slice_terms)
    assert result(found) == brute(rows, 10)


def test_small_steps(spark, monkeypatch):
    """The same sums when tasks merge and pass on after every few pairs."""
    monkeypatch.setattr(source_divergence, "STEP", 4)
    rows = made(120, 2)
    assert result(source_divergence.divergence(table(spark, rows), min_documents=3)) == brute(rows, 3)


def test_many_sources(spark):
    rows = [(f"common w{i % 7} w{i % 11} only{i}", "en", f"s{i}") for i in range(60)] * 2
    assert result(source_divergence.divergence(table(spark, rows), min_documents=2)) == brute(rows, 2)


def test_sample(spark, sample):
    rows = [(text, "en", f"s{(doc_id or 0) % 5}") for doc_id, text in sample]
    assert result(source_divergence.divergence(table(spark, rows))) == brute(rows, 10)


def test_shares_beyond_longs(spark):
    counts = [(n, total, terms) for n in (0, 5, 9_000_000_000, 10**13) for total in (10**13, 3 * 10**15) for terms in (1, 10**8)]
    df = spark.createDataFrame(counts, "n long, total long, terms long")
    columns = [df[c] for c in ("n", "total", "terms")]
    got = [r[0] for r in df.select(source_divergence.share(*columns)).collect()]
    assert got == [1 + 10**9 * (n + 2) // (total + 2 * terms) for n, total, terms in counts]


def test_long_texts_and_nothing(spark):
    rows = [("lorem ipsum dolor " * 40_000, "en", f"s{i % 2}") for i in range(10)] + [("ipsum", "en", "s0")]
    assert result(source_divergence.divergence(table(spark, rows))) == brute(rows, 10)
    assert source_divergence.divergence(table(spark, [])).count() == 0
    assert result(source_divergence.divergence(table(spark, [(None, None, None)] * 3))) == []


def test_slices_follow_the_kept_terms(spark, monkeypatch):
    rows = [(" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500)) + f" own{'x' * i}", "en", "s") for i in range(12)]
    monkeypatch.setattr(source_divergence, "SAMPLED", 2)
    terms = source_divergence.document_terms(table(spark, rows))  # text, lang and no are columns of it
    assert 4 <= source_divergence.slices_of(terms, 10, 100) <= 6
    assert source_divergence.slices_of(terms, 13, 100) == 1
