import hashlib
import re
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import filter_audit
from tallyspark.llm.text import Block

EXTRA = "text string, doc_id long, lang string, part string, digest string, words int, failing string"


def numbers(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return [len(words), len(set(words)), len(text), len(re.findall("[A-Z]", text)), len(re.findall("[#$%&*|]", text))]


def failing(rows):
    for doc_id, text, lang in rows:
        text = text or ""
        words, distinct, points, capitals, symbols = numbers(text)
        smaller = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows)
        fails = [words < 100, 100 * distinct < 80 * words, 100 * capitals > 10 * points, symbols > 0, smaller]
        yield doc_id, lang or "", {letter for letter, bad in zip("ABCDE", fails) if bad}


def brute(rows, labels):
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    found = list(failing(rows))
    out = {}
    for part in {part for _, part, _ in found}:
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [(i, bad) for i, p, bad in found if p == part]
            everyone = list(left)
            for step, letter in enumerate(order, 1):
                removed = [(i, bad) for i, bad in left if letter in bad]
                left = [(i, bad) for i, bad in left if letter not in bad]
                removed_by[letter] += len(removed)
                out[part, "".join(order), step] = [
                    len(left),
                    len(removed),
                    sum(letter in bad for _, bad in everyone) - len(removed),
                    sum(bad == {letter} for _, bad in everyone),
                    sum(i in good for i, _ in removed),
                    sum(i in toxic for i, _ in removed),
                ]
        for key in out:
            if key[0] == part:
                out[key].append(removed_by[key[1][key[2] - 1]])
    return out


def result(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in df.collect()}


def tables(spark, rows, labels):
    docs = spark.createDataFrame([(t, i, g, "x", "y", 1, "z") for i, t, g in rows], EXTRA)
    return docs, spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")


def test_every_order(spark, odd_texts):
    long = " ".join(f"word{i}" for i in range(120))
    rows = [(i, t, "en" if k % 3 else None) for k, (i, t) in enumerate(odd_texts)]
    rows += [(20 + i, long, "de") for i in range(4)] + [(30, long.upper(), "de"), (31, long + " #", "en"), (32, "a " * 200, "en")]
    rows += [(20, long, "en"), (20, long, "de"), (33, None, ""), (34, "AB" * 80 + " é" * 150 + "|", "en")]
    labels = [(20, 1, 0), (21, 1, 1), (21, 0, 0), (22, None, 1), (30, 1, None), (None, 1, 1), (99, 1, 1), (32, 1, 1), (33, 1, 0)]
    docs, marks = tables(spark, rows, labels)
    assert result(filter_audit.audit(docs.repartition(5), marks)) == brute(rows, labels)


def test_copies_over_many_partitions(spark):
    rows = [(i, "one text for all", "en") for i in range(500)] + [(None, "one text for all", "en")] * 20
    docs, marks = tables(spark, rows, [(7, 1, 1)])
    found = result(filter_audit.audit(docs.repartition(40), marks))
    assert found["en", "EABCD", 1] == [21, 499, 0, 0, 1, 1, 60 * 499]


def test_sample(spark, sample):
    rows = [(i, t, "en" if i % 2 else "de") for i, t in sample]
    labels = [(i, i % 3 == 0, i % 5 == 0) for i, _ in sample]
    docs, marks = tables(spark, rows, [(i, int(a), int(b)) for i, a, b in labels])
    assert result(filter_audit.audit(docs, marks)) == brute(rows, labels)


def test_empty_tables(spark):
    docs, marks = tables(spark, [], [])
    assert filter_audit.audit(docs, marks).count() == 0
    docs, marks = tables(spark, [(1, "a", "en")], [])
    assert filter_audit.audit(docs, marks).count() == 600


letters = st.text(st.sampled_from("aAbé日😀 \t\n\x0b#|1\x00"), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(letters, min_size=1, max_size=6))
def test_transducer_counts(texts):
    assert filter_audit.count_texts([t.encode() for t in texts]).T.tolist() == [numbers(t) for t in texts]


def test_state_after_a_byte_is_its_class():
    """What makes one look-up for all bytes the same as running the transducer byte by byte."""
    data = "Tab\tÉ日x #".encode()
    state, said = filter_audit.SPACE, []
    for byte in data + b" ":
        kind = filter_audit._CLASS[byte]
        said.append(int(filter_audit.EMIT[state, kind]))
        state = kind
    counts, begin, end = filter_audit.run(Block([data]))
    assert counts[0, 0] == sum(s & filter_audit.IS_POINT for s in said) - 1
    assert begin.tolist() == [i for i, s in enumerate(said) if s & filter_audit.BEGINS]
    assert end.tolist() == [i for i, s in enumerate(said) if s & filter_audit.ENDS]


def test_bytes_that_are_no_text():
    points = filter_audit.count_texts([b"\x80\x80a\xc3", b"a\xff\xfe"])[2].tolist()
    assert points == [3, 3]


def test_equal_hashes_of_different_words(monkeypatch):
    """The table compares bytes, so words that all share one hash are still told apart."""
    monkeypatch.setattr(filter_audit, "span_hashes", lambda data, begin, end: np.zeros(len(begin), dtype=np.uint64))
    texts = ["one two one three", "two two " + "long" * 30 + " " + "long" * 29 + "lonh " + "long" * 30, ""]
    assert filter_audit.count_texts([t.encode() for t in texts])[1].tolist() == [3, 3, 0]


def test_digest_is_of_the_whole_text(spark):
    docs, _ = tables(spark, [(1, "a" * 300_000, "en"), (2, None, "en")], [])
    found = {r["doc_id"]: bytes(r["digest"]) for r in filter_audit.text_counts(docs).collect()}
    assert found == {1: hashlib.sha256(b"a" * 300_000).digest(), 2: hashlib.sha256(b"").digest()}
