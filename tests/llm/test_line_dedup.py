from collections import defaultdict

import pytest

from tallyspark.llm import line_dedup

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_length, min_documents):
    def key(line):
        return line.strip(BLANKS).translate(LOWER)

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= min_length:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_documents or doc_id == max(holders[key(x)])]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


LICENSE = "Permission is granted to everyone"


def texts_with_common_lines():
    rows = [(i, f"title {i} of some length here\n  {LICENSE.upper()}\t\nlast") for i in range(1, 30)]
    rows += [(40, LICENSE), (41, f"{LICENSE}\nown\n{LICENSE}\r\n"), (None, f"{LICENSE}\nx"), (None, f"{LICENSE}\nx")]
    # Found in two documents only, one of them twice; too short a key; É is not lower-cased.
    rows += [(50, "a line that two documents hold"), (50, "a line that two documents hold"), (51, "A line that two documents hold")]
    rows += [(i, "short line") for i in (60, 61, 62)]
    rows += [(i, line) for i, line in ((70, "É" * 20), (71, "é" * 20), (72, "É" * 20), (73, "É" * 20 + " "), (74, "é" * 19))]
    return rows


@pytest.mark.parametrize("hot", [1, line_dedup.HOT])
def test_common_lines(documents, odd_texts, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rows = odd_texts + texts_with_common_lines()
    assert result(line_dedup.dedup_lines(documents(rows).repartition(7))) == brute(rows, 20, 3)


def test_line_of_exactly_the_least_length(documents):
    rows = [(i, "x" * 20 + "\n" + "y" * 19) for i in range(3)]
    assert result(line_dedup.dedup_lines(documents(rows))) == brute(rows, 20, 3)
    assert [r[3] for r in brute(rows, 20, 3)] == [1, 1, 0]


def test_long_text_of_repeated_lines(documents):
    rows = [(i, "\n".join(f"a repeated line number {k % 500}" for k in range(20_000))) for i in range(3)]
    assert result(line_dedup.dedup_lines(documents(rows))) == brute(rows, 20, 3)


def test_other_bounds_and_sample(documents, sample):
    assert result(line_dedup.dedup_lines(documents(sample), min_length=1, min_documents=2)) == brute(sample, 1, 2)


def test_empty_table(documents):
    assert line_dedup.dedup_lines(documents([])).count() == 0
