"""Small tables that hold the odd cases: nulls, empty, very long and repeated texts, other columns."""

import pytest

LONG = "lorem ipsum dolor sit amet " * 6000
# Columns with names that the operators use inside.
EXTRA = "text string, doc_id long, n long, spans string, kept boolean, length int, _text string, _id long"


@pytest.fixture(scope="session")
def documents(spark):
    def build(pairs):
        rows = [(text, doc_id, 1, "x", True, 2, "y", 3) for doc_id, text in pairs]
        return spark.createDataFrame(rows, EXTRA)

    return build


@pytest.fixture(scope="session")
def odd_texts():
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one two three"),
        (5, "One  two\nthree"),
        (6, LONG),
        (7, LONG + "end"),
        (8, "a" * 5000),
        (9, "mail a.b@c.org 10.0.0.1 token = \"abcdef123456\" 4556737586899855 +1 (017) 555-7713"),
        (9, "mail a.b@c.org 10.0.0.1 token = \"abcdef123456\" 4556737586899855 +1 (017) 555-7713"),
        (None, "one two three"),
        (None, None),
        (10, "日本語 текст é à ü 😀   x"),
    ]


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest test tables."""
    folder = "/root/testdata/sf0.001"
    try:
        rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    except Exception:
        pytest.skip("needs the test tables")
    return [(r["doc_id"], r["text"]) for r in rows]
