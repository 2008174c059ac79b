import os
import re
from collections import defaultdict

import pytest

import corpus_pipeline
from tallyspark.llm import secret_scan
from test_ngram_join import brute

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")

SECRET = 'plain words before token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and some more words after it to read'
ODD = [
    (90_001, None), (90_002, ""), (90_003, SECRET), (90_004, SECRET.replace(" ", "  ")), (None, SECRET), (90_005, "one two"),
    (90_005, "one two"), (90_006, "lorem ipsum dolor sit amet " * 3000),
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in ODD], real.schema)
    return real.unionByName(odd).repartition(5).cache()


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_quality_drops_rows_and_keeps_columns(spark, docs):
    kept = corpus_pipeline.quality_stage(spark, docs, FOLDER)
    assert kept.schema == docs.schema
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    ids = {i for i, _ in rows_of(kept)}
    right = [(i in ids) == (quality == 1) for i, quality in labels.items()]
    assert sum(right) >= 0.95 * len(right)


def test_exact_stage_leaves_one_of_each_text(spark, docs):
    out = corpus_pipeline.exact_stage(spark, docs, FOLDER)
    assert out.columns == docs.columns
    groups = defaultdict(list)
    for i, text in rows_of(docs):
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(i)
    wanted = [min(i for i in ids if i is not None) for ids in groups.values()]
    left = [i for i, _ in rows_of(out)]
    assert sorted(i for i in left if i is not None) == sorted(wanted)
    assert left.count(None) == sum(i is None for i, _ in ODD)


def test_near_stage_leaves_one_of_each_group(spark, docs):
    out = corpus_pipeline.near_stage(spark, docs, FOLDER)
    assert out.columns == docs.columns
    wanted = sorted((i for i, _, c in brute(rows_of(docs)) if i is None or i == c), key=str)
    assert sorted((i for i, _ in rows_of(out)), key=str) == wanted


def test_secret_stage_redacts_and_spares(spark, docs):
    out = corpus_pipeline.secret_stage(spark, docs, FOLDER)
    assert out.schema == docs.schema
    before, after = defaultdict(list), defaultdict(list)
    for table, found in ((docs, before), (out, after)):
        for r in table.collect():
            found[r["doc_id"]].append((r["text"], r["n_chars"]))
    assert before.keys() == after.keys()
    for i, rows in before.items():
        for (text, n), (new, m) in zip(sorted(rows, key=str), sorted(after[i], key=str)):
            if secret_scan.base_spans(text or ""):
                assert not secret_scan.base_spans(new) and m == len(new) and "[SECRET]" in new
            elif new != text:
                assert "[SECRET]" in new
            else:
                assert m == n


def test_run_is_its_stages(spark):
    out = corpus_pipeline.run(spark, FOLDER).collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "secrets", "packing"]
    lengths = defaultdict(int)
    tokens = {}
    for r in out:
        lengths[r["doc_id"]] += r["length"]
        tokens[r["doc_id"]] = r["doc_tokens"]
    assert out and dict(lengths) == tokens


def test_stages_pass_empty_tables(spark, docs):
    empty = docs.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0
