import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tallyspark.llm import dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    out = []
    for body, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(out, key=str)


def result(df):
    rows = df.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_odd_texts(documents, odd_texts):
    assert result(dedup.exact_dedup(documents(odd_texts))) == brute(odd_texts)


def test_sample_over_many_partitions(documents, sample):
    rows = sample + [(10_000 + i, sample[0][1]) for i in range(300)]
    assert result(dedup.exact_dedup(documents(rows).repartition(17))) == brute(rows)


def test_equal_digests_of_different_texts_stay_apart(documents, odd_texts):
    weak = dedup.exact_dedup(documents(odd_texts), digest=lambda text: F.unhex(F.lit("00")))
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in weak.collect()]
    assert sorted(got, key=str) == sorted([r[:4] for r in brute(odd_texts)], key=str)


def test_empty_table(documents):
    assert dedup.exact_dedup(documents([])).count() == 0
