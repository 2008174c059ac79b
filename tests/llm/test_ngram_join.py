from collections import defaultdict

import numpy as np
import pytest

from tallyspark.llm import graph, ngram_join
from tallyspark.llm.text import Block, distinct, shingle_hashes

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(set)
    for at, (i, s) in enumerate(sets):
        for token in s:
            holders[token].add(at)
    near = {(a, b) for held in holders.values() for a in held for b in held if a < b}
    for a, b in near:
        (i, x), (j, y) = sets[a], sets[b]
        if i is not None and j is not None and 100 * len(x & y) >= 80 * len(x | y):
            lo, hi = sorted((find(i), find(j)))
            root[hi] = lo
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def result(df):
    rows = df.select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_shingle_hashes_equal_sets():
    texts = ["a b", "", " A\tB ", "a b c d e f", "X a b c d e", "a b c d e", "a b c d", "é É e\x0b\x0cf g h i", "w " * 30]
    hashed = shingle_hashes(Block([t.encode() for t in texts]))
    for x, s in zip(texts, hashed):
        for y, t in zip(texts, hashed):
            assert len(shingles(x) & shingles(y)) == len(np.intersect1d(s, t))


def near_copies(random, words, n, changes):
    base = [f"w{k}" for k in random.integers(0, 5000, words)]
    for _ in range(n):
        copy = list(base)
        for at in random.integers(0, words, int(random.integers(0, changes + 1))):
            copy[at] = f"n{random.integers(0, 10**9)}"
        yield " ".join(copy)


def test_odd_texts(documents, odd_texts):
    assert result(ngram_join.similar_groups(documents(odd_texts))) == brute(odd_texts)


def test_empty_table(documents):
    assert ngram_join.similar_groups(documents([])).count() == 0


def test_near_copies_of_many_sizes(documents):
    random, texts = np.random.default_rng(3), []
    for words in (5, 6, 8, 12, 20, 33, 60, 150, 400, 1500):
        for _ in range(4):
            texts += near_copies(random, words, 6, max(1, words // 30))
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [passage + " " + " ".join(f"q{random.integers(0, 10**6)}" for _ in range(120)) for _ in range(60)]
    rows = [(int(i), t) for i, t in zip(random.permutation(10_000), texts)]
    assert result(ngram_join.similar_groups(documents(rows).repartition(5))) == brute(rows)


def test_chains_and_large_buckets(documents, monkeypatch):
    """Neighbours in a chain are similar, its ends are not; buckets are larger than a block."""
    monkeypatch.setattr(ngram_join, "LARGE", 5)
    monkeypatch.setattr(ngram_join, "MEET", 4)
    random = np.random.default_rng(5)
    words = [f"c{k}" for k in range(400)]
    rows = [(k, " ".join(words[3 * k : 3 * k + 120])) for k in range(60)]
    shared = " ".join(f"s{k}" for k in range(100))
    rows += [(100 + k, shared + " " + " ".join(f"t{random.integers(0, 10**6)}" for _ in range(30 + k % 3))) for k in range(40)]
    shuffled = [rows[k] for k in random.permutation(len(rows))]
    assert result(ngram_join.similar_groups(documents(shuffled).repartition(3))) == brute(shuffled)


def test_sample(documents, sample):
    rows = sample + [(20_000 + k, sample[3][1]) for k in range(50)]
    assert result(ngram_join.similar_groups(documents(rows).repartition(7))) == brute(rows)


@pytest.mark.parametrize("size", [4, 5, 7, 9, 12, 19, 40, 90, 300])
def test_no_similar_pair_is_missed(size):
    """Signatures of the allocation meet for every similar pair, whatever the levels."""
    random = np.random.default_rng(size)
    for _ in range(300):
        base = random.integers(0, 1 << 63, size, dtype=np.uint64)
        other = base[int(random.integers(0, size // 5 + 1)) :]
        other = np.append(other, random.integers(0, 1 << 63, int(random.integers(0, size // 5 + 1)), dtype=np.uint64))
        x, y = distinct(base), distinct(other)
        if not ngram_join.similar(x, y) or (len(x) == len(y) and (x == y).all()):
            continue
        published = []
        for tokens in (x, y):
            band = ngram_join._own_band(len(tokens))
            below = (band - 1,) if ngram_join._has_below(len(tokens), band) else ()
            published.append({s for b in (band, *below) for s in ngram_join._published(tokens, b)[0].tolist()})
        assert published[0] & published[1]


def test_sketches_never_differ_in_more_bits_than_sets_in_tokens():
    random = np.random.default_rng(2)
    for size in (1, 5, 60, 64, 65, 130, 500, 1025, 3000):
        base = distinct(random.integers(0, 1 << 63, size, dtype=np.uint64))
        for cut in (0, 1, size // 3):
            other = distinct(np.append(base[cut:], random.integers(0, 1 << 63, cut // 2 + 2, dtype=np.uint64)))
            x, y = ngram_join._sketches([ngram_join.sketch(base), ngram_join.sketch(other)])
            differ = len(base) + len(other) - 2 * len(np.intersect1d(base, other))
            assert int(np.bitwise_count(x ^ y).sum()) <= differ
            if ngram_join.similar(base, other):
                assert ngram_join._within(np.array([differ]), np.array([len(base) + len(other)]))[0]


def test_components(spark):
    random = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 400, (260, 2))] + [(1000 + k, 1001 + k) for k in range(90)]
    edges += [(5000, 5001 + k) for k in range(200)]
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == root and len(got) == len(root)
