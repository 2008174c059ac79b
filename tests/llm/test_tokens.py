"""BPE, token files and packing against the tokenizer libraries."""

import base64
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallyspark.llm import bpe, packing, simple8b, tokenfile, wordcache
from tallyspark.session import shared_folder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [
    "", "  a  b", "a\n\n b \n c", "x   y", " lead", "trail ", "́a", "é éx", "<|endoftext|> x <|endoftext|>",
    "a b", "'S x'll don't I'LL", "tab\tx  \t y", "\x1c a\x1cb", "ŉ İI ΑΣ ſ", "日本 語123 ४५", "a​b  c", "x\ny z\n",
    "\n", "\n a", "½ ² Ⅷ", "😀 a😀b", "a b  c", "﻿x", "word" * 400,
]


def reference(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tiktoken_ids():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    coding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: coding.encode_ordinary(text or "")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_library_ids(name, sample):
    ids, encoder = reference(name), wordcache.ChunkEncoder(public_tokenizers.path(name))
    for text in ODD + [text for _, text in sample[:60]]:
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == ids(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_blocks_give_the_library_ids(name, sample):
    """Also texts with added tokens, nulls, and texts beside one that goes through the library whole."""
    ids, encoder = reference(name), wordcache.ChunkEncoder(public_tokenizers.path(name))
    texts = [None, *ODD, "a <|endoftext|> b", "x<|startoftext|>y", "<|ENDOFTEXT|>", *[t for _, t in sample[:60]], "", None]
    for part in (texts, texts[::-1], texts[:1], []):
        found, lengths = encoder.encode_block([(t or "").encode() for t in part])
        cut = np.split(found, np.cumsum(lengths)[:-1]) if part else []
        assert [c.tolist() for c in cut] == [ids(t) for t in part]


def test_blocks_forget_and_find_again(monkeypatch):
    monkeypatch.setattr(wordcache, "TABLE", 4)
    encoder, ids = wordcache.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json")), reference("word_bpe_49k.json")
    for texts in (["a b c a", "d e f g"], ["a c e", "h"], ["g b", "x" * 70 + " a"], [""]):
        found, lengths = encoder.encode_block([t.encode() for t in texts])
        assert [c.tolist() for c in np.split(found, np.cumsum(lengths)[:-1])] == [ids(t) for t in texts]


def test_blocks_replace_bytes_that_are_no_text():
    encoder = wordcache.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    found, _ = encoder.encode_block([b"a \xff\xfe b\xc3"])
    assert found.tolist() == reference("byte_bpe_50k.json")("a \ufffd\ufffd b\ufffd")


def test_remembered_chunks_are_bounded(monkeypatch):
    monkeypatch.setattr(wordcache, "REMEMBERED", 3)
    encoder = wordcache.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids = reference("byte_bpe_50k.json")
    for text in ("a b c d e f g", "a b c d e f g", "h a i b"):
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == ids(text)
    assert len(encoder.of_chunk) <= 3 and len(encoder.of_chunk.older) <= 3


def test_bpe_equals_tiktoken(documents, odd_texts, sample, tiktoken_ids):
    rows = odd_texts + sample[:50] + [(100 + i, t) for i, t in enumerate(ODD)] + [(99, "ab" * 700 + " x" + "日本" * 300)]
    coded = bpe.encode(documents(rows).repartition(3), RANKS, public_tokenizers.PATTERN)
    got = bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=str) == sorted(
        ((i, tiktoken_ids(t), (t or "").encode()) for i, t in rows), key=str
    )


def test_bpe_of_an_empty_table(documents):
    coded = bpe.encode(documents([]), RANKS, public_tokenizers.PATTERN)
    assert bpe.decode(coded, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_forgets_and_finds_again(monkeypatch, tiktoken_ids):
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    coder = bpe.BytePairCoder(RANKS, public_tokenizers.PATTERN)
    for texts in (["a b c", "d e f g"], ["a c e", "h"], ["g b", "x" * 70 + " a"]):
        assert [np.frombuffer(i, dtype="<u4").tolist() for i in coder.encode(texts)] == [tiktoken_ids(t) for t in texts]


@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 1023, 1024, 1025, 5000])
def test_simple8b_round_trip(n):
    random = np.random.default_rng(n)
    values = random.integers(0, 1 << 62, n, dtype=np.uint64) >> random.integers(0, 62, n, dtype=np.uint64)
    for column in (values, np.zeros(n, np.uint64), np.full(n, (1 << 64) - 1, np.uint64), np.where(np.arange(n) % 7 == 0, (1 << 64) - 2, values).astype(np.uint64)):
        words, lanes = simple8b.encode(column)
        assert (simple8b.decode(words, lanes, n) == column).all()


def test_simple8b_is_word_aligned_and_tight():
    words, lanes = simple8b.encode(np.ones(simple8b.LANE, dtype=np.uint64))
    assert len(words) == -(-simple8b.LANE // 60) and lanes.tolist() == [0]


def test_token_files(spark, documents, odd_texts, sample):
    rows = odd_texts + sample[:80]
    ids, path = reference("word_bpe_49k.json"), shared_folder(spark)
    tokenfile.write_tokens(documents(rows).repartition(5), public_tokenizers.path("word_bpe_49k.json"), path)
    got = tokenfile.read_tokens(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    start, wanted = 0, defaultdict(list)
    for i, text in rows:
        wanted[i].append([*ids(text), 1])
    for row in got:
        tokens = np.frombuffer(bytes(row["ids"]), dtype="<u4").tolist()
        assert row["start"] == start
        wanted[row["doc_id"]].remove(tokens)
        start += len(tokens)


def test_token_files_of_an_empty_table(spark, documents):
    path = shared_folder(spark)
    tokenfile.write_tokens(documents([]), public_tokenizers.path("word_bpe_49k.json"), path)
    assert tokenfile.read_tokens(spark, path).count() == 0


def test_packing(documents, odd_texts, sample):
    rows, capacity = odd_texts + sample, 512
    ids = reference("byte_bpe_50k.json")
    got = packing.pack_documents(documents(rows).repartition(6), public_tokenizers.path("byte_bpe_50k.json"), 1, capacity).collect()
    sequences, made = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        made[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for pieces in sequences.values():  # gapless from 0, never too long
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    wanted = defaultdict(list)
    for i, text in rows:
        tokens = np.array([*ids(text), 1], dtype="<u4")
        for a in range(0, len(tokens), capacity):
            part = tokens[a : a + capacity]
            wanted[i].append((a, len(part), zlib.crc32(part.tobytes()), len(tokens)))
    assert {i: sorted(p) for i, p in made.items()} == {i: sorted(p) for i, p in wanted.items()}
    assert sum(r["length"] for r in got) > 0.95 * capacity * (len(sequences) - 1)


def test_packing_of_an_empty_table(documents):
    assert packing.pack_documents(documents([]), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_plan_uses_the_whole_histogram():
    histogram = {2048: 3, 1500: 7, 700: 5, 548: 9, 100: 40, 1: 5}
    plans = packing.plan_packs(histogram, 2048)
    used = defaultdict(int)
    for count, lengths in plans:
        assert sum(lengths) <= 2048
        for length in lengths:
            used[length] += count
    assert dict(used) == histogram
