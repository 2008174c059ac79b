"""Byte-level BPE in numpy: pieces of equal length class are rows of one padded matrix.

Each round every unfinished row merges its leftmost pair of least rank; the matrix of pair ranks is
kept beside the ids and only the two pairs next to a merge are looked up again, in a hash table of
all pairs that make a token. Finished rows leave the matrix, and a merged row closes up by one place.
Pieces of over ``LONG`` bytes, where rounds over whole rows would cost the square of the length, take
the same merges from a heap. Ids of a piece are remembered, in bounded number.

Defined cases: null and empty texts have no ids; null ids of documents stay; repeated rows are coded
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.text import in_blocks, texts

LONG = 256
# Width classes of the padded matrices.
WIDTH_STEP = 4
# Pieces remembered at most, in each of two generations.
REMEMBERED = 300_000

_NONE = np.int64(1 << 40)


class PairTable:
    """Open addressing: (left id, right id) to the merged id, which is also the pair's rank."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(10, int(len(merged)).bit_length() + 2)
        size = 1 << self.bits
        self.keys = np.full(size, -1, dtype=np.int64)
        self.values = np.full(size, _NONE, dtype=np.int64)
        keys = (left << 32) | right
        slot, waiting, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(waiting):
            self.probes += 1
            free = self.keys[slot[waiting]] == -1
            taken, first = np.unique(slot[waiting[free]], return_index=True)
            chosen = waiting[free][first]
            self.keys[taken], self.values[taken] = keys[chosen], merged[chosen]
            waiting = np.setdiff1d(waiting, chosen)
            slot[waiting] = (slot[waiting] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id, or a number above all ids."""
        keys = (left << 32) | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], _NONE)
        missed = np.flatnonzero((found != keys) & (found != -1))
        while len(missed):
            slot[missed] = (slot[missed] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[missed]]
            hit = found == keys[missed]
            out[missed[hit]] = self.values[slot[missed[hit]]]
            missed = missed[~hit & (found != -1)]
        return out


class BytePairCoder:
    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.pieces = regex.compile(pattern).findall
        self.single = np.full(256, -1, dtype=np.int64)
        for byte in range(256):
            self.single[byte] = ranks[bytes([byte])]
        splits = [
            (ranks[token[:k]], ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        left, right, merged = np.array(splits, dtype=np.int64).T
        self.table = PairTable(left, right, merged)
        by_id = dict(zip(ranks.values(), ranks))
        top = max(by_id) + 1
        self.token_lengths = np.array([len(by_id.get(i, b"")) for i in range(top)], dtype=np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(top)), dtype=np.uint8)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merge_rows(self, ids: np.ndarray, used: np.ndarray) -> list[bytes]:
        """Merge all rows of one padded matrix; ``used`` is each row's length."""
        rows = np.arange(len(ids))
        out: list[bytes] = [b""] * len(ids)
        width = ids.shape[1]
        ranks = np.full((len(ids), width), _NONE, dtype=np.int64)
        if width > 1:
            inside = np.arange(1, width) < used[:, None]
            ranks[:, :-1][inside] = self.table.ranks(ids[:, :-1][inside], ids[:, 1:][inside])
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            done = best >= _NONE
            if done.any():
                for i in np.flatnonzero(done).tolist():
                    out[rows[i]] = ids[i, : used[i]].astype("<u4").tobytes()
                live = ~done
                rows, ids, ranks, used, at, best = rows[live], ids[live], ranks[live], used[live], at[live], best[live]
                if not len(rows):
                    break
            n, width = ids.shape
            line = np.arange(n)
            ids[line, at] = best
            keep = np.ones((n, width), dtype=bool)
            keep[line, at + 1] = False  # the right half leaves, the row closes up
            ids = ids[keep].reshape(n, width - 1)
            ranks = ranks[keep].reshape(n, width - 1)
            used = used - 1
            ranks[line, at] = _NONE
            has = np.flatnonzero(at + 1 < used)
            ranks[has, at[has]] = self.table.ranks(ids[has, at[has]], ids[has, at[has] + 1])
            has = np.flatnonzero(at > 0)
            ranks[has, at[has] - 1] = self.table.ranks(ids[has, at[has] - 1], ids[has, at[has]])
        return out

    def _merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece, by a heap over a linked list."""
        ids = self.single[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        ahead, behind = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.table.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(rank, i, ids[i], ids[i + 1]) for i, rank in enumerate(first) if rank < _NONE]
        heapq.heapify(heap)
        lookup: dict[tuple[int, int], int] = {}

        def rank_of(pair: tuple[int, int]) -> int:
            if pair not in lookup:
                lookup[pair] = int(self.table.ranks(np.array([pair[0]]), np.array([pair[1]]))[0])
            return lookup[pair]

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = ahead[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two is gone
            ids[i], ids[j] = rank, -1
            ahead[i] = ahead[j]
            if ahead[j] < n:
                behind[ahead[j]] = i
            for a in (behind[i], i):
                b = ahead[a] if a >= 0 else n
                if a >= 0 and b < n and (r := rank_of((ids[a], ids[b]))) < _NONE:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return np.array([i for i in ids if i >= 0], dtype="<u4").tobytes()

    def merge(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces as little-endian unsigned 32-bit bytes."""
        out: dict[str, bytes] = {}
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            if len(raw) > LONG:
                out[piece] = self._merge_long(raw)
            else:
                classes.setdefault(-(-len(raw) // WIDTH_STEP) * WIDTH_STEP, []).append((piece, raw))
        for width, members in classes.items():
            step = max(1, (1 << 18) // max(width, 1))
            for a in range(0, len(members), step):
                part = members[a : a + step]
                padded = b"".join(raw.ljust(width, b"\0") for _, raw in part)
                ids = self.single[np.frombuffer(padded, dtype=np.uint8)].reshape(len(part), width)
                used = np.array([len(raw) for _, raw in part], dtype=np.int64)
                out.update(zip((piece for piece, _ in part), self._merge_rows(ids, used)))
        return out

    def encode(self, texts_: list[str]) -> list[bytes]:
        cut = [self.pieces(text) for text in texts_]
        new = {p for pieces in cut for p in set(pieces) if p not in self.known}
        again = {p: self.older[p] for p in new if p in self.older}
        fresh = again | self.merge([p for p in new if p not in again])
        if len(self.known) + len(fresh) > REMEMBERED:
            self.older, self.known = self.known, {}
            fresh.update((p, self.older[p]) for pieces in cut for p in set(pieces) if p in self.older)
        self.known.update(fresh)
        out = [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]
        for piece in [p for p in fresh if len(p) > 64]:
            del self.known[piece]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.token_lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.token_starts[ids] - (ends - lengths), lengths)
        return self.token_bytes[shift + np.arange(len(shift))].tobytes()


@lru_cache(maxsize=2)
def coder(rank_file: str, pattern: str) -> BytePairCoder:
    """One per worker process."""
    return BytePairCoder(rank_file, pattern)


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text, without special tokens."""

    def run(batches):
        code = coder(rank_file, pattern)
        for batch in in_blocks(batches):
            ids = code.encode([text or "" for text in batch.column("text").to_pylist()])
            stops = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32))
            column = pa.ListArray.from_arrays(pa.array(stops), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], names=["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that the ids stand for; null ids count as none."""

    def run(batches):
        code = coder(rank_file, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                column = batch.column("ids")
                rows = [row.values.to_numpy() if row.is_valid else () for row in column]
                decoded = [code.decode(np.asarray(row, dtype=np.int64)) for row in rows]
                columns = [batch.column("doc_id"), column, pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    return coded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded binary"
    )
