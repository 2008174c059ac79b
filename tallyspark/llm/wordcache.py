"""Ids of texts by a ``tokenizers`` file, with the ids of frequent chunks remembered per worker.

A text is cut at single spaces and a chunk into the file's own pre-tokens, each merged by the
library's model once and then remembered. Both vocabularies used here start a new pre-token at a
space between words, so the ids of a text are those of its chunks one after the other. Where
blanks stand together, which the byte-level pattern treats as one run, and where a chunk holds
control characters, the text or chunk goes through the library whole, and so does a text that holds
one of the file's added tokens, which the library finds in plain text too.

A block of texts is cut in numpy; its chunks are looked up all at once in a table by two 64-bit hashes of
their bytes, Python sees only those that are not there, and the ids of all chunks are gathered from a pool
(two chunks are taken for equal with a probability of some 2^-128). Bytes that are no UTF-8 count as
U+FFFD, as Python replaces them.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import regex

from tallyspark.llm.text import Block, span_hashes

# Chunks and pre-tokens remembered at most, in each of two generations, so memory is bounded.
REMEMBERED = 300_000
# Chunks in the table of a worker at most: some 150 MB.
TABLE = 1 << 21
# Longer chunks are not remembered.
CHUNK_CHARS = 64
# The split pattern of byte-level files that name none.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in printable}
    others = [b for b in range(256) if b not in out]
    return out | {b: chr(256 + i) for i, b in enumerate(others)}


class _Store(dict):
    """Computes what it lacks and remembers two generations of it, so frequent keys stay."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older[key] if key in self.older else self.compute(key)
        if len(key) <= CHUNK_CHARS:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


# Bytes in another order, for a second hash.
_SWAPPED = np.random.default_rng(20260102).permutation(256).astype(np.uint8)


def _keys(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each span."""
    return np.stack([span_hashes(data, begin, end), span_hashes(_SWAPPED[data], begin, end)])


def _joined(found: list[bytes | None]) -> np.ndarray:
    return np.frombuffer(b"".join(ids or b"" for ids in found), dtype="<u4")


def _placed(found: list[bytes | None], base: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size (-1 for None) and begin of the ids at each place, joined from ``base`` on."""
    sizes = np.array([-1 if ids is None else len(ids) // 4 for ids in found], dtype=np.int64)
    held = np.maximum(sizes, 0)
    return sizes[place], (base + np.cumsum(held) - held)[place]


class _Known:
    """Ids of chunks by two hashes of their bytes: an open-addressed table of bounded size, cleared when full."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.slots = 1 << (2 * TABLE - 1).bit_length()
        self.keys = np.zeros((2, self.slots), dtype=np.uint64)
        self.entry = np.full(self.slots, -1, dtype=np.int32)
        self.sizes, self.begins = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)  # entry 0 has no ids
        self.ids = [np.zeros(0, dtype="<u4")]

    def pool(self) -> np.ndarray:
        if len(self.ids) > 1:
            self.ids = [np.concatenate(self.ids)]
        return self.ids[0]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 where there is none."""
        out = np.full(keys.shape[1], -1, dtype=np.int64)
        slot = (keys[0] & np.uint64(self.slots - 1)).astype(np.int64)
        left = np.arange(len(out))
        while len(left):
            at = slot[left]
            entry = self.entry[at]
            same = (self.keys[0, at] == keys[0, left]) & (self.keys[1, at] == keys[1, left]) & (entry >= 0)
            out[left[same]] = entry[same]
            left = left[(entry >= 0) & ~same]
            slot[left] = (slot[left] + 1) & (self.slots - 1)
        return out

    def add(self, keys: np.ndarray, found: list[bytes | None], wanted: np.ndarray) -> None:
        """Remember new keys, all different, and what was found for them."""
        some = np.flatnonzero(wanted)
        if len(self.sizes) + len(some) > TABLE:
            self.clear()
            some = some[: TABLE - 1]
        keys, found = keys[:, some], [found[i] for i in some.tolist()]
        first, base = len(self.sizes), sum(map(len, self.ids))
        size, begin = _placed(found, base, np.arange(len(found)))
        self.sizes, self.begins = np.concatenate([self.sizes, size]), np.concatenate([self.begins, begin])
        self.ids.append(_joined(found))
        slot = (keys[0] & np.uint64(self.slots - 1)).astype(np.int64)
        left = np.arange(len(found))
        while len(left):
            at = slot[left]
            free = self.entry[at] < 0
            self.entry[at[free]] = first + left[free]  # one of those that want a slot gets it
            mine = self.entry[at] == first + left
            self.keys[:, at[mine]] = keys[:, left[mine]]
            left = left[~mine]
            slot[left] = (slot[left] + 1) & (self.slots - 1)


class ChunkEncoder:
    """Texts to little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token["content"].encode() for token in spec.get("added_tokens", [])]
        self.normalizer = self.tokenizer.normalizer
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        split = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split"]
        self.pieces = regex.compile(split[0] if split else BYTE_PATTERN).findall
        self.keeps_space = not split
        self.model = self.tokenizer.model
        self.characters = byte_characters()
        self.of_piece = _Store(self._piece)
        self.of_chunk = _Store(self._chunk)
        self.of_head = _Store(self._head)
        self.known = _Known()

    def _library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable() and " " not in piece:
            mapped = piece
        else:
            mapped = "".join(map(self.characters.__getitem__, piece.encode()))
        return array("I", [token.id for token in self.model.tokenize(mapped)]).tobytes()

    def _chunk(self, chunk: str) -> bytes | None:
        """Ids of a chunk with the space before it; None where blanks could meet across its border."""
        if self.keeps_space:
            if chunk != chunk.strip() or not chunk:
                return None
            chunk = " " + chunk
        elif chunk.isascii():
            chunk = chunk.lower()
        else:
            chunk = self.normalizer.normalize_str(chunk)
        if not chunk.isprintable() and not chunk.replace("\n", "").isprintable():
            return self._library(chunk)
        return b"".join(map(self.of_piece.__getitem__, self.pieces(chunk)))

    def _head(self, chunk: str) -> bytes | None:
        """Ids of the first chunk of a text, which has no space before it."""
        if chunk != chunk.strip():
            return None
        return self._library(chunk) if chunk else b""

    def encode_block(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        if not texts:
            return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        block, known = Block(texts), self.known
        end = np.flatnonzero(block.data == 32)
        begin = np.concatenate([[0], end[:-1] + 1])
        first = np.searchsorted(begin, block.starts[:-1])
        row = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(begin))))
        whole = np.array([any(token in text for token in self.added) for text in texts])
        at = known.find(keys := _keys(block.data, begin, end))
        at[whole[row]] = 0  # not looked up
        if self.keeps_space:
            at[first] = 0
        new = np.flatnonzero(at < 0)
        _, one, place = np.unique(keys[0][new], return_index=True, return_inverse=True)
        one = new[one]
        raw = block.data.tobytes()
        chunks = [raw[a:b].decode("utf-8", "replace") for a, b in zip(begin[one].tolist(), end[one].tolist())]
        pool, sizes, spots = known.pool(), known.sizes, known.begins

        found = list(map(self._chunk, chunks))
        size, start = sizes[at], spots[at]
        size[new], start[new] = _placed(found, len(pool), place)
        parts = [pool, _joined(found)]
        if self.keeps_space:
            heads = [self.of_head[raw[a:b].decode("utf-8", "replace")] for a, b in zip(begin[first].tolist(), end[first].tolist())]
            size[first], start[first] = _placed(heads, sum(map(len, parts)), np.arange(len(first)))
            parts.append(_joined(heads))
        whole[row[size < 0]] = True
        # A text that goes through the library whole has all its ids in place of its first chunk.
        by_library = np.flatnonzero(whole)
        ids = [self._library(texts[i].decode("utf-8", "replace")) for i in by_library.tolist()]
        size[whole[row]] = 0
        size[first[by_library]], start[first[by_library]] = _placed(ids, sum(map(len, parts)), np.arange(len(ids)))
        parts.append(_joined(ids))
        known.add(keys[:, one], found, (end - begin)[one] <= CHUNK_CHARS)
        stop = np.cumsum(size)
        where = np.repeat(start - (stop - size), size) + np.arange(stop[-1])
        return np.concatenate(parts)[where], np.add.reduceat(size, first)

    def encode(self, text: str) -> bytes:
        if any(token.decode() in text for token in self.added):
            return self._library(text)
        chunks = text.split(" ")
        head = b""
        if self.keeps_space:
            first = chunks.pop(0)
            if first != first.strip():
                return self._library(text)
            head = self._library(first) if first else b""
        try:
            return head + b"".join(map(self.of_chunk.__getitem__, chunks))
        except TypeError:  # a chunk that cannot stand alone
            return self._library(text)


@lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    """One per worker process."""
    return ChunkEncoder(path)
