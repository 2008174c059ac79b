"""Whole texts in numpy: Arrow batches to bytes, words and hashes.

Null texts count as empty. Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes with
A-Z lower-cased; equal words have equal 64-bit hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of text that one numpy step holds at most, unless a single text is longer.
BLOCK_BYTES = 2 << 20
# Rows of an Arrow batch of texts.
BATCH_ROWS = 1000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_KEYS = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            up = np.full(n, _BASE, dtype=np.uint64)
            down = np.full(n, _INVERSE, dtype=np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


class Block:
    """Texts of a few rows as one byte array; ``bounds[i]:bounds[i + 1]`` is text i."""

    def __init__(self, texts: list[bytes]):
        self.rows = len(texts)
        self.data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=self.rows)
        self.starts = np.zeros(self.rows + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=self.starts[1:])
        self.lengths = lengths

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes, word starts and ends in them, and the first word of each row (rows + 1)."""
        lower = _LOWER[self.data]
        inside = ~_SPACE[lower]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate([[0], edge])
        begin, end = edge[0::2], edge[1::2]
        return lower, begin, end, np.searchsorted(begin, self.starts)

    def word_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit hash of each word and the first word of each row (rows + 1)."""
        lower, begin, end, first = self.words()
        up, down = _POWERS.upto(len(lower) + 1)
        total = np.zeros(len(lower) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_KEYS[lower] * up[: len(lower)], out=total[1:])
        hashes = (total[end] - total[begin]) * down[begin]
        return mix(hashes + (end - begin).astype(np.uint64)), first


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted without repeats (faster than np.unique on short arrays)."""
    values = np.sort(values)
    keep = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shingle_hashes(block: Block, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a shorter text is one shingle; none without words."""
    words, first = block.word_hashes()
    n = len(words)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(min(width, n)):  # the words that follow, within the block
        key[: n - k] += mix(words[k:] + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    key = mix(key)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(distinct(key[a : b - width + 1]))
        elif b > a:
            short = np.uint64(b - a)
            for k in range(b - a):
                short = short + mix(words[a + k : a + k + 1] + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            out.append(mix(short + np.uint64(0xD6E8FEB86659FD93)))
        else:
            out.append(key[:0])
    return out


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def in_blocks(
    batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``limit`` bytes, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        total = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = 0
        while at < batch.num_rows:
            base = int(total[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


def small_batches(df: DataFrame) -> DataFrame:
    """Let Arrow batches hold few rows: a batch of whole texts stands in the JVM and in the worker at once."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def texts(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Only id and text, the id as long."""
    return small_batches(df).select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))


def remainder(doc_id: Column | str, modulus: int = 5) -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of the bytes as they stand; equal spans have equal hashes."""
    up, down = _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_KEYS[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
