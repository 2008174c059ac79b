"""Filter interaction audit: what five filters remove alone, together and in every order.

1. One pass over the bytes of every whole text. A table-driven transducer reads one byte after the other: its
   state is the class of the byte before, and ``EMIT[state, class]`` says what that step counts (a code point, a
   capital, a symbol) and whether a word begins or ends there. The state after a byte depends on that byte alone,
   so a block of texts runs as one table look-up for all its bytes. The word spans go into an open-addressed
   hash table; a span that meets a taken slot is compared with its holder byte by byte, so the distinct words of a
   text are counted exactly.
2. Equal texts are told by SHA-256. Rows become one row per digest, part, filters and labels, with the number
   of rows at the smallest id; partial aggregation keeps a group of copies of any size out of a single task.
3. What is left is a row per part and set of failing filters, at most 128 a part. It is written out once for each
   order and step and summed.

Defined cases: a null text is empty (it fails A only, and E where a smaller id is empty too); a null lang is the
empty part; a row with a null id fails no E, makes no other row fail it and has no labels; rows that repeat id and
text do not fail E by each other; an id with several label rows counts as marked if one of them marks it; a label
without a document is left out; an empty table gives an empty result; columns other than id, text and lang are not
read, so their names cannot clash. Bytes that are no UTF-8: each byte of 128 to 191 without a byte over 127 before
it counts as a code point of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.store import settle
from tallyspark.llm.text import Block, as_bytes, in_blocks, mix, small_batches, span_hashes

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80  # per cent of the words
MAX_CAPITALS = 10  # per cent of the code points
SYMBOLS = b"#$%&*|"

# Byte classes, which are the states too.
SPACE, CAPITAL, SYMBOL, ASCII, LEAD, TAIL = range(6)
_CLASS = np.full(256, ASCII, dtype=np.uint8)
_CLASS[[32, 9, 10, 11, 12, 13]] = SPACE
_CLASS[65:91] = CAPITAL
_CLASS[list(SYMBOLS)] = SYMBOL
_CLASS[128:192] = TAIL
_CLASS[192:] = LEAD

# What a step emits.
IS_POINT, IS_CAPITAL, IS_SYMBOL, BEGINS, ENDS = 1, 2, 4, 8, 16


def _emissions() -> np.ndarray:
    """What the transducer says in each state (row) at each byte class (column)."""
    emit = np.zeros((6, 6), dtype=np.uint8)
    emit[:, [SPACE, CAPITAL, SYMBOL, ASCII, LEAD]] |= IS_POINT
    emit[:LEAD, TAIL] |= IS_POINT
    emit[:, CAPITAL] |= IS_CAPITAL
    emit[:, SYMBOL] |= IS_SYMBOL
    emit[SPACE, CAPITAL:] |= BEGINS
    emit[CAPITAL:, SPACE] |= ENDS
    return emit


EMIT = _emissions()

# Spans longer than this are compared as bytes objects.
LANES = 32
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def run(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the code points, capitals and symbols; the word begins and the word ends of the block."""
    classes = _CLASS[block.data]
    state = np.empty_like(classes)
    state[:1], state[1:] = SPACE, classes[:-1]
    said = EMIT.ravel()[state * np.uint8(6) + classes]
    starts = block.starts[:-1]
    counts = np.stack(
        [np.add.reduceat((said & what) != 0, starts, dtype=np.int64) for what in (IS_POINT, IS_CAPITAL, IS_SYMBOL)]
    )
    counts[0] -= 1  # the blank behind each text
    return counts, np.flatnonzero(said & BEGINS), np.flatnonzero(said & ENDS)


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans of equal length that begin at ``a`` and ``b`` are equal, 8 bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,)).copy()
    same = np.ones(len(a), dtype=bool)
    left = np.arange(len(a))
    for at in range(0, LANES, 8):
        rest = length[left] - at
        other = (lanes[a[left] + at] ^ lanes[b[left] + at]) & _MASKS[np.minimum(rest, 8)]
        same[left[other != 0]] = False
        left = left[(rest > 8) & (other == 0)]
        if not len(left):
            return same
    for i in left.tolist():
        n = int(length[i])
        same[i] = data[a[i] : a[i] + n].tobytes() == data[b[i] : b[i] + n].tobytes()
    return same


def distinct_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Indices of one span for each row and content.

    All spans probe an open-addressed table at once: a free slot takes one of those that want it, then each span is
    held against the holder of its slot, and those that differ go on to the next slot. Equal spans of a row have the
    same probe sequence and move together, so none enters twice.
    """
    n = len(begin)
    length = end - begin
    slots = 1 << max(4, (2 * n - 1).bit_length())
    slot = (mix(span_hashes(data, begin, end) + row.astype(np.uint64)) & np.uint64(slots - 1)).astype(np.int64)
    holder = np.full(slots, -1, dtype=np.int64)
    entered = []
    waiting = np.arange(n)
    while len(waiting):
        wanted = slot[waiting]
        free = holder[wanted] < 0
        holder[wanted[free]] = waiting[free]
        met = holder[wanted]
        entered.append(waiting[met == waiting])
        alike = (row[met] == row[waiting]) & (length[met] == length[waiting])
        check = np.flatnonzero(alike & (met != waiting))
        done = met == waiting
        done[check] = _same_bytes(data, begin[waiting[check]], begin[met[check]], length[waiting[check]])
        waiting = waiting[~done]
        slot[waiting] = (slot[waiting] + 1) & (slots - 1)
    return np.concatenate(entered) if entered else np.empty(0, dtype=np.int64)


COUNTS = ("words", "distinct_words", "code_points", "capitals", "symbols")
COUNT_SCHEMA = "doc_id long, part string, digest binary, " + ", ".join(f"{name} long" for name in COUNTS)


def count_texts(texts: list[bytes]) -> np.ndarray:
    """A row of ``COUNTS`` for each text."""
    block = Block(texts)
    (points, capitals, symbols), begin, end = run(block)
    first = np.searchsorted(begin, block.starts)
    words = np.diff(first)
    row = np.repeat(np.arange(block.rows), words)
    kept = distinct_spans(block.data, begin, end, row)
    return np.stack([words, np.bincount(row[kept], minlength=block.rows), points, capitals, symbols])


def text_counts(docs: DataFrame, text: str = "text", id_column: str = "doc_id", part: str = "lang") -> DataFrame:
    """``COUNTS`` and the SHA-256 of every whole text, with id and part."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            texts = as_bytes(batch.column("text"))
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            columns = [batch.column("doc_id"), batch.column("part"), digests, *map(pa.array, count_texts(texts))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "digest", *COUNTS])

    return (
        small_batches(docs)
        .select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.coalesce(F.col(part), F.lit("")).alias("part"),
            F.col(text).alias("text"),
        )
        .mapInArrow(count, COUNT_SCHEMA)
    )


def own_failures() -> Column:
    """The letters of the filters that a text fails by itself."""
    fails = {
        "A": F.col("words") < MIN_WORDS,
        "B": 100 * F.col("distinct_words") < MIN_DISTINCT * F.col("words"),
        "C": 100 * F.col("capitals") > MAX_CAPITALS * F.col("code_points"),
        "D": F.col("symbols") > 0,
    }
    return F.concat(*[F.when(test, letter).otherwise("") for letter, test in fails.items()])


def failing_sets(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part, set of failing filters and labels: ``part, failing, good, toxic, n``."""
    marked = (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    rows = counts.select("doc_id", "part", "digest", own_failures().alias("failing"))
    known = rows.filter("doc_id is not null").join(marked, "doc_id", "left")
    unknown = rows.filter("doc_id is null")
    flag = [F.coalesce(F.col(name), F.lit(False)).alias(name) for name in ("good", "toxic")]
    cell = ["digest", "part", "failing", "good", "toxic"]
    each = (
        known.unionByName(unknown, allowMissingColumns=True)
        .select("doc_id", "part", "digest", "failing", *flag)
        .groupBy(*cell, "doc_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = F.col("doc_id").isNotNull()
    cells = each.groupBy(*cell).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("unnamed"),
        F.min(F.when(named, F.struct("doc_id", "n"))).alias("first"),
    )
    # A digest has at most four of these rows a part.
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    stays = F.col("unnamed") + F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0)
    split = cells.select("part", "failing", "good", "toxic", "n", stays.alias("stays")).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct("failing", F.col("stays").alias("n")),
                F.struct(F.concat("failing", F.lit("E")).alias("failing"), (F.col("n") - F.col("stays")).alias("n")),
            )
        ).alias("set"),
    )
    return split.groupBy("part", "set.failing", "good", "toxic").agg(F.sum("set.n").alias("n"))


def interactions(sets: DataFrame) -> DataFrame:
    """What each step of each order keeps and removes, from ``failing_sets``."""
    orders = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    steps = (
        sets.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("letter", F.expr("substring(filter_order, step, 1)"))
        # Deleting the letters of a run of filters changes the set where one of them fails.
        .withColumn("earlier", F.expr("translate(failing, substring(filter_order, 1, step - 1), '') <> failing"))
    )
    fails = F.contains("failing", "letter")
    removed = fails & ~F.col("earlier")

    def documents(which: Column) -> Column:
        return F.sum(F.when(which, F.col("n")).otherwise(0))

    audited = steps.groupBy("part", "filter_order", "step", "letter").agg(
        documents(~F.col("earlier") & ~fails).alias("kept"),
        documents(removed).alias("removed"),
        documents(fails & F.col("earlier")).alias("redundant"),
        documents(F.col("failing") == F.col("letter")).alias("unique_fails"),
        documents(removed & F.col("good")).alias("good_lost"),
        documents(removed & F.col("toxic")).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return audited.withColumn("shapley", shapley).drop("letter")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step."""
    return interactions(failing_sets(settle(text_counts(docs)), labels))
