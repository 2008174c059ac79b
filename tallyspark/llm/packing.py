"""Packing of tokenised documents into sequences: shortest pack first over the length histogram.

1. Each document's ids (end id last) are cut into pieces: as many of the full capacity as fit, then
   the rest. A task numbers the pieces of one length that it makes, so no group of equal lengths
   ever meets in one task.
2. The histogram (at most ``capacity`` rows) goes to the driver, which places lengths longest first:
   each joins the pattern with the most room left, and pattern counts are updated in whole blocks.
3. A pattern with count c owns c consecutive sequences, and of each of its lengths c consecutive
   ranks. A piece's rank is the number of such pieces in earlier tasks plus its own number, so a
   sorted lookup gives its sequence and offset.

Defined cases: a null or empty text is its end id alone; a null id is kept as null; repeated rows
are packed each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.store import settle
from tallyspark.llm.text import as_bytes, in_blocks, texts
from tallyspark.llm.wordcache import encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, _part int, _number long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of every document, numbered within their length and task."""

    def run(batches):
        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer).encode_block
        made = np.zeros(capacity + 1, dtype=np.int64)
        for batch in in_blocks(batches):
            rows = []
            ids, lengths = encode(as_bytes(batch.column("text")))
            block = memoryview(np.insert(ids, np.cumsum(lengths), end_id).astype("<u4")).cast("B")
            stops = np.cumsum(lengths + 1).tolist()
            for doc_id, first, stop in zip(batch.column("doc_id").to_pylist(), [0, *stops[:-1]], stops):
                total = stop - first
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    piece = block[4 * (first + start) : 4 * (first + start + length)]
                    rows.append((doc_id, start, length, zlib.crc32(piece), total, part, int(made[length])))
                    made[length] += 1
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
            names = [part_.split()[0] for part_ in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return texts(docs).mapInArrow(run, PIECES)


def plan_packs(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(count, lengths) of each pattern; lengths longest first, counts as the histogram asks."""
    by_room: dict[int, list[tuple[int, tuple]]] = {}
    rooms = np.zeros(capacity + 1, dtype=bool)

    def put(room: int, count: int, pattern: tuple) -> None:
        by_room.setdefault(room, []).append((count, pattern))
        rooms[room] = True

    for length in sorted(histogram, reverse=True):
        left, made = histogram[length], []
        while left:
            open_ = np.flatnonzero(rooms[length:])
            if not len(open_):
                made.append((capacity - length, left, (length, None)))
                break
            room = length + int(open_[-1])  # the shortest pack has the most room
            count, pattern = by_room[room].pop()
            taken = min(count, left)
            if taken < count:
                by_room[room].append((count - taken, pattern))
            elif not by_room[room]:
                rooms[room] = False
            made.append((room - length, taken, (length, pattern)))
            left -= taken
            if 2 * length <= room:  # more of this length may join the packs just made
                put(*made.pop())
        for entry in made:
            put(*entry)
    plans = []
    for room in sorted(by_room):
        for count, pattern in by_room[room]:
            lengths = []
            while pattern:
                lengths.append(pattern[0])
                pattern = pattern[1]
            plans.append((count, lengths[::-1]))
    return plans


def _slots(plans: list[tuple[int, list[int]]]) -> tuple[np.ndarray, ...]:
    """Sorted by (length, first rank): length, first rank, first sequence, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for count, lengths in plans:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, offset))
            used[length] = rank + count
            offset += length
        sequence += count
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return tuple(table.T)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Give each piece (``length, _part, _number`` and more) its sequence and offset."""
    counts = pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_count"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_count").alias("n")).collect()}
    slots = _slots(plan_packs(histogram, capacity))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", "length", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_base"))
    ranked = pieces.join(bases, ["_part", "length"]).withColumn("_rank", F.col("_base") + F.col("_number"))
    names = [column.split()[0] for column in PACKED.split(", ")]

    def run(batches):
        lengths, ranks, sequences, offsets = slots
        first = np.searchsorted(lengths, np.arange(capacity + 2))
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            at = np.empty(len(length), dtype=np.int64)
            for value in np.unique(length):
                rows = np.flatnonzero(length == value)
                a, b = first[value], first[value + 1]
                at[rows] = a + np.searchsorted(ranks[a:b], rank[rows], side="right") - 1
            placed = {"sequence_id": sequences[at] + rank - ranks[at], "offset": offsets[at]}
            columns = [pa.array(placed[n]) if n in placed else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return ranked.mapInArrow(run, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048) -> DataFrame:
    """Every piece of every document with its place."""
    return pack(settle(token_pieces(docs, tokenizer, end_id, capacity)), capacity)
