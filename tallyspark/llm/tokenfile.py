"""Token files: ids in ascending document order, Simple-8b coded in blocks, written and read by Spark.

A file's rows are blocks: the document ids and lengths of a block, its words, and the word offset of
each lane. Documents are dealt by ranges of their id; files follow the ranges, blocks the order inside.
A block knows how many ids of its range precede it; the ranges' totals, one row for each range, give
the rest. A file can thus be read from any block on, and many blocks side by side.

Defined cases: a null or empty text has the end id alone; null ids come first; repeated ids stand
together in any order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm import simple8b
from tallyspark.llm.text import as_bytes, in_blocks, texts
from tallyspark.llm.wordcache import encoder

BLOCKS = "part int, block int, before long, total long, doc_ids array<long>, lengths array<int>, words binary, lanes binary"
TOKENS = "doc_id long, start long, ids binary"
# Bytes of text behind one block.
BLOCK_TEXT = 1 << 20


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1) -> None:
    """Encode every text, append ``end_id`` and write the token files below ``path``."""

    def run(batches):
        part, encode = TaskContext.get().partitionId(), encoder(tokenizer).encode_block
        before = 0
        for block, batch in enumerate(in_blocks(batches, BLOCK_TEXT)):
            ids, lengths = encode(as_bytes(batch.column("text")))
            words, lanes = simple8b.encode(np.insert(ids, np.cumsum(lengths), end_id))
            lengths = (lengths + 1).tolist()
            total = sum(lengths)
            columns = [
                pa.array([part], pa.int32()),
                pa.array([block], pa.int32()),
                pa.array([before], pa.int64()),
                pa.array([total], pa.int64()),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int32())),
                pa.array([words.astype("<u8").tobytes()], pa.binary()),
                pa.array([lanes.astype("<u4").tobytes()], pa.binary()),
            ]
            before += total
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in BLOCKS.split(", ")])

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids of all documents before it), ``ids`` (little-endian unsigned 32-bit)."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # One row for each range: as many as partitions wrote, whatever the data.
    ranges = blocks.groupBy("part").agg(F.sum("total").alias("_total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.select("part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("base"))
    placed = blocks.join(F.broadcast(bases), "part").select(
        (F.col("base") + F.col("before")).alias("first"), "total", "doc_ids", "lengths", "words", "lanes"
    )

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words = np.frombuffer(row["words"], dtype="<u8")
                lanes = np.frombuffer(row["lanes"], dtype="<u4").astype(np.int64)
                ids = simple8b.decode(words, lanes, row["total"]).astype("<u4").tobytes()
                stops = np.cumsum(row["lengths"]).tolist()
                begins = [0, *stops[:-1]]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array([row["first"] + b for b in begins], pa.int64()),
                    pa.array([ids[4 * a : 4 * b] for a, b in zip(begins, stops)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "ids"])

    return placed.mapInArrow(run, TOKENS)
