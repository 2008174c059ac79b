"""Exact top-k inner products by block-at-a-time pruning.

Vectors stay where they are read. A task sorts its vectors by id and cuts them into range blocks;
a block has a forward index (its vectors as rows of a matrix) and the largest and least value of
each term. For every query the summed term maxima bound what a block can score, so the blocks are
taken in falling order of that bound and a query leaves once the bound is below its k-th score.
Queries come in blocks of bounded size, one Spark job for each; every job merges the tasks' rows to
k per query and writes them to the shared folder.

Defined cases: vectors that are null or hold a null, NaN or infinite component take no part, as rows
without an id; vectors of other widths score over the places they share; equal scores go to the
smaller id; repeated ids are candidates each, but no row of the query's own id is; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.frames import top_rows
from tallyspark.llm.store import empty
from tallyspark.session import shared_folder

# Components of query vectors in one job.
QUERY_VALUES = 1 << 20
# Vectors of a block.
BLOCK = 128

TOP = "query_id long, vec_id long, score long"
RANKED = "query_id long, rank int, vec_id long, score long"


def quantize(vectors: DataFrame, scale: int = 64, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """``vec_id`` and ``floor(scale * x)`` of each usable vector as an array of longs."""
    usable = F.col(vector).isNotNull() & F.col(id_column).isNotNull()
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.filter(usable & finite).select(F.col(id_column).cast("long").alias("vec_id"), whole.alias("terms"))


def _matrix(rows: list[np.ndarray], width: int | None = None) -> np.ndarray:
    width = max((len(r) for r in rows), default=0) if width is None else width
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : min(len(row), width)] = row[:width]
    return out


def _product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products: floating point where it is exact, else integers."""
    size = max(1, left.shape[1]) * int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0))
    if size < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
    return left @ right


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """The k best of ``vectors`` (sorted by id) for each query: rows, ids and scores, best first."""
    n, least = len(query_ids), np.iinfo(np.int64).min
    starts = np.arange(0, len(ids), BLOCK)
    highest, lowest = np.maximum.reduceat(vectors, starts), np.minimum.reduceat(vectors, starts)
    bounds = _product(np.maximum(queries, 0), highest.T) + _product(np.minimum(queries, 0), lowest.T)
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = np.full(n, least)
    top_row = top_id = top_score = np.zeros(0, dtype=np.int64)
    live = np.arange(n)
    for step in range(len(starts)):
        block_of = order[live, step]
        open_ = bounds[live, block_of] >= kth[live]  # an equal score may win by its id
        live, block_of = live[open_], block_of[open_]
        if not len(live):
            break
        rows, found, scores = [top_row], [top_id], [top_score]
        for block in np.unique(block_of):
            mine = live[block_of == block]
            a, b = starts[block], min(starts[block] + BLOCK, len(ids))
            score = _product(queries[mine], vectors[a:b].T)
            at, column = np.nonzero((score >= kth[mine, None]) & (ids[a:b][None, :] != query_ids[mine, None]))
            rows.append(mine[at])
            found.append(ids[a:b][column])
            scores.append(score[at, column])
        row, id_, score = np.concatenate(rows), np.concatenate(found), np.concatenate(scores)
        sort = np.lexsort((id_, -score, row))
        row, id_, score = row[sort], id_[sort], score[sort]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < k
        top_row, top_id, top_score = row[keep], id_[keep], score[keep]
        last = np.arange(len(top_row)) - np.searchsorted(top_row, top_row) == k - 1
        kth[top_row[last]] = top_score[last]
    return top_row, top_id, top_score


def _query_blocks(queries: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of the queries, ``QUERY_VALUES`` components at a time."""
    ids, rows, held = [], [], 0
    for row in queries.toLocalIterator():
        ids.append(row["vec_id"])
        rows.append(np.array(row["terms"], dtype=np.int64))
        held += max(1, len(rows[-1]))
        if held >= QUERY_VALUES:
            yield np.array(ids), _matrix(rows)
            ids, rows, held = [], [], 0
    if ids:
        yield np.array(ids), _matrix(rows)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of each query (both quantized)."""
    spark: SparkSession = candidates.sparkSession
    folder, written = shared_folder(spark), []
    ranged = candidates.sortWithinPartitions("vec_id")
    for number, (query_ids, matrix) in enumerate(_query_blocks(queries)):
        shared = spark.sparkContext.broadcast((query_ids, matrix))

        def run(batches, shared=shared):
            query_ids, queries = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                column = batch.column("terms")
                stops = column.offsets.to_numpy()
                values = column.values.to_numpy()
                vectors = _matrix([values[a:b] for a, b in zip(stops[:-1], stops[1:])], queries.shape[1])
                row, ids, score = search(query_ids, queries, batch.column("vec_id").to_numpy(), vectors, k)
                columns = [pa.array(query_ids[row]), pa.array(ids), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

        rows = ranged.mapInArrow(run, TOP)
        best = top_rows(rows, ["query_id"], [F.col("score").desc(), F.col("vec_id")], k, "rank")
        written.append(f"{folder}/{number}")
        best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score").write.parquet(written[-1])
        shared.unpersist()
    return spark.read.schema(RANKED).parquet(*written) if written else empty(spark, RANKED)
