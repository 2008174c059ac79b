"""Document vectors and nearest-document search for a table of queries."""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.frames import top_rows

# The search functions travel to the executors by value, so the package need not
# be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 64
TOKENS = re.compile(rb"[a-z0-9]+(?:[.-][a-z0-9]+)*")
# Bytes that a token may hold stay, all others become blanks.
IN_TOKENS = bytes(at if chr(at) in "abcdefghijklmnopqrstuvwxyz0123456789.-" else 32 for at in range(256))
# Pieces of text whose places a task keeps.
KNOWN = 1 << 17

# Documents of one group of a search without an index. A task holds the vectors of one
# group while the questions pass.
CELL_ROWS = 16_384
# Distances held at once: question rows times document rows.
DISTANCES = 2_000_000

FOUND_SCHEMA = "query_id string, document_id string, distance double"
FOUND_ARROW = pa.schema(
    [("query_id", pa.string()), ("document_id", pa.string()), ("distance", pa.float64())]
)
# The k nearest documents of (query_id, vector): query_id, document_id, distance, rank.
Search = Callable[[DataFrame, int], DataFrame]

METADATA = ("document_type", "account_id", "security_id", "position_date", "event_date", "title")


class _Places(dict):
    """The places of the tokens in a piece of text, worked out once; emptied when it holds ``KNOWN`` pieces."""

    def __init__(self, dimensions: int):
        super().__init__()
        self.dimensions = dimensions

    def __missing__(self, piece: bytes) -> list[int]:
        if len(self) >= KNOWN:
            self.clear()
        digests = [hashlib.md5(token).digest() for token in TOKENS.findall(piece)]
        places = self[piece] = [int.from_bytes(digest[:4]) % self.dimensions for digest in digests]
        return places


def _counted(texts: pa.Array, known: _Places) -> pa.Array:
    """The tokens of each text counted by place, a batch at once.

    A token holds no other bytes than ``IN_TOKENS``, so a text is cut at all others first.
    """
    found = [
        [place for piece in text.encode().translate(IN_TOKENS).split() for place in known[piece]]
        for text in texts.to_pylist()
    ]
    row = np.repeat(np.arange(len(found)), [len(places) for places in found])
    place = np.array([place for places in found for place in places], dtype=np.int64)
    counts = np.bincount(row * known.dimensions + place, minlength=len(found) * known.dimensions)
    starts = np.arange(len(found) + 1, dtype=np.int32) * np.int32(known.dimensions)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(counts.astype(np.float32)))


def term_vector(text: str, dimensions: int = DIMENSIONS) -> F.Column:
    """Token counts hashed into a fixed number of places, not normalized.

    Stands in for a sentence-embedding model: it finds documents with the same
    words, not the same meaning. The place of a token is the first 32 bits of its
    MD5, modulo the dimensions.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Places(dimensions)
        for texts in batches:
            yield _counted(texts, known)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}  # Spark reads them as types
    return F.arrow_udf(run, "array<float>")(F.lower(F.coalesce(F.col(text), F.lit(""))))


def vector_metadata(corpus: DataFrame) -> DataFrame:
    """Flat text metadata beside each document: missing becomes empty, the source
    list becomes JSON text."""
    return corpus.select(
        "document_id",
        F.col("text"),
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in METADATA],
        F.coalesce(F.to_json("source_tables"), F.lit("")).alias("source_tables"),
    )


def parsed_source_tables(column: str) -> F.Column:
    """Source list from its JSON text; text that is no JSON list is a list of itself."""
    text = F.col(column)
    empty = F.array().cast("array<string>")
    return F.when(text == "", empty).otherwise(
        F.coalesce(F.from_json(text, "array<string>"), F.array(text))
    )


def vector_table(corpus: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """One row per document: id, text, metadata and vector.

    ``vectors`` (document_id, vector) come from an outside model; without them
    the hashed term vector is used. Of documents with one id the first by text
    stays.
    """
    fields = ("text", *METADATA, "source_tables")
    described = (
        vector_metadata(corpus)
        .groupBy("document_id")
        .agg(F.min(F.struct(*fields)).alias("_document"))
        .select("document_id", "_document.*")
    )
    if vectors is not None:
        return described.join(vectors.select("document_id", "vector"), "document_id")
    return described.withColumn("vector", term_vector("text"))


def query_vectors(queries: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """Vectors of the questions: those given as (query_id, vector), else hashed terms."""
    if vectors is not None:
        return vectors.select("query_id", "vector").join(queries.select("query_id"), "query_id", "left_semi")
    return queries.select("query_id", term_vector("query").alias("vector"))


def _matrix(column: pa.ListArray, ids: list[str], width: int | None, what: str) -> np.ndarray:
    """The vectors as rows; one of another width is an error that names it."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    width = int(sizes[0]) if width is None else width
    other = np.flatnonzero(sizes != width)
    if len(other):
        at = int(other[0])
        raise ValueError(f"{what} {ids[at]!r} has {int(sizes[at])} values, not {width}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), width)


def _squares(rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", rows, rows)


def _estimates(
    queries: np.ndarray, documents: np.ndarray, metric: str, squares: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Distances by one matrix product, and how far each may be off."""
    inner = queries @ documents.T
    q, d = _squares(queries)[:, None], (_squares(documents) if squares is None else squares)[None, :]
    unit = 8 * (queries.shape[1] + 4) * np.finfo(np.float64).eps
    if metric == "l2":
        return q + d - 2.0 * inner, unit * (q + d)
    size = np.sqrt(q) * np.sqrt(d)
    if metric == "ip":
        return 1.0 - inner, unit * (size + 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(size > 0, 1.0 - inner / size, 1.0), np.full_like(inner, 2 * unit)


def _exact(queries: np.ndarray, documents: np.ndarray, metric: str) -> np.ndarray:
    """Distances row by row, the same whatever stands beside them."""
    if metric == "l2":
        return _squares(queries - documents)
    inner = np.einsum("ij,ij->i", queries, documents)
    if metric == "ip":
        return 1.0 - inner
    size = np.sqrt(_squares(queries)) * np.sqrt(_squares(documents))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(size > 0, 1.0 - inner / size, 1.0)


def _nearest(
    queries: np.ndarray, ids: np.ndarray, documents: np.ndarray, k: int, metric: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest documents of each query: query rows, document rows, distances.

    The estimate only picks who may be among the k nearest, with room for its
    error; those are measured directly and ordered by distance and id.
    """
    by_id = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), dtype=np.int64)
    place[by_id] = np.arange(len(ids))
    parts = []
    step = max(1, DISTANCES // max(1, len(ids)))
    for start in range(0, len(queries), step):
        block = queries[start : start + step]
        estimate, off = _estimates(block, documents, metric)
        if len(ids) > k:
            limit = np.partition(estimate + off, k - 1, axis=1)[:, k - 1 : k]
            row, column = np.nonzero(estimate - off <= limit)
        else:
            row, column = (part.ravel() for part in np.indices(estimate.shape))
        distance = _exact(block[row], documents[column], metric)
        order = np.lexsort((place[column], distance, row))
        row, column, distance = row[order], column[order], distance[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < k
        parts.append((row[first] + start, column[first], distance[first]))
    return tuple(np.concatenate(part) for part in zip(*parts))


def checked_vectors(df: DataFrame, name: str) -> DataFrame:
    """``id`` and ``vector`` of the rows that have both; a null or non-finite value is an error that names the row."""
    # NaN is the greatest value; the bounds are one compiled pass each, a lambda over every value is not.
    within = (F.array_min("vector") > float("-inf")) & (F.array_max("vector") < float("inf"))
    whole = (F.size("vector") == 0) | (~F.exists("vector", lambda x: x.isNull()) & within)
    message = F.concat(F.lit(f"{name} "), F.col("id"), F.lit(" has a null or non-finite value"))
    checked = F.when(whole, F.col("vector")).otherwise(F.raise_error(message).cast("array<double>"))
    named = df.select(F.col(name).cast("string").alias("id"), F.col("vector").cast("array<double>"))
    return named.filter("vector is not null and id is not null").select("id", checked.alias("vector"))


def knn_topk(
    queries: DataFrame,
    documents: DataFrame,
    k: int,
    metric: str = "l2",
    cells: int | None = None,
) -> DataFrame:
    """The k nearest documents of every query: (query_id, document_id, distance, rank).

    Exact search of a table without an index, one lazy plan; a table that is searched
    often is better stored as a ``metric_index``, which gives the same rows. ``metric``
    is l2 (squared), ip or cosine. Tables are (query_id, vector) and (document_id,
    vector). Documents are dealt once into ``cells`` groups by id, by default as many
    as their count asks for; every group sees all queries, and what leaves it is k
    rows per query. The result does not depend on ``cells``. Equal distances go
    to the smaller document id. Rows without an id or a vector take no part; a
    vector without direction (all zero) has cosine distance 1 to everything; a
    vector of another width than the rest of its group, or with a null or
    non-finite value, is an error that names it.
    """

    def side(df: DataFrame, name: str, cell: F.Column, asked: bool) -> DataFrame:
        return checked_vectors(df, name).select(cell.alias("cell"), F.lit(asked).alias("asked"), "id", "vector")

    if cells is None:
        groups = documents.agg(F.greatest(F.ceil(F.count(F.lit(1)) / CELL_ROWS), F.lit(1)).cast("int")).scalar()
    else:
        groups = F.lit(cells)
    stored = side(documents, "document_id", F.pmod(F.xxhash64("id"), groups).cast("int"), False)
    every = F.explode(F.sequence(F.lit(0), groups - 1))
    asked = side(queries, "query_id", every, True)
    # A group's documents come first, then its queries in batches.
    meeting = stored.unionByName(asked).repartition("cell").sortWithinPartitions("cell", "asked", "id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, vectors, cell = [], np.empty(0, dtype=object), np.empty((0, 0)), None
        for batch in batches:
            keys = 2 * batch.column("cell").to_numpy() + batch.column("asked").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if keys[a] // 2 != cell:
                    cell, held, ids = keys[a] // 2, [], None
                names = part.column("id").to_pylist()
                if not keys[a] % 2:
                    width = held[0][1].shape[1] if held else None
                    held.append((names, _matrix(part.column("vector"), names, width, "document")))
                    continue
                if not held:
                    continue
                if ids is None:
                    ids = np.array([name for names_, _ in held for name in names_], dtype=object)
                    vectors = np.concatenate([rows for _, rows in held])
                wanted = _matrix(part.column("vector"), names, vectors.shape[1], "query")
                row, column, distance = _nearest(wanted, ids, vectors, k, metric)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[at] for at in row.tolist()], pa.string()),
                        pa.array(ids[column].tolist(), pa.string()),
                        pa.array(distance),
                    ],
                    schema=FOUND_ARROW,
                )

    found = meeting.mapInArrow(search, FOUND_SCHEMA)
    return top_rows(found, ["query_id"], [F.col("distance"), F.col("document_id")], k, "rank")


def similarity_retriever(
    queries: DataFrame, vectors: DataFrame, k: int, asked: DataFrame | None = None, search: Search | None = None
) -> DataFrame:
    """The k nearest documents of every query text, with distance, text and metadata.

    ``asked`` (query_id, vector) are vectors of the queries from the model that
    made those of the documents. ``search`` is that of a stored index of ``vectors``;
    without it all documents are measured.
    """
    wanted = query_vectors(queries, asked)
    nearest = search(wanted, k) if search else knn_topk(wanted, vectors, k)
    return nearest.join(vectors.drop("vector"), "document_id").withColumn(
        "source_tables", parsed_source_tables("source_tables")
    )
