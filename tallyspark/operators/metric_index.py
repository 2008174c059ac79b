"""A stored metric index over document vectors, and exact searches that measure only near documents.

``build_index`` picks pivots from a bounded sample of the documents, deals every document to the cell of its
nearest pivot and stores it with its distance to it. ``MetricIndex.search`` works in two rounds: each question is
measured against the cells around it until they hold k documents; the k-th distance found then rules out cells by
the triangle inequality (and by the plane between two pivots), and inside the others documents by their distance to
the pivot and by their first ``LEADING`` coordinates: along the directions in which the documents vary most, with
what is left taken by its length alone. Results equal those of ``vectors.knn_topk``: the same distances, ties to the smaller document id.

Sizes: pivots and their cells' bounds are all that travels to every task, at most ``MAX_CELLS`` of them and at most
``PIVOT_BYTES`` as a sample. A cell is dealt into parts of about ``PART_ROWS`` documents and its questions into blocks
of about ``BLOCK_ROWS``, both from counts, so no task holds a whole cell and no question goes to a cell that its bound
rules out.

``metric`` belongs to the index: l2 (squared), ip or cosine. Cosine cells are made of the vectors' directions; a vector
without direction has distance 1 to everything and stands in a cell of its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.frames import top_rows
from tallyspark.operators.vectors import _estimates, _exact, _matrix, _squares, checked_vectors
from tallyspark.session import drop_folder, shared_folder, shuffles_go
from tallyspark.sources.files import scan_first, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Documents that a cell should hold, as long as that takes no more than MAX_CELLS cells.
CELL_ROWS = 1024
MAX_CELLS = 4096
# Sampled documents per pivot, and what the sample may weigh at most.
SAMPLED = 8
PIVOT_BYTES = 32 << 20
REFINEMENTS = 6
# Documents that a task holds at once, and questions that meet them there.
PART_ROWS = 4096
BLOCK_ROWS = 4096
# Distances to pivots that are held at once: what a core's cache holds, whatever the batch and the pivots.
NEAR_VALUES = 1 << 18
# Pivots near a question whose planes are tried against every cell.
PLANES = 8
# Directions in which the documents vary most that are compared before whole vectors are, half the width at most.
LEADING = 24
# The cell of documents without direction.
NOWHERE = -1

STORED = "cell int, radius double, length double, document_id string, vector array<double>"
CELLS = (
    "cell int, pivot array<double>, documents long, least double, greatest double, parts int, metric string, longest double"
)
# The middle of the documents, then their leading directions.
DIRECTIONS = "place int, direction array<double>"
FOUND = "query_id string, document_id string, distance double, measured long"
FOUND_ARROW = pa.schema(
    [
        ("query_id", pa.string()),
        ("document_id", pa.string()),
        ("distance", pa.float64()),
        ("measured", pa.int64()),
    ]
)


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(_squares(rows))


def _points(rows: np.ndarray, metric: str) -> np.ndarray:
    """The vectors as they lie in the cells: their directions for cosine."""
    if metric != "cosine":
        return rows
    size = _lengths(rows)
    return rows / np.where(size > 0, size, 1.0)[:, None]


def _to_pivots(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances to every pivot by one matrix product, and how far each may be off."""
    a, b = _squares(points)[:, None], _squares(pivots)[None, :]
    off = 8 * (points.shape[1] + 4) * np.finfo(np.float64).eps * (a + b)
    return np.maximum(a + b - 2.0 * (points @ pivots.T), 0.0), off


def _nearest_pivot(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Which pivot is nearest to each point, a block of points at a time."""
    half, turned = _squares(pivots) / 2, np.ascontiguousarray(pivots.T)
    step = max(1, NEAR_VALUES // len(pivots))
    near = np.empty(len(points), dtype=np.int64)
    for at in range(0, len(points), step):
        inner = points[at : at + step] @ turned
        near[at : at + step] = np.subtract(half, inner, out=inner).argmin(axis=1)
    return near


def choose_pivots(sample: np.ndarray, cells: int) -> np.ndarray:
    """Up to ``cells`` different pivots: sampled points, moved to the middle of those nearest to them."""
    sample = np.unique(sample, axis=0)
    if len(sample) <= cells:
        return sample
    # np.unique sorts, so take them evenly from a fixed shuffle.
    sample = sample[np.random.default_rng(7).permutation(len(sample))]
    pivots = sample[:cells].copy()
    for _ in range(REFINEMENTS):
        near = _nearest_pivot(sample, pivots)
        sums = np.zeros_like(pivots)
        np.add.at(sums, near, sample)
        count = np.bincount(near, minlength=cells)
        pivots[count > 0] = sums[count > 0] / count[count > 0, None]
    return np.unique(pivots, axis=0)


def _sample(documents: DataFrame, cells: int, metric: str) -> np.ndarray:
    """Points of the documents with the least hash of their id, at most ``PIVOT_BYTES`` of them."""
    width = documents.select(F.size("vector")).first()[0]
    rows = min(cells * SAMPLED, max(1, PIVOT_BYTES // (8 * max(1, width))))
    found = documents.orderBy(F.xxhash64("id"), "id").limit(rows).select("id", "vector").toArrow()
    names = found.column("id").to_pylist()
    points = _points(_matrix(found.column("vector").combine_chunks(), names, None, "document"), metric)
    return points[_squares(points) > 0] if metric == "cosine" else points


def leading_directions(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The middle of the points and the directions, as rows, in which they vary most."""
    width = points.shape[1]
    middle = points.mean(axis=0)
    _, directions = np.linalg.eigh((points - middle).T @ (points - middle))
    return middle, np.ascontiguousarray(directions[:, ::-1][:, : min(LEADING, width // 2)].T)


def assign(documents: DataFrame, pivots: np.ndarray, metric: str) -> DataFrame:
    """Each document with the cell of its nearest pivot, its distance to it and its vector's length."""
    shared = documents.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            names = batch.column("id").to_pylist()
            if not names:
                continue
            rows = _matrix(batch.column("vector"), names, pivots.shape[1] if len(pivots) else None, "document")
            points = _points(rows, metric)
            cell, radius = np.full(len(names), NOWHERE), np.zeros(len(names))
            placed = np.flatnonzero(_squares(points) > 0 if metric == "cosine" else np.ones(len(names), dtype=bool))
            if len(placed):
                cell[placed] = _nearest_pivot(points[placed], pivots)
                radius[placed] = _lengths(points[placed] - pivots[cell[placed]])
            columns = [pa.array(cell.astype(np.int32)), pa.array(radius), pa.array(_lengths(rows))]
            columns += [batch.column("id"), batch.column("vector")]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "radius", "length", "document_id", "vector"])

    return documents.select("id", "vector").mapInArrow(run, STORED)


def build_index(
    documents: DataFrame, path: str, metric: str = "l2", cell_rows: int = CELL_ROWS, part_rows: int = PART_ROWS
) -> "MetricIndex":
    """Store an index of (document_id, vector) below ``path``: its documents by cell, and its cells."""
    spark = documents.sparkSession
    usable = checked_vectors(documents, "document_id")
    rows = usable.count()
    pivots, directions = np.empty((0, 0)), []
    if rows:
        cells = max(1, min(MAX_CELLS, -(-rows // cell_rows)))
        sample = _sample(usable, cells, metric)
        pivots = choose_pivots(sample, cells)
        if len(sample):
            middle, leading = leading_directions(sample)
            directions = [(at, row.tolist()) for at, row in enumerate([middle, *leading])]
    if metric == "cosine" and rows and not len(pivots):  # the sample has no direction
        width = usable.select(F.size("vector")).first()[0]
        pivots = np.eye(1, width)
    # A cell goes to one task, and so to one file, unless its share of the shuffle is large: then AQE splits it.
    dealt = assign(usable, pivots, metric).hint("rebalance", F.col("cell"))
    with shuffles_go(spark):
        dealt.write.mode("overwrite").partitionBy("cell").option("compression", "zstd").parquet(f"{path}/documents")
    dealt = _stored_documents(spark, path)
    found = dealt.groupBy("cell").agg(
        F.count(F.lit(1)).alias("documents"),
        F.min("radius").alias("least"),
        F.max("radius").alias("greatest"),
        F.max("length").alias("longest"),
    )
    # At most MAX_CELLS rows and the one of documents without direction.
    described = []
    for row in found.collect():
        pivot = pivots[row["cell"]].tolist() if row["cell"] != NOWHERE else [0.0] * pivots.shape[1]
        parts = -(-row["documents"] // part_rows)
        described.append(
            (row["cell"], pivot, row["documents"], row["least"], row["greatest"], parts, metric, row["longest"])
        )
    spark.createDataFrame(described, CELLS).coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/cells")
    spark.createDataFrame(directions, DIRECTIONS).coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/directions")
    return open_index(spark, path)


def _stored_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(f"{path}/documents")


@dataclass
class Cells:
    """What every task knows of the cells, in one order."""

    cell: np.ndarray
    pivots: np.ndarray
    documents: np.ndarray
    least: np.ndarray
    greatest: np.ndarray
    longest: float
    metric: str
    middle: np.ndarray
    leading: np.ndarray

    def split(self, points: np.ndarray, centred: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates along the leading directions, from the middle, and the length of the rest."""
        points = points - self.middle if centred else points
        along = points @ self.leading.T
        return along, np.sqrt(np.maximum(_squares(points) - _squares(along), 0.0))

    def bounds(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance to each pivot, and a distance that no document of the cell lies below."""
        points = _points(vectors, self.metric)
        somewhere = self.cell != NOWHERE
        pivots = self.pivots[somewhere]
        square, off = _to_pivots(points, pivots)
        far = np.sqrt(square)
        # Room for the rounding of both distances.
        room = np.sqrt(off) + 1e-9 * (far + self.greatest[somewhere])
        if self.metric == "ip":
            size = _lengths(vectors)[:, None]
            inner = vectors @ pivots.T + size * (self.greatest[somewhere] + room)
            low = 1.0 - inner - off
        else:
            low = np.maximum(far - self.greatest[somewhere], self.least[somewhere] - far) - room
            low = np.maximum(low, self._planes(square, off, pivots))
            low = np.maximum(low, 0.0) ** 2
        if self.metric == "cosine":
            low = np.where(_squares(vectors)[:, None] > 0, low / 2 - 1e-9, 0.0)
        out, lower = np.ones((len(vectors), len(self.cell))), np.ones((len(vectors), len(self.cell)))
        out[:, somewhere], lower[:, somewhere] = far, low
        out[:, ~somewhere] = np.inf
        return out, lower

    def _planes(self, square: np.ndarray, off: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        """A document is nearer to its own pivot than to any other: how far the plane between them is."""
        best = np.full(square.shape, -np.inf)
        if len(pivots) < 2:
            return best
        between = np.sqrt(_to_pivots(pivots, pivots)[0])
        slack = 8 * (pivots.shape[1] + 4) * np.finfo(np.float64).eps
        slack *= self.longest**2 + _squares(pivots).max() if self.metric != "cosine" else 2.0
        rows = np.arange(len(square))
        for rank in range(min(PLANES, len(pivots))):
            other = np.argpartition(square, rank, axis=1)[:, rank]
            gap = square - square[rows, other][:, None] - 2 * off - 2 * slack
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = gap / (2 * between[other])
            best = np.maximum(best, np.where(between[other] > 0, plane * (1 - 1e-9), -np.inf))
        return best


@dataclass
class MetricIndex:
    """An index that lies below ``path``."""

    spark: SparkSession
    path: str
    table: DataFrame
    cells: Cells

    @property
    def metric(self) -> str:
        return self.cells.metric

    @property
    def rows(self) -> int:
        return int(self.cells.documents.sum())

    def _asked(self, questions: DataFrame, k: int, first: bool) -> DataFrame:
        """A row for each question and cell that it must see in this round.

        The first round takes the nearest cells until they hold k documents. The second takes those of the others
        whose bound is not above the question's ``limit``.
        """
        shared = self.spark.sparkContext.broadcast(self.cells)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    names = part.column("id").to_pylist()
                    vectors = _matrix(part.column("vector"), names, cells.pivots.shape[1], "query")
                    far, lower = cells.bounds(vectors)
                    order = np.argsort(far, axis=1, kind="stable")
                    before = np.cumsum(cells.documents[order], axis=1) - cells.documents[order]
                    near = np.zeros(far.shape, dtype=bool)
                    np.put_along_axis(near, order, before < k, axis=1)
                    limit = part.column("limit").to_numpy(zero_copy_only=False)
                    wanted = near if first else ~near & (lower <= limit[:, None])
                    row, column = np.nonzero(wanted)
                    columns = [
                        pa.array(cells.cell[column].astype(np.int32)),
                        part.column("id").take(pa.array(row)),
                        part.column("vector").take(pa.array(row)),
                        pa.array(limit[row]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["cell", "id", "vector", "limit"])

        return questions.select("id", "vector", "limit").mapInArrow(
            run, "cell int, id string, vector array<double>, limit double"
        )

    def _measure(self, asked: DataFrame, k: int) -> DataFrame:
        """The k nearest documents of each question in each part of the cells it is dealt to."""
        blocks = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
        # At most a row per cell.
        seen = F.broadcast(self.table.select("cell", "parts").join(blocks, "cell"))

        def one_of(column: str, count: str) -> Column:
            return F.pmod(F.xxhash64(column), F.col(count)).cast("int")

        def every(count: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

        held = (
            _stored_documents(self.spark, self.path)
            .join(seen, "cell")
            .select("cell", one_of("document_id", "parts").alias("part"), every("blocks").alias("block"),
                    F.lit(False).alias("asked"), F.col("document_id").alias("id"), "vector", F.col("radius").alias("at"))
        )
        met = (
            asked.join(seen, "cell")
            .select("cell", every("parts").alias("part"), one_of("id", "blocks").alias("block"),
                    F.lit(True).alias("asked"), "id", "vector", F.col("limit").alias("at"))
        )
        group = ["cell", "part", "block"]
        meeting = held.unionByName(met).repartition(*group).sortWithinPartitions(*group, "asked", "id")
        shared = self.spark.sparkContext.broadcast(self.cells)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = shared.value
            place = {int(c): i for i, c in enumerate(cells.cell)}
            key, documents = None, None
            for batch in batches:
                keys = np.stack([batch.column(name).to_numpy() for name in group])
                asked = batch.column("asked").to_numpy(zero_copy_only=False)
                change = np.any(keys[:, 1:] != keys[:, :-1], axis=0) | (asked[1:] != asked[:-1])
                edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
                for a, b in zip(edges[:-1], edges[1:]):
                    if a == b:
                        continue
                    part = batch.slice(a, b - a)
                    if key != tuple(keys[:, a]):
                        key, documents = tuple(keys[:, a]), _Part(cells, place.get(int(keys[0, a])))
                    if asked[a]:
                        yield from documents.search(part, k)
                    else:
                        documents.add(part)

        return meeting.mapInArrow(run, FOUND)

    def _rounds(self, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame, list[str]]:
        # The questions are looked at several times, so they are computed once.
        questions = stored(checked_vectors(queries, "query_id")).withColumn("limit", F.lit(float("inf")))
        first = shared_folder(self.spark)
        with shuffles_go(self.spark):
            self._measure(self._asked(questions, k, True), k).write.parquet(first)
        near = self.spark.read.schema(FOUND).parquet(first)
        best = top_rows(near, ["query_id"], [F.col("distance"), F.col("document_id")], k, "rank")
        bound = best.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("distance").alias("limit"))
        limit = F.coalesce("limit", F.lit(float("inf"))).alias("limit")
        limited = questions.drop("limit").join(bound, "id", "left").select("id", "vector", limit)
        return near, self._measure(self._asked(limited, k, False), k), [first]

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """The k nearest documents of every (query_id, vector): query_id, document_id, distance, rank.

        Runs the first round; the result is the plan of the second.
        """
        if not self.rows:
            return self.spark.createDataFrame([], "query_id string, document_id string, distance double, rank int")
        near, rest, _ = self._rounds(queries, k)
        found = near.unionByName(rest).drop("measured")
        return top_rows(found, ["query_id"], [F.col("distance"), F.col("document_id")], k, "rank")

    def measured(self, queries: DataFrame, k: int) -> int:
        """How many pairs a search of these queries measures."""
        near, rest, written = self._rounds(queries, k)
        pairs = near.unionByName(rest).agg(F.coalesce(F.sum("measured"), F.lit(0))).first()[0]
        for path in written:
            drop_folder(self.spark, path)
        return pairs


class _Part:
    """The documents of one part of a cell that a task holds, and the measuring of its questions."""

    def __init__(self, cells: Cells, at: int | None):
        self.cells, self.at = cells, at
        self.batches: list[tuple[list[str], np.ndarray, np.ndarray]] = []
        self.ids = None

    def add(self, part: pa.RecordBatch) -> None:
        names = part.column("id").to_pylist()
        rows = _matrix(part.column("vector"), names, self.cells.pivots.shape[1], "document")
        self.batches.append((names, rows, part.column("at").to_numpy(zero_copy_only=False)))

    def _settle(self) -> None:
        ids = np.array([name for names, _, _ in self.batches for name in names], dtype=object)
        rows = np.concatenate([rows for _, rows, _ in self.batches])
        radius = np.concatenate([radius for _, _, radius in self.batches])
        order = np.argsort(radius, kind="stable")
        self.ids, self.rows, self.radius = ids[order], rows[order], radius[order]
        self.squares = _squares(self.rows)
        self.along, self.rest = self.cells.split(_points(self.rows, self.cells.metric))
        self.spread = _squares(self.along) + self.rest**2

    def search(self, part: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
        if not self.batches:
            return
        if self.ids is None:
            self._settle()
        names = part.column("id").to_pylist()
        wanted = _matrix(part.column("vector"), names, self.rows.shape[1], "query")
        limit = part.column("at").to_numpy(zero_copy_only=False)
        begin, end = self._ring(wanted, limit)
        found = []
        for i in np.flatnonzero(end > begin).tolist():
            near = np.arange(int(begin[i]), int(end[i]))
            near = near[self._may_be_within(wanted[i], near, limit[i])]
            if not len(near):
                continue
            place, distance = self._nearest(wanted[i], near, k)
            measured = np.zeros(len(place), dtype=np.int64)
            measured[0] = len(near)
            found.append(([names[i]] * len(place), self.ids[place].tolist(), distance, measured))
        if found:
            names, ids, distance, measured = zip(*found)
            columns = [pa.array([name for part in texts for name in part], pa.string()) for texts in (names, ids)]
            columns += [pa.array(np.concatenate(distance)), pa.array(np.concatenate(measured))]
            yield pa.RecordBatch.from_arrays(columns, schema=FOUND_ARROW)

    def _may_be_within(self, question: np.ndarray, near: np.ndarray, limit: float) -> np.ndarray:
        """Which documents their leading coordinates don't put beyond the limit."""
        metric, point = self.cells.metric, _points(question[None, :], self.cells.metric)
        if not np.isfinite(limit) or not len(self.cells.leading) or (metric == "cosine" and not point.any()):
            return np.ones(len(near), dtype=bool)
        along, rest = self.cells.split(point, metric != "ip")
        room = 1e-6 * (self.spread[near] + _squares(along)[0] + rest[0] ** 2)
        if metric == "ip":
            inner = question @ self.cells.middle + self.along[near] @ along[0] + self.rest[near] * rest[0]
            return 1.0 - inner <= limit + room + 1e-9 * np.abs(inner)
        low = _squares(self.along[near] - along) + (self.rest[near] - rest[0]) ** 2 - room
        if metric == "cosine":  # a document without direction is 1 from everything
            return (low <= 2.0 * limit) | (self.squares[near] == 0)
        return low <= limit

    def _nearest(self, question: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest of some of the documents: which, and their distances, ties by id."""
        metric = self.cells.metric
        if len(near) > k:
            estimate, off = (out[0] for out in _estimates(question[None, :], self.rows[near], metric, self.squares[near]))
            near = near[estimate - off <= np.partition(estimate + off, k - 1)[k - 1]]
        distance = _exact(np.broadcast_to(question, (len(near), len(question))), self.rows[near], metric)
        first = np.lexsort((self.ids[near], distance))[:k]
        return near[first], distance[first]

    def _ring(self, wanted: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which run of the documents, ordered by their distance to the pivot, may lie within each limit."""
        everything = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(self.ids))
        if self.at is None or self.cells.cell[self.at] == NOWHERE:
            return everything
        metric, points = self.cells.metric, _points(wanted, self.cells.metric)
        square, off = _to_pivots(points, self.cells.pivots[self.at][None, :])
        far = np.sqrt(square[:, 0])
        if metric == "ip":
            # 1 - (q.p + |q| r) <= limit asks for r >= (1 - limit - q.p) / |q|.
            size = _lengths(wanted)
            with np.errstate(divide="ignore", invalid="ignore"):
                least = (1.0 - limit - wanted @ self.cells.pivots[self.at] - off[:, 0]) / size
            least = np.where(size > 0, least, 0.0)
            least = np.where(np.isfinite(least), least - 1e-9 * (1 + np.abs(least)) - np.sqrt(off[:, 0]), 0.0)
            return np.searchsorted(self.radius, least, side="left"), everything[1]
        within = np.sqrt(np.maximum(limit * (2.0 if metric == "cosine" else 1.0), 0.0))
        within = within + np.sqrt(off[:, 0]) + 1e-9 * (1 + far + np.where(np.isfinite(within), within, 0.0))
        if metric == "cosine":
            within = np.where(_squares(wanted) > 0, np.sqrt(within**2 + 2e-9), np.inf)
        begin = np.searchsorted(self.radius, far - within, side="left")
        return begin, np.searchsorted(self.radius, far + within, side="right")


def open_index(spark: SparkSession, path: str) -> MetricIndex:
    """The index stored below ``path``; FileNotFoundError where there is none."""
    table = scan_first(spark, [f"{path}/cells"])
    rows = sorted(table.collect(), key=lambda row: row["cell"])
    width = len(rows[0]["pivot"]) if rows else 0
    found = sorted(spark.read.schema(DIRECTIONS).parquet(f"{path}/directions").collect())
    directions = [row["direction"] for row in found]
    cells = Cells(
        cell=np.array([row["cell"] for row in rows], dtype=np.int64),
        pivots=np.array([row["pivot"] for row in rows], dtype=np.float64).reshape(len(rows), width),
        documents=np.array([row["documents"] for row in rows], dtype=np.int64),
        least=np.array([row["least"] for row in rows]),
        greatest=np.array([row["greatest"] for row in rows]),
        longest=max((row["longest"] for row in rows), default=0.0),
        metric=rows[0]["metric"] if rows else "l2",
        middle=np.array(directions[0] if directions else np.zeros(width)),
        leading=np.array(directions[1:], dtype=np.float64).reshape(max(0, len(directions) - 1), width),
    )
    return MetricIndex(spark, path, table, cells)
