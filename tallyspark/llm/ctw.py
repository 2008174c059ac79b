"""Language-model scores by context-tree weighting over bytes, and the smoothed unigram base.

A byte is coded as eight binary decisions. The nodes of depth 1 to 3 tell the bytes before it by 32
classes (letters without case, blanks, digits, other signs, parts of wide characters); below them
stand the contexts of the last 4 to 7 bytes as they are, as many as the training texts hold. Counts
give every node its Krichevsky-Trofimov estimate; from the deepest contexts up, a node's weighted
probability is half its own estimate and half the product of its children's. The posterior weights
mix the estimates along a context's path, down to its deepest node that was seen in training, into
one distribution. Texts start after line feeds.

Texts are dealt into blocks once. The distinct cells (seven bytes and the next) of a block go to
buckets by their last four context bytes, so a bucket holds whole subtrees. A bucket is folded once
and stored as one row: its cells with their counts, its sums for the upper tree, and the places of
each block's cells among them. The rows answer the blocks' cells, which meet their texts again by
block. Only the upper tree's nodes that some cell passes travel to all tasks (at most 32^3 contexts
of 255 decisions).

The unigram base needs the count of every training word, a table that grows with the corpus: the
``HEAD`` commonest words travel to the tasks, all others meet their counts in a join.

Defined cases: null and empty texts have the end token alone and a model score of 0; a null id
counts as the empty text when rows are held out; repeated rows are scored and counted each; without
training rows all counts are 0 and every bit costs one half; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.store import settings, settle
from tallyspark.llm.text import as_bytes, in_blocks, mix, small_batches, texts
from tallyspark.session import drop_folder, shared_folder

DEPTH = 3
CLASSES = 32
CONTEXTS = CLASSES**DEPTH
# Commonest training words that travel to every task, at most.
HEAD = 1 << 17
# Distinct words a task counts before it hands them on.
COUNTED = 1 << 19
COUNT_BLOCK = 4 << 20

# Bytes of context that the deepest nodes tell, and those that a bucket's subtrees have in common.
DEEP, DEALT = 7, 4
DEEP_BLOCK = 16 << 20
# Answers travel as 24-bit steps of a log10 probability (which is above -128).
STEP = 2.0**-17
# Buckets of up to 2 GB of text; from there their number grows with the text, and beyond the second
# number with the square root, so that a block's cells don't fall apart into pieces of a few each.
BUCKETS, EVEN_BUCKETS = 128, 1 << 12

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _classes() -> np.ndarray:
    out = np.full(256, 29, dtype=np.int32)  # other signs
    for letter in range(26):
        out[65 + letter] = out[97 + letter] = letter
    out[32] = 26
    out[[9, 10, 11, 12, 13]] = 27
    out[48:58] = 28
    out[128:192] = 31  # the rest of a wide character
    out[192:] = 30  # its first byte
    return out


_CLASS = _classes()
_PAD = b"\n" * DEPTH


def cells(texts_: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, byte) of every place of the padded texts as one number, and where each text begins and ends."""
    data = np.frombuffer(_PAD + _PAD.join(texts_), dtype=np.uint8)
    lengths = np.fromiter((len(t) for t in texts_), dtype=np.int64, count=len(texts_))
    begin = np.cumsum(lengths + DEPTH) - lengths - DEPTH  # in the array of places, which lacks the first pad
    class_ = _CLASS[data]
    context = (class_[:-3] << 10) | (class_[1:-2] << 5) | class_[2:-1]
    return (context << 8) | data[DEPTH:], begin, begin + lengths


def count_cells(train: DataFrame) -> DataFrame:
    """``cell, n`` over the whole texts; each task adds up its own first."""

    def run(batches):
        total = np.zeros(CONTEXTS * 256, dtype=np.int64)
        for batch in in_blocks(batches, COUNT_BLOCK):
            cell, begin, end = cells(as_bytes(batch.column("text")))
            inside = np.zeros(len(cell) + 1, dtype=np.int8)
            np.add.at(inside, begin, 1)
            np.add.at(inside, end, -1)
            total += np.bincount(cell[np.cumsum(inside[:-1], dtype=np.int8) > 0], minlength=len(total))
        used = np.flatnonzero(total)
        for at in range(0, len(used), 1 << 16):
            part = used[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["cell", "n"])

    return texts(train).mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x above 0: Stirling's series seven places up."""
    shifted, product = x + 7.0, x.copy()
    for k in range(1, 7):
        product = product * (x + k)
    inverse = 1 / shifted
    series = inverse * (1 / 12 - inverse**2 * (1 / 360 - inverse**2 * (1 / 1260 - inverse**2 / 1680)))
    return (shifted - 0.5) * np.log(shifted) - shifted + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Block probability of that many zeros and ones by Krichevsky and Trofimov."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - np.log(np.pi) - _log_gamma(zeros + ones + 1.0)


def _decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at the 255 decisions of each row of byte counts; decision k has children 2k and 2k + 1."""
    tree = np.zeros((*counts.shape[:-1], 512), dtype=np.float64)
    tree[..., 256:] = counts
    for width in (128, 64, 32, 16, 8, 4, 2, 1):
        tree[..., width : 2 * width] = tree[..., 2 * width : 4 * width : 2] + tree[..., 2 * width + 1 : 4 * width : 2]
    return tree[..., 2::2], tree[..., 3::2]


def _node(zeros, ones, below):
    """Estimate, weighted log probability and own weight of nodes with children's sum ``below``."""
    half = np.log(0.5)
    estimate = (ones + 0.5) / (zeros + ones + 1.0)
    own = half + _log_kt(zeros, ones)
    weighted = np.logaddexp(own, half + below)
    return estimate, weighted, np.exp(own - weighted)


def _near(counts: np.ndarray, below: np.ndarray | None = None) -> tuple[list[tuple], tuple]:
    """Nodes of depth 1 and 2 by the nearest byte, and the root; ``below`` has the children's sums of depth 3."""
    near = []
    for c1 in range(CLASSES):
        z3, o3 = _decisions(counts[:, :, c1])
        l3 = _log_kt(z3, o3) if below is None else _node(z3, o3, below[:, :, c1])[1]
        z2, o2, z1, o1 = z3.sum(0), o3.sum(0), z3.sum((0, 1)), o3.sum((0, 1))
        p2, l2, w2 = _node(z2, o2, l3.sum(0))
        p1, l1, w1 = _node(z1, o1, l2.sum(0))
        near.append((p1, l1, w1, p2, w2))
    z0, o0 = _decisions(counts.sum((0, 1, 2)))
    p0, _, w0 = _node(z0, o0, sum(l1 for _, l1, *_ in near))
    return near, (p0, w0)


def byte_table(cell: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 probability of each byte after each context of the upper tree alone, as [context, byte]."""
    counts = np.zeros(CONTEXTS * 256, dtype=np.int64)
    counts[cell] = n
    counts = counts.reshape(CLASSES, CLASSES, CLASSES, 256)  # farthest, middle, nearest byte
    near, (p0, w0) = _near(counts)
    table = np.zeros((CLASSES, CLASSES, CLASSES, 256), dtype=np.float32)
    for c1, (p1, _, w1, p2, w2) in enumerate(near):
        z3, o3 = _decisions(counts[:, :, c1])
        one = (o3 + 0.5) / (z3 + o3 + 1.0)
        for p, w in ((p2, w2), (p1, w1), (p0, w0)):
            one = w * p + (1 - w) * one
        log_one, log_zero = np.log10(one), np.log10(1 - one)
        level = np.zeros((CLASSES, CLASSES, 1))
        for bit in range(8):
            lo = (1 << bit) - 1
            pair = np.stack([log_zero[..., lo : 2 * lo + 1], log_one[..., lo : 2 * lo + 1]], axis=-1)
            level = (level[..., None] + pair).reshape(CLASSES, CLASSES, -1)
        table[:, :, c1] = level
    return table.reshape(CONTEXTS, 256)


def train_table(train: DataFrame) -> np.ndarray:
    """The byte table of a training set: at most 2^23 counts come to the driver."""
    counts = count_cells(train).toPandas()
    return byte_table(counts["cell"].to_numpy(dtype=np.int64), counts["n"].to_numpy(dtype=np.int64))


def code_lengths(texts_: list[bytes], table: np.ndarray) -> np.ndarray:
    """log10 probability of each text."""
    cell, begin, end = cells(texts_)
    total = np.zeros(len(cell) + 1)
    np.cumsum(table.ravel()[cell], dtype=np.float64, out=total[1:])
    return total[end] - total[begin]

def deep_cells(texts_: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every place of the padded texts as a number: the context from the nearest byte on, then the byte."""
    pad = b"\n" * DEEP
    data = np.frombuffer(pad + pad.join(texts_), dtype=np.uint8)
    lengths = np.fromiter((len(t) for t in texts_), dtype=np.int64, count=len(texts_))
    begin = np.cumsum(lengths + DEEP) - lengths - DEEP
    n = len(data) - DEEP
    key = np.empty((n, 8), dtype=np.uint8)  # little-endian: the byte first, the nearest byte of context last
    key[:, 0] = data[DEEP:]
    for back in range(1, DEEP + 1):
        key[:, 8 - back] = data[DEEP - back : DEEP - back + n]
    key = key.view("<u8").ravel()
    return key, begin, begin + lengths


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    if not len(ordered):
        return np.zeros(0, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])


def _counted(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, their numbers added up."""
    order = np.argsort(keys)
    keys = keys[order]
    first = _runs(keys)
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _inside(key: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The places of texts, without those between them."""
    step = np.zeros(len(key) + 1, dtype=np.int8)
    np.add.at(step, begin, 1)
    np.add.at(step, end, -1)
    return key[np.cumsum(step[:-1], dtype=np.int8) > 0]


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by bucket, and the buckets in that order."""
    bucket = (mix(keys >> np.uint64(64 - 8 * DEALT)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def _packed(values: np.ndarray, width: int | None = None) -> bytes:
    """Bytes of equal rank side by side, compressed; ``width`` leaves out the high ones."""
    planes = values.view(np.uint8).reshape(len(values), -1).T[:width]
    return pa.compress(np.ascontiguousarray(planes), "zstd", asbytes=True)


def _unpacked(data: bytes, kind: str, size: int, width: int | None = None) -> np.ndarray:
    out = np.zeros((size, np.dtype(kind).itemsize), dtype=np.uint8)
    width = width or out.shape[1]
    raw = pa.decompress(data, size * width, "zstd", asbytes=True)
    out[:, :width] = np.frombuffer(raw, dtype=np.uint8).reshape(width, size).T
    return out.view(kind).ravel()


def _block_cells(texts_: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells in order, and how often each stands in the texts."""
    key, at = np.empty(sum(map(len, texts_)), dtype=np.uint64), 0
    for part in _slices(texts_, DEEP_BLOCK >> 3):
        found = _inside(*deep_cells(part))
        key[at : at + len(found)] = found
        at += len(found)
    key.sort()
    first = _runs(key)
    return key[first], np.diff(first, append=len(key)).astype(np.uint32)


def pack_pieces(texts_: list[bytes], train: np.ndarray, buckets: int):
    """(bucket, size, keys, counts) of a block's distinct cells; cells of other than training texts count 0."""
    seen, times = _block_cells([t for t, chosen in zip(texts_, train) if chosen])
    other, _ = _block_cells([t for t, chosen in zip(texts_, train) if not chosen])
    keys = np.sort(np.concatenate([seen, other]))
    keys = keys[_runs(keys)]
    n = np.zeros(len(keys), dtype=np.uint32)
    n[np.searchsorted(keys, seen)] = times
    order, bucket = _dealt(keys, buckets)
    edges = _runs(bucket).tolist() + [len(bucket)]
    for a, b in zip(edges, edges[1:]):
        mine = keys[order[a:b]]
        yield int(bucket[a]), b - a, _packed(np.diff(mine, prepend=np.uint64(0))), _packed(n[order[a:b]])


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells of a bucket in order, and their counts in all blocks."""
    keys, n = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    parts, held = [(keys, n)], 0
    for size, packed, counts in zip(table["size"].to_pylist(), table["keys"], table["counts"]):
        parts.append((np.cumsum(_unpacked(packed.as_py(), "<u8", size), dtype=np.uint64), _unpacked(counts.as_py(), "<u4", size).astype(np.int64)))
        held += size
        if held > 1 << 20 and held > len(parts[0][0]):
            parts, held = [_counted(*(np.concatenate(c) for c in zip(*parts)))], 0
    return _counted(*(np.concatenate(c) for c in zip(*parts)))


_SMALL = 256
_KT: list[np.ndarray] = []


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """``_log_kt`` with small counts looked up."""
    if not _KT:
        at = np.arange(_SMALL, dtype=np.float64)
        _KT.append(_log_kt(at[:, None], at[None, :]))
        _KT[0][0, 0] = 0.0
    large = (zeros >= _SMALL) | (ones >= _SMALL)
    out = _KT[0].ravel().take(np.where(large, 0, zeros * _SMALL + ones))
    if large.any():
        out[large] = _log_kt(zeros[large].astype(np.float64), ones[large].astype(np.float64))
    return out


@dataclass
class Level:
    """Nodes of one depth for one bit: estimates, own weights, and where their children begin one level down."""

    key: np.ndarray
    estimate: np.ndarray
    seen: np.ndarray
    weight: np.ndarray
    weighted: np.ndarray
    first: np.ndarray


def _levels(keys: np.ndarray, n: np.ndarray, bit: int) -> tuple[np.ndarray, list[Level]]:
    """The order of the cells (given in order) by path and context, and the levels from the deepest up."""
    path = ((keys & np.uint64(255)) >> np.uint64(8 - bit)).astype(np.uint8)
    order = np.argsort(path, kind="stable")
    ordered, count = keys[order], n[order]
    key = (path[order].astype(np.uint64) << np.uint64(56)) | (ordered >> np.uint64(8))
    one = ((ordered >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
    zeros, ones, below, half = np.where(one, 0, count), np.where(one, count, 0), None, np.log(0.5)
    levels = []
    for depth in range(DEEP, DEALT - 1, -1):
        first = _runs(key)
        key, zeros, ones = key[first], np.add.reduceat(zeros, first), np.add.reduceat(ones, first)
        own = _kt(zeros, ones)
        if below is None:
            weighted, weight = own, np.ones(len(own))
        else:
            below = np.add.reduceat(below, first)
            less = np.exp(-np.abs(own - below))  # of the two, the lesser by the greater
            weighted = np.maximum(own, below) + np.log(1 + less) + half
            weight = np.where(own >= below, 1.0, less) / (1 + less)
        below = weighted
        levels.append(Level(key, (ones + 0.5) / (zeros + ones + 1.0), zeros + ones > 0, weight, weighted, first))
        key = key >> np.uint64(8)
    return order, levels


def _upper_cells(key: np.ndarray, bit: int) -> np.ndarray:
    """Class context and decision of nodes of the depth that is dealt."""
    c1, c2, c3 = (_CLASS[((key >> np.uint64(8 * (DEALT - k))) & np.uint64(255)).astype(np.int64)] for k in (1, 2, 3))
    path = (key >> np.uint64(8 * DEALT)).astype(np.int64)
    return (((c3.astype(np.int64) << 10) | (c2 << 5) | c1) << 8) | (1 << bit) | path


def fold_sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``deep, cell, value``: log weighted probability below each upper node, and counts of the upper cells.

    Every node that ``cell_logs`` asks of the upper tree is among the deep ones.
    """
    out = []
    for bit in range(8):
        top = _levels(keys, n, bit)[1][-1]
        out.append(_counted(_upper_cells(top.key, bit), top.weighted))
    context = _upper_cells(keys >> np.uint64(8 * (DEEP + 1 - DEALT)), 0) & ~np.int64(255)
    cell, count = _counted(context | (keys & np.uint64(255)).astype(np.int64), n)
    deep = np.concatenate([c for c, _ in out])
    flag = np.repeat([True, False], [len(deep), len(cell)])
    return flag, np.concatenate([deep, cell]), np.concatenate([*(v for _, v in out), count.astype(np.float64)])


@dataclass
class Upper:
    """By cell, in order: what the nodes of depth 0 to 3 give to a decision, what they leave, and the value where nothing deeper was seen."""

    cell: np.ndarray
    given: np.ndarray
    left: np.ndarray
    alone: np.ndarray


def cell_logs(keys: np.ndarray, n: np.ndarray, upper: Upper) -> np.ndarray:
    """log10 probability of each cell's byte after its context."""
    logs = np.zeros(len(keys))
    for bit in range(8):
        order, levels = _levels(keys, n, bit)
        at = np.searchsorted(upper.cell, _upper_cells(levels[-1].key, bit))
        given, left, final = upper.given[at], upper.left[at], upper.alone[at]
        for k, level in enumerate(reversed(levels)):
            if k:
                above = levels[len(levels) - k]
                size = np.diff(np.append(above.first, len(level.key)))
                given, left, final = np.repeat(given, size), np.repeat(left, size), np.repeat(final, size)
            final = np.where(level.seen, given + left * level.estimate, final)
            given, left = given + left * level.weight * level.estimate, left * (1 - level.weight)
        final = np.repeat(final, np.diff(np.append(levels[0].first, len(keys))))
        one = ((keys[order] >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        logs[order] += np.log10(np.where(one, final, 1 - final))
    return logs


def upper_tree(sums) -> Upper:
    """From the folded buckets: at most 2^24 sums come to the driver."""
    deep = sums["deep"].to_numpy(dtype=bool)
    cell, value = sums["cell"].to_numpy(dtype=np.int64), sums["value"].to_numpy(dtype=np.float64)
    counts = np.zeros(CONTEXTS * 256, dtype=np.int64)
    counts[cell[~deep]] = np.rint(value[~deep]).astype(np.int64)
    below = np.zeros(CONTEXTS * 256)
    below[cell[deep]] = value[deep]
    asked = np.sort(cell[deep])
    given, left, alone = (np.zeros(len(asked)) for _ in range(3))
    shape = (CLASSES, CLASSES, CLASSES, 256)
    counts, below = counts.reshape(shape), below.reshape(shape)[..., 1:]
    near, (p0, w0) = _near(counts, below)
    nearest = (asked >> 8) & (CLASSES - 1)
    for c1, (p1, _, w1, p2, w2) in enumerate(near):
        mine = np.flatnonzero(nearest == c1)
        if not len(mine):
            continue
        z3, o3 = _decisions(counts[:, :, c1])
        p3, _, w3 = _node(z3, o3, below[:, :, c1])
        total, rest = np.zeros_like(p3), np.ones_like(p3)
        for p, w in ((p0, w0), (p1, w1), (p2, w2)):
            total, rest = total + rest * w * p, rest * (1 - w)
        at, decision = asked[mine] >> 13, (asked[mine] & 255) - 1
        for out, part in ((given, total + rest * w3 * p3), (left, rest * (1 - w3)), (alone, total + rest * p3)):
            out[mine] = part.reshape(-1, 255)[at, decision]
    return Upper(asked, given, left, alone)


def block_scores(texts_: list[bytes], buckets: int, answers: list[tuple[int, int, bytes]]) -> np.ndarray:
    """log10 probability of each text of a block, from its cells' answers by bucket."""
    known, _ = _block_cells(texts_)
    order, _ = _dealt(known, buckets)
    logs = np.zeros(len(known))
    if answers:
        logs[order] = np.concatenate([_unpacked(data, "<u4", size, 3) for _, size, data in sorted(answers)]) * -STEP
    out = []
    for part in _slices(texts_, DEEP_BLOCK >> 3):
        key, begin, end = deep_cells(part)
        by_key = np.argsort(key)
        key = key[by_key]
        first = _runs(key)
        if len(known):  # places between texts have no cell; what they get is left out below
            value = logs[np.minimum(np.searchsorted(known, key[first]), len(known) - 1)]
            key = np.empty(len(key))
            key[by_key] = np.repeat(value, np.diff(np.append(first, len(key))))
        total = np.zeros(len(key) + 1)
        np.cumsum(key, dtype=np.float64, out=total[1:])
        out.append(total[end] - total[begin])
    return np.concatenate(out)


def _slices(texts_: list[bytes], limit: int):
    """Runs of texts of about ``limit`` bytes, or of one text."""
    held, size = [], 0
    for text in texts_:
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    yield held


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def count_words(train: DataFrame) -> DataFrame:
    """``word, n`` over the whole texts."""

    def rows(counted: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches):
        counted: Counter = Counter()
        for batch in in_blocks(batches):
            for text in as_bytes(batch.column("text")):
                counted.update(words_of(text))
            if len(counted) > COUNTED:
                yield rows(counted)
                counted.clear()
        yield rows(counted)

    return texts(train).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _commonest(vocabulary: DataFrame) -> DataFrame:
    """The words above the least count that at most ``HEAD`` words reach.

    Counts are told apart in steps of an eighth of a power of two, so the driver
    sees a few hundred sizes and no task sends more words than are taken.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = vocabulary.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, taken = 1 << 30, 0
    for row in sorted(sizes, key=lambda r: -r["step"]):
        taken += row["words"]
        if taken > HEAD:
            break
        least = row["step"]
    return vocabulary.filter(step >= least)


# Blocks and buckets are rows of megabytes: few of them stand in the JVM and in a worker at once. A
# query's shuffle files go when it has ended, since what it wrote is in its table.
WIDE_ROWS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2",
    "spark.sql.parquet.columnarReaderBatchSize": "2",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

BLOCKS = "block long, body binary"
PIECES = "block long, bucket int, size int, keys binary, counts binary"


def deal_blocks(rows: DataFrame) -> DataFrame:
    """The rows dealt into numbered blocks, each a compressed Arrow stream."""

    def run(batches):
        block = TaskContext.get().partitionId() << 22
        for batch in in_blocks(_gathered(batches), DEEP_BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([_body(batch)], pa.binary())], names=["block", "body"])
            block += 1

    return small_batches(rows).mapInArrow(run, BLOCKS)


def _body(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(body: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(body).read_next_batch()


def _held(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)


def cell_pieces(blocks: DataFrame, buckets: int) -> DataFrame:
    """The distinct cells of each block by bucket."""

    def run(batches):
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body")):
                rows = _opened(body.as_py())
                parts = list(pack_pieces(as_bytes(rows.column("text")), ~_held(rows), buckets))
                columns = [[block] * len(parts), *(zip(*parts) if parts else [()] * 4)]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                names = ["block", "bucket", "size", "keys", "counts"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return blocks.mapInArrow(run, PIECES)


def _gathered(batches):
    """Batches put together up to the bytes of a block."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= DEEP_BLOCK:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


BUCKET = (
    "bucket int, size int, keys binary, counts binary, sums array<struct<deep:boolean,cell:long,value:double>>, "
    "blocks array<struct<block:long,size:int,places:binary>>"
)


def fold_buckets(pieces: DataFrame) -> DataFrame:
    """One row a bucket: its cells and their counts, its sums for the upper tree, and each block's places among the cells."""

    def fold(table: pa.Table) -> pa.Table:
        keys, n = _merged(table)
        sums = pa.StructArray.from_arrays([pa.array(c) for c in fold_sums(keys, n)], names=["deep", "cell", "value"])
        places = []
        for size, packed in zip(table["size"].to_pylist(), table["keys"]):
            mine = np.cumsum(_unpacked(packed.as_py(), "<u8", size), dtype=np.uint64)
            places.append(_packed(np.diff(np.searchsorted(keys, mine), prepend=0).astype("<u4")))
        blocks = pa.StructArray.from_arrays(
            [table["block"].combine_chunks(), table["size"].combine_chunks(), pa.array(places, pa.binary())],
            names=["block", "size", "places"],
        )
        columns = [
            table["bucket"].combine_chunks()[:1],
            pa.array([len(keys)], pa.int32()),
            pa.array([_packed(np.diff(keys, prepend=np.uint64(0)))], pa.binary()),
            pa.array([_packed(n.astype("<i8"))], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(sums)], pa.int32()), sums),
            pa.ListArray.from_arrays(pa.array([0, len(blocks)], pa.int32()), blocks),
        ]
        return pa.table(columns, names=[n for n, _ in _names(BUCKET)])

    return pieces.groupBy("bucket").applyInArrow(fold, BUCKET)


def answer_buckets(buckets: DataFrame) -> DataFrame:
    """``block, bucket, size, logs``: the log10 probabilities of each block's cells in each bucket."""
    sums = buckets.select(F.explode("sums").alias("s")).groupBy("s.deep", "s.cell").agg(F.sum("s.value").alias("value"))
    shared = buckets.sparkSession.sparkContext.broadcast(upper_tree(sums.toPandas()))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                bucket, size, keys, counts, blocks = (batch.column(c)[row] for c in range(5))
                keys = np.cumsum(_unpacked(keys.as_py(), "<u8", size.as_py()), dtype=np.uint64)
                logs = np.rint(cell_logs(keys, _unpacked(counts.as_py(), "<i8", len(keys)), shared.value) / -STEP).astype("<u4")
                numbers, sizes, places = blocks.values.flatten()
                out = []
                for length, packed in zip(sizes.to_pylist(), places):
                    out.append(_packed(logs[np.cumsum(_unpacked(packed.as_py(), "<u4", length), dtype=np.int64)], 3))
                columns = [numbers, pa.array([bucket.as_py()] * len(out), pa.int32()), sizes, pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "bucket", "size", "logs"])

    rows = buckets.select("bucket", "size", "keys", "counts", "blocks")
    return rows.mapInArrow(run, "block long, bucket int, size int, logs binary")


PARTS = (
    "block long, place int, doc_id long, held_out boolean, n_tokens long, n_bytes long, known long, logs double, score double, "
    "rare array<struct<word:binary,times:int>>"
)


def bucket_count(size: int) -> int:
    even = BUCKETS * max(1.0, size / (2 << 30))
    return int(even if even <= EVEN_BUCKETS else (even * EVEN_BUCKETS) ** 0.5)


def score_documents(docs: DataFrame, held_out) -> DataFrame:
    """Learn from the rows where ``held_out`` (a column) is not true, score all rows.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.filter(~F.col("held_out"))
    vocabulary = settle(count_words(train))
    words = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("distinct")).first()
    sizes = rows.agg(
        F.coalesce(F.sum((~F.col("held_out")).cast("long")), F.lit(0)).alias("ends"),
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"),
    ).first()
    ends, buckets = sizes["ends"], bucket_count(sizes["bytes"])
    scratch = [shared_folder(spark) for _ in range(2)]
    blocks = settle(deal_blocks(rows), path=scratch[0])
    tokens, distinct = words["n"] + ends, words["distinct"] + (ends > 0)
    common = _commonest(vocabulary).toPandas()
    head = dict(zip(map(bytes, common["word"]), np.log10(common["n"].to_numpy(dtype=np.float64) + 0.5).tolist()))
    shared = spark.sparkContext.broadcast(head)
    end_log, end_known = float(np.log10(ends + 0.5)), int(ends > 0)

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        head = shared.value
        cell_answers = list(zip(answers["bucket"].to_pylist(), answers["size"].to_pylist(), answers["logs"].to_pylist()))
        out = []
        for number, body in zip(table["block"].to_pylist(), table["body"].to_pylist()):
            batch = _opened(body)
            bodies = as_bytes(batch.column("text"))
            counts, known, logs, rare_words, rare_times, stops = [], [], [], [], [], [0]
            for text in bodies:
                found = words_of(text)
                log, seen = end_log, end_known
                for word, times in Counter(found).items():
                    value = head.get(word)
                    if value is None:
                        rare_words.append(word)
                        rare_times.append(times)
                    else:
                        log += times * value
                        seen += times
                counts.append(len(found) + 1)
                known.append(seen)
                logs.append(log)
                stops.append(len(rare_words))
            rare = pa.StructArray.from_arrays(
                [pa.array(rare_words, pa.binary()), pa.array(rare_times, pa.int32())], names=["word", "times"]
            )
            columns = [
                pa.array([number] * len(bodies), pa.int64()),
                pa.array(range(len(bodies)), pa.int32()),
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(counts, pa.int64()),
                pa.array([len(t) for t in bodies], pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(logs, pa.float64()),
                pa.array(block_scores(bodies, buckets, cell_answers)),
                pa.ListArray.from_arrays(pa.array(stops, pa.int32()), rare),
            ]
            out.append(pa.RecordBatch.from_arrays(columns, names=[n for n, _ in _names(PARTS)]))
        return pa.Table.from_batches(out)

    with settings(spark, WIDE_ROWS):
        logs = answer_buckets(settle(fold_buckets(cell_pieces(blocks, buckets)), path=scratch[1]))
        parts = settle(blocks.groupBy("block").cogroup(logs.groupBy("block")).applyInArrow(run, PARTS))
    for path in scratch:
        drop_folder(spark, path)
    shared.unpersist()
    rare = parts.select("block", "place", F.explode("rare").alias("r")).select("block", "place", "r.word", "r.times")
    counted = rare.join(vocabulary, "word", "left").groupBy("block", "place").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + 0.5)).alias("rare_logs"),
    )
    whole = float(np.log10(tokens + 0.5 * (distinct + 1)))
    return parts.drop("rare").join(counted, ["block", "place"], "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * whole).alias("base_score"),
        "score",
        "n_bytes",
        F.when(F.col("n_bytes") > 0, -F.col("score") / (F.col("n_bytes") * float(np.log10(2)))).alias("bits_per_byte"),
    )


def _names(schema: str) -> list[tuple[str, str]]:
    """Top-level fields of a schema text without nested commas outside angle brackets."""
    fields, depth, start = [], 0, 0
    for at, sign in enumerate(schema + ","):
        depth += (sign == "<") - (sign == ">")
        if sign == "," and not depth:
            name, kind = schema[start:at].strip().split(" ", 1)
            fields.append((name, kind))
            start = at + 1
    return fields
