"""Quality scores by a generalised additive model with pairwise interactions.

Each text gives a fixed row of numbers. Per-feature lookup tables are learned by cyclic boosting:
one shallow tree on one feature's bins at a time, always on what the others leave; then tables of
the strongest feature pairs in the same way. A score is the sum of the looked-up values through the
logistic function, so scoring is binning and adding.

Defined cases: null and empty texts have the features of an empty text and are scored; a null id
counts as the empty text when rows are held out; label rows without a label are left out, of
repeated labels of an id each counts; without labelled rows every score is the even 0.5; an empty
table gives an empty result; columns other than id and text are not read for a score.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.text import Block, as_bytes, in_blocks, small_batches, texts

# Labelled rows a model is fitted on at most; those with the least hash of the id.
TRAINING_ROWS = 40_000
BINS = 32
PAIR_BINS = 8
PAIRS = 10
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.15
LEAVES = 4

FEATURES = (
    "log_bytes",
    "log_words",
    "mean_word",
    "upper_share",
    "digit_share",
    "stop_share",
    "exclaim_share",
    "bar_share",
    "symbol_share",
    "wide_share",
    "line_rate",
    "distinct_words",
    "top_word_share",
    "same_next_share",
    "distinct_pairs",
    "distinct_lines",
    "mean_line",
)

_CLASS = np.zeros(256, dtype=np.int64)  # 0: none of those below
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"()-", b"!", b"|", b"#$%&*+/<=>@[\\]^_`{}~", b"\n"), 1):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 9


def features(texts_: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    block = Block(texts_)
    n = block.rows
    row = np.repeat(np.arange(n), block.lengths + 1)
    counts = np.bincount(row * 10 + _CLASS[block.data], minlength=n * 10).reshape(n, 10).astype(np.float64)
    size = np.maximum(block.lengths, 1)
    letters = np.maximum(counts[:, 1] + counts[:, 2], 1)
    words, first = block.word_hashes()
    number = np.diff(first)
    out = np.zeros((n, len(FEATURES)))
    out[:, 0], out[:, 1] = np.log1p(block.lengths), np.log1p(number)
    out[:, 2] = block.lengths / np.maximum(number, 1)
    out[:, 3] = counts[:, 2] / letters
    out[:, 4:10] = counts[:, [3, 4, 5, 6, 7, 9]] / size[:, None]
    out[:, 10] = counts[:, 8] / np.maximum(number, 1)
    follow = words[:-1] * np.uint64(3) + words[1:] if len(words) > 1 else words[:0]
    same = np.append(words[1:] == words[:-1], False)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b > a:
            out[i, 11:15] = _repeats(words[a:b], same[a : b - 1], follow[a : b - 1])
        lines = texts_[i].split(b"\n")
        out[i, 15] = len(set(lines)) / len(lines)
        out[i, 16] = len(texts_[i]) / len(lines)
    return out


def _repeats(words: np.ndarray, same: np.ndarray, follow: np.ndarray) -> tuple[float, float, float, float]:
    """Share of distinct words, of the commonest word, of words equal to the next, of distinct pairs."""
    ordered = np.sort(words)
    begin = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    most = np.diff(np.append(begin, len(words))).max()
    pairs = np.sort(follow)
    distinct_pairs = 1 + np.count_nonzero(pairs[1:] != pairs[:-1]) if len(pairs) else 1
    return (
        len(begin) / len(words),
        most / len(words),
        np.count_nonzero(same) / len(words),
        distinct_pairs / max(len(pairs), 1),
    )


def feature_table(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the features of every whole text."""

    def run(batches):
        for batch in in_blocks(batches):
            flat = pa.array(features(as_bytes(batch.column("text"))).astype(np.float32).ravel())
            column = pa.FixedSizeListArray.from_arrays(flat, len(FEATURES)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], names=["doc_id", "features"])

    return texts(docs).mapInArrow(run, "doc_id long, features array<float>")


@dataclass
class Additive:
    """Lookup tables of single features and of feature pairs."""

    cuts: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            out += table[np.searchsorted(self.cuts[f], x[:, f], side="right")]
        for f, g, table in self.pairs:
            a = np.searchsorted(self.coarse[f], x[:, f], side="right")
            b = np.searchsorted(self.coarse[g], x[:, g], side="right")
            out += table[a, b]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.logit(x))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step values by bin of a tree with up to ``LEAVES`` leaves, split best first."""
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        best = (1e-6, 0, 0)
        for at, (a, b) in enumerate(leaves):
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            if not len(left_g):
                continue
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gain = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            if gain.max() > best[0]:
                best = (gain.max(), at, a + 1 + int(gain.argmax()))
        if not best[2]:
            break
        a, b = leaves.pop(best[1])
        leaves += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut of both axes: its gain, and the four steps as a table."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    top_g, top_h = cg[:-1, -1:], ch[:-1, -1:]
    left_g, left_h = cg[-1:, :-1], ch[-1:, :-1]
    all_g, all_h = cg[-1, -1], ch[-1, -1]
    a_g, a_h = cg[:-1, :-1], ch[:-1, :-1]
    parts = ((a_g, a_h), (top_g - a_g, top_h - a_h), (left_g - a_g, left_h - a_h), (all_g - top_g - left_g + a_g, all_h - top_h - left_h + a_h))
    gain = sum(_gain(pg, ph) for pg, ph in parts) - _gain(all_g, all_h)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    step = [pg[i, j] / (ph[i, j] + 1.0) for pg, ph in parts]
    table = np.zeros(g.shape)
    table[: i + 1, : j + 1], table[: i + 1, j + 1 :] = step[0], step[1]
    table[i + 1 :, : j + 1], table[i + 1 :, j + 1 :] = step[2], step[3]
    return float(gain[i, j]), table


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Learn the tables from feature rows and labels 0 or 1."""
    model = Additive()
    if not len(y):
        return model
    width = x.shape[1]
    model.cuts = [_cuts(x[:, f], BINS) for f in range(width)]
    model.coarse = [_cuts(x[:, f], PAIR_BINS) for f in range(width)]
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.intercept = float(np.log(mean / (1 - mean)))
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(model.cuts[f], x[:, f], side="right") for f in range(width)]
    z = np.full(len(y), model.intercept)
    for _ in range(ROUNDS):
        for f in range(width):
            p = _logistic(z)
            size = len(model.tables[f])
            step = RATE * _tree(np.bincount(bins[f], y - p, size), np.bincount(bins[f], p * (1 - p), size))
            model.tables[f] += step
            z += step[bins[f]]
    coarse = [np.searchsorted(model.coarse[f], x[:, f], side="right") for f in range(width)]

    def grids(f: int, g: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(model.coarse[f]) + 1, len(model.coarse[g]) + 1)
        cell = coarse[f] * shape[1] + coarse[g]
        return tuple(np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (y - p, p * (1 - p)))

    p = _logistic(z)
    usable = [f for f in range(width) if len(model.coarse[f])]
    strength = [(_quadrants(*grids(f, g, p))[0], f, g) for i, f in enumerate(usable) for g in usable[i + 1 :]]
    for _, f, g in sorted(strength, reverse=True)[:PAIRS]:
        model.pairs.append((f, g, np.zeros((len(model.coarse[f]) + 1, len(model.coarse[g]) + 1))))
    for _ in range(PAIR_ROUNDS):
        for f, g, table in model.pairs:
            step = RATE * _quadrants(*grids(f, g, _logistic(z)))[1]
            table += step
            z += step[coarse[f], coarse[g]]
    return model


def train(table: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Additive:
    """Fit on a bounded sample of the labelled rows of a feature table; ``labels`` has doc_id and label."""
    marked = table.join(labels.filter("label is not null").select("doc_id", "label"), "doc_id")
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("features", "label").toPandas()
    x = np.array(sample["features"].tolist(), dtype=np.float64).reshape(len(sample), len(FEATURES))
    return fit(x, sample["label"].to_numpy(dtype=np.float64))


def score(table: DataFrame, model: Additive) -> DataFrame:
    """``doc_id, score`` of a feature table."""

    def run(batches):
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy()
            scores = model.score(flat.reshape(-1, len(FEATURES)).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return table.mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Additive, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, all columns unchanged."""
    names = docs.columns

    def run(batches):
        for part in in_blocks(batches, text=text):
            x = features(as_bytes(part.column(text))).astype(np.float32).astype(np.float64)
            good = part.filter(pa.array(model.score(x) >= threshold))
            yield pa.RecordBatch.from_arrays([good.column(i) for i in range(len(names))], names=names)

    return small_batches(docs).mapInArrow(run, docs.schema)
