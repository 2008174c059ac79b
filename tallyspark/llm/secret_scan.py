"""Secrets by patterns and a small character convolution over every candidate and its surroundings.

Patterns give base spans, which always stay. A candidate is a run of 16 or more characters of
``[A-Za-z0-9+/_.=-]`` with a digit; the network reads all of it, in windows, with the text before
and after. It is trained on all the patterns' labelled findings against the other candidates
and plain words, by Adam steps in Spark tasks whose states are averaged each round; its scores are
calibrated by Spark sums on held-out windows (those whose hash is 0 mod 5), and the threshold is the highest
that still reaches ``RECALL`` there. Candidates apart from base spans that reach it are added.

Defined cases: null and empty texts have no spans; null ids stay; repeated rows are searched each;
without findings of both labels nothing is added; an empty table gives an empty result; other
columns are not read. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.frames import top_rows
from tallyspark.llm.text import as_bytes, in_blocks, small_batches, texts

# Kinds in the order of the results, and their patterns; what the network adds comes last.
KINDS = ("assign", "access", "hex", "learned")
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
WORD = re.compile(r"[A-Za-z]{10,}")
DIGIT = re.compile(r"[0-9]")

# Distinct windows of each label that learn(rows=TRAINING_ROWS) trains on at most; by default it trains on all of them.
TRAINING_ROWS = 3000
# Training windows a task takes in one round of averaged Adam steps, about.
PARTITION_ROWS = 4096
BEFORE, INSIDE, AFTER = 24, 64, 8
LENGTH = BEFORE + INSIDE + AFTER
EMBED, FILTERS, SPAN = 8, 24, 5
EPOCHS, BATCH, RATE = 8, 64, 0.01
# Few rows are passed over more often, up to this many steps.
LEAST_STEPS = 300
RECALL = 0.99

_HEX_BYTES = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORDS = (b"passw", b"secret", b"token", b"api")
_NOT_DIGITS = bytes(b for b in range(256) if not 48 <= b <= 57)

SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean,probability:double>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, by start and then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if DIGIT.search(m.group())]


def _codes() -> np.ndarray:
    out = np.full(128, 67, dtype=np.uint8)  # other signs
    for i in range(26):
        out[97 + i], out[65 + i] = 1 + i, 27 + i
    out[48:58] = np.arange(53, 63)
    for sign, code in ((" ", 63), ('"', 64), ("'", 64), ("=", 65), (":", 66), ("\n", 63)):
        out[ord(sign)] = code
    return out


_CODE = _codes()
CODES = 69  # 0 pads, 68 is beyond ASCII


def windows(text: str, a: int, b: int) -> list[bytes]:
    """Code windows that together cover the candidate whole, each with its surroundings."""
    out = []
    for start in range(a, b, INSIDE):
        end = min(b, start + INSIDE)
        left, body, right = text[max(0, start - BEFORE) : start], text[start:end], text[end : end + AFTER]
        points = np.frombuffer((left + body + right).encode("utf-32-le"), dtype="<u4")
        codes = np.where(points < 128, _CODE[np.minimum(points, 127)], 68).astype(np.uint8)
        row = np.zeros(LENGTH, dtype=np.uint8)
        row[BEFORE - len(left) : BEFORE + len(body)] = codes[: len(left) + len(body)]
        row[BEFORE + INSIDE : BEFORE + INSIDE + len(right)] = codes[len(left) + len(body) :]
        out.append(row.tobytes())
    return out


@dataclass
class Network:
    """Embedding, one convolution with the largest response of each filter, a logistic unit, calibration."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0

    def _columns(self, codes: np.ndarray) -> np.ndarray:
        x = np.zeros((len(codes), LENGTH, EMBED + 1), dtype=np.float32)
        x[:, :, :EMBED] = self.embedding[codes]
        x[:, BEFORE : BEFORE + INSIDE, EMBED] = codes[:, BEFORE : BEFORE + INSIDE] > 0  # inside the candidate
        steps = LENGTH - SPAN + 1
        return np.concatenate([x[:, k : k + steps] for k in range(SPAN)], axis=2)

    def respond(self, codes: np.ndarray):
        columns = self._columns(codes)
        response = columns @ self.filters + self.bias
        at = response.argmax(axis=1)
        best = np.maximum(np.take_along_axis(response, at[:, None], axis=1)[:, 0], 0)
        return columns, at, best

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self.respond(codes[i : i + 512])[2] @ self.out[:-1] + self.out[-1] for i in range(0, len(codes), 512)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * self.logits(codes) + self.shift)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(codes: np.ndarray, label: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """A fifth of the distinct windows of each label with all their rows; windows of both labels go with the findings."""
    window = np.unique(codes, axis=0, return_inverse=True)[1].reshape(-1)
    found = np.unique(window[label == 1])
    held = np.zeros(len(label), dtype=bool)
    for mine in (np.setdiff1d(window, found), found):
        if len(mine) > 1:
            held |= np.isin(window, random.permutation(mine)[: max(1, len(mine) // 5)])
    return held


def train(codes: np.ndarray, label: np.ndarray, seed: int = 7) -> Network:
    """Fit, calibrate and set the threshold; a fifth of the rows is held out for the last two."""
    random = np.random.default_rng(seed)
    held = held_out(codes, label, random)
    net = Network(
        random.normal(0, 0.3, (CODES, EMBED)).astype(np.float32),
        random.normal(0, 0.3, (SPAN * (EMBED + 1), FILTERS)).astype(np.float32),
        np.zeros(FILTERS, dtype=np.float32),
        random.normal(0, 0.3, FILTERS + 1).astype(np.float32),
    )
    parts = [net.embedding, net.filters, net.bias, net.out]
    moment, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    rows, step = np.flatnonzero(~held), 0
    for _ in range(max(EPOCHS, LEAST_STEPS * BATCH // max(1, len(rows)))):
        rows = random.permutation(rows)
        for i in range(0, len(rows), BATCH):
            mine, step = rows[i : i + BATCH], step + 1
            slopes = _slopes(net, codes[mine], label[mine])
            for k, slope in enumerate(slopes):
                moment[k] = 0.9 * moment[k] + 0.1 * slope
                square[k] = 0.999 * square[k] + 0.001 * slope**2
                parts[k] -= RATE * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    truth, z = label[held].astype(float), net.logits(codes[held])
    net.slope, net.shift = _calibrate(z, truth)
    scores = np.sort(_logistic(net.slope * z + net.shift)[truth == 1])
    net.threshold = float(scores[int((1 - RECALL) * len(scores))]) if len(scores) else 1.0
    return net


def _slopes(net: Network, codes: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss with a little weight decay."""
    columns, at, best = net.respond(codes)
    n = len(label)
    off = (_logistic(best @ net.out[:-1] + net.out[-1]) - label) / n
    d_out = np.append(best.T @ off, off.sum())
    d_best = off[:, None] * net.out[:-1] * (best > 0)
    picked = columns[np.arange(n)[:, None], at]  # row, filter, column
    d_filters = np.einsum("nf,nfc->cf", d_best, picked)
    d_picked = (d_best[:, :, None] * net.filters.T[None]).reshape(n, FILTERS, SPAN, EMBED + 1)[..., :EMBED]
    place = at[:, :, None] + np.arange(SPAN)
    d_embedding = np.zeros_like(net.embedding)
    np.add.at(d_embedding, codes[np.arange(n)[:, None, None], place], d_picked)
    decay = 1e-4
    return [d_embedding + decay * net.embedding, d_filters + decay * net.filters, d_best.sum(0), d_out.astype(np.float32)]


def _calibrate(z: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the truth on the network's output, by Newton steps with a weak prior."""
    a, b = 1.0, 0.0
    for _ in range(25):
        p = _logistic(a * z + b)
        w = p * (1 - p)
        slope = np.array([((p - truth) * z).sum() + 0.1 * (a - 1), (p - truth).sum() + 0.1 * b])
        curve = np.array([[(w * z * z).sum() + 0.1, (w * z).sum()], [(w * z).sum(), w.sum() + 0.1]])
        change = np.linalg.solve(curve, slope)
        a, b = a - float(np.clip(change[0], -1, 1)), b - float(np.clip(change[1], -1, 1))
    return max(a, 1e-3), b


def _overlaps(a: int, b: int, spans: list[tuple[int, int, int]]) -> bool:
    return any(start < b and end > a for start, _, end in spans)


def _interesting(raw: list[bytes]) -> list[int]:
    """Texts that can hold a base span or a candidate."""
    out = []
    for i, text in enumerate(raw):
        if text.translate(None, _NOT_DIGITS) or b"AKIA" in text or b"x" * 24 in text.translate(_HEX_BYTES):
            out.append(i)
            continue
        lower = text.translate(_LOWER)
        if any(word in lower for word in _WORDS):
            out.append(i)
    return out


def labelled_windows(docs: DataFrame) -> DataFrame:
    """``codes, label`` of all windows of all candidates, and of one plain word of each text with candidates.

    A window is a finding where a base span covers part of it.
    """

    def run(batches):
        for batch in in_blocks(batches):
            raw = as_bytes(batch.column("text"))
            codes, label = [], []
            for i in _interesting(raw):
                text = raw[i].decode()
                base = base_spans(text)
                found = candidates(text)
                for a, b in found:
                    codes += windows(text, a, b)
                    label += [int(_overlaps(start, min(b, start + INSIDE), base)) for start in range(a, b, INSIDE)]
                for word in WORD.finditer(text, len(text) // 3) if found else ():
                    if not _overlaps(*word.span(), base):
                        codes.append(windows(text, *word.span())[0])
                        label.append(0)
                        break
            columns = [pa.array(codes, pa.binary()), pa.array(label, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["codes", "label"])

    return texts(docs).mapInArrow(run, "codes binary, label int")


def learn(docs: DataFrame, rows: int | None = None, seed: int = 7) -> Network | None:
    """Train on every distinct window of each label; None where a label has no finding.

    ``rows`` bounds each label to its windows of least hash and trains on the driver instead.
    """
    found = labelled_windows(docs).distinct()
    if rows is not None:
        return _learn_sample(found, rows)
    spark = found.sparkSession
    found = found.withColumn("held", F.pmod(F.xxhash64("codes"), F.lit(5)) == 0)
    by_label = {r["label"]: (r["n"], r["held"]) for r in found.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("held").cast("long")).alias("held")).collect()}
    if len(by_label) < 2:
        return None
    for value, (n, held) in by_label.items():  # a fifth, at least one window of each label where it has more than one
        if not held and n > 1:
            least = found.where(F.col("label") == value).orderBy(F.xxhash64("codes"), "codes").select("codes").limit(1)
            found = found.join(least.withColumn("_least", F.lit(True)), "codes", "left").select(
                "codes", "label", (F.col("held") | F.col("_least").isNotNull()).alias("held"))
    count = sum(n for n, _ in by_label.values())
    parts = max(1, count // PARTITION_ROWS + 1)
    rows_ = found.repartition(parts, "codes").sortWithinPartitions("codes", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit = rows_.where(~F.col("held")).select("codes", "label")
        n_fit = fit.count()
        random = np.random.default_rng(seed)
        net = Network(
            random.normal(0, 0.3, (CODES, EMBED)).astype(np.float32),
            random.normal(0, 0.3, (SPAN * (EMBED + 1), FILTERS)).astype(np.float32),
            np.zeros(FILTERS, dtype=np.float32),
            random.normal(0, 0.3, FILTERS + 1).astype(np.float32),
        )
        params = [net.embedding, net.filters, net.bias, net.out]
        state = (params, [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0.0)
        epochs = max(EPOCHS, LEAST_STEPS * BATCH // max(1, n_fit))
        passes = -(-epochs // EPOCHS)
        for round_ in range(min(EPOCHS, epochs)):
            state = _averaged(fit.mapInArrow(_local_steps(state, seed, round_, passes), "n long, state binary").collect(), state)
        net.embedding, net.filters, net.bias, net.out = state[0]
        _calibrated(net, rows_.where(F.col("held")).select("codes", "label"))
    finally:
        rows_.unpersist()
    return net


def _learn_sample(found: DataFrame, rows: int) -> Network | None:
    sample = top_rows(found, ["label"], [F.xxhash64("codes"), F.col("codes")], rows, "_rank").select("codes", "label").collect()
    label = np.array([r["label"] for r in sample], dtype=np.int64)
    if len(np.unique(label)) < 2:
        return None
    codes = np.frombuffer(b"".join(bytes(r["codes"]) for r in sample), dtype=np.uint8).reshape(-1, LENGTH)
    order = np.lexsort((*codes.T[::-1], label))  # the same network whatever order the rows came in
    return train(codes[order], label[order])


def _local_steps(state, seed: int, round_: int, passes: int):
    """Adam over the task's windows from the shared state, in random batches; the task's state comes back."""
    blob = pickle.dumps(state)

    def run(batches):
        params, moment, square, step = pickle.loads(blob)
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        codes = np.frombuffer(b"".join(bytes(x) for b in tables for x in b.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, LENGTH)
        label = np.concatenate([b.column("label").to_numpy(zero_copy_only=False) for b in tables]).astype(np.int64)
        net = Network(*params)
        parts = [net.embedding, net.filters, net.bias, net.out]
        random = np.random.default_rng([seed, round_, TaskContext.get().partitionId()])
        for _ in range(passes):
            rows = random.permutation(len(label))
            for i in range(0, len(rows), BATCH):
                mine, step = rows[i : i + BATCH], step + 1
                for k, slope in enumerate(_slopes(net, codes[mine], label[mine])):
                    moment[k] = 0.9 * moment[k] + 0.1 * slope
                    square[k] = 0.999 * square[k] + 0.001 * slope**2
                    parts[k] -= RATE * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        out = pickle.dumps((parts, moment, square, step))
        yield pa.RecordBatch.from_arrays([pa.array([len(label)], pa.int64()), pa.array([out], pa.binary())], names=["n", "state"])

    return run


def _averaged(rows, state):
    """States of the tasks averaged by their windows, in the order of the tasks."""
    if not rows:
        return state
    weights = np.array([r["n"] for r in rows], dtype=np.float64)
    weights /= weights.sum()
    states = [pickle.loads(bytes(r["state"])) for r in rows]
    mean = [[sum(w * s[j][k] for w, s in zip(weights, states)).astype(np.float32) for k in range(4)] for j in range(3)]
    return (*mean, float(sum(w * s[3] for w, s in zip(weights, states))))


def _calibrated(net: Network, held: DataFrame) -> None:
    """Calibration by Newton steps over Spark sums, threshold at the recall of the held-out findings."""

    def run(batches):
        for batch in batches:
            codes = np.frombuffer(b"".join(bytes(x) for x in batch.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, LENGTH)
            z = net.logits(codes).astype(np.float32) if len(codes) else np.zeros(0, np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(z, pa.float32()), batch.column("label")], names=["z", "label"])

    scored = held.mapInArrow(run, "z float, label int").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        z, t = F.col("z").cast("double"), F.col("label").cast("double")
        a, b = 1.0, 0.0
        for _ in range(25):
            p = 1 / (1 + F.exp(-F.least(F.greatest(F.lit(a) * z + F.lit(b), F.lit(-30.0)), F.lit(30.0))))
            w = p * (1 - p)
            s = scored.agg(
                F.sum((p - t) * z), F.sum(p - t), F.sum(w * z * z), F.sum(w * z), F.sum(w)
            ).first()
            s = [float(x or 0.0) for x in s]
            slope = np.array([s[0] + 0.1 * (a - 1), s[1] + 0.1 * b])
            curve = np.array([[s[2] + 0.1, s[3]], [s[3], s[4] + 0.1]])
            change = np.linalg.solve(curve, slope)
            a, b = a - float(np.clip(change[0], -1, 1)), b - float(np.clip(change[1], -1, 1))
        net.slope, net.shift = max(a, 1e-3), b
        found = scored.where(F.col("label") == 1)
        n = found.count()
        if n:
            k = int((1 - RECALL) * n)
            lowest = found.orderBy("z").select("z").limit(k + 1).collect()[-1]["z"]
            net.threshold = float(_logistic(net.slope * np.array([lowest], dtype=np.float32) + net.shift)[0])
        else:
            net.threshold = 1.0
    finally:
        scored.unpersist()


def find_spans(texts_: list[str], net: Network | None) -> list[list[tuple[str, int, int, bool, float]]]:
    """All spans of each text: by start, then kind."""
    based = [base_spans(text) for text in texts_]
    out = [[(s, k, e, True, 1.0) for s, k, e in base] for base in based]
    if net is not None:
        open_, codes = [], []
        for i, (text, base) in enumerate(zip(texts_, based)):
            for a, b in candidates(text):
                if not _overlaps(a, b, base):
                    parts = windows(text, a, b)
                    open_.append((i, a, b, len(codes), len(codes) + len(parts)))
                    codes += parts
        p = net.probability(np.frombuffer(b"".join(codes), dtype=np.uint8).reshape(-1, LENGTH)) if codes else ()
        for i, a, b, first, last in open_:
            best = float(p[first:last].max())
            if best >= net.threshold:
                out[i].append((a, len(KINDS) - 1, b, False, best))
    return [[(KINDS[k], s, e, base, p) for s, k, e, base, p in sorted(spans)] for spans in out]


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: base spans of every whole text and those the network adds."""
    net = learn(docs)

    def run(batches):
        for batch in in_blocks(batches):
            raw = as_bytes(batch.column("text"))
            found: list[list] = [[] for _ in raw]
            chosen = _interesting(raw)
            for i, spans in zip(chosen, find_spans([raw[i].decode() for i in chosen], net)):
                found[i] = [dict(zip(("kind", "start", "end", "base", "probability"), s)) for s in spans]
            kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("probability", pa.float64())])
            columns = [batch.column("doc_id"), pa.array(found, pa.list_(kind))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "spans"])

    return texts(docs).mapInArrow(run, SPANS)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every secret in ``text`` replaced; other columns and clean texts unchanged."""
    net = learn(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text")))
    names = docs.columns
    at = names.index(text)

    def run(batches):
        for batch in in_blocks(batches, text=text):
            column = batch.column(at)
            raw = as_bytes(column)
            chosen = _interesting(raw)
            new = {}
            for i, spans in zip(chosen, find_spans([raw[i].decode() for i in chosen], net)):
                if spans:
                    new[i] = _replace(raw[i].decode(), [(s, e) for _, s, e, *_ in spans], mark)
            if new:
                column = pa.array([new.get(i, t) for i, t in enumerate(column.to_pylist())], column.type)
            columns = [column if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return small_batches(docs).mapInArrow(run, docs.schema)


def _replace(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """Overlapping spans become one mark."""
    out, done = [], 0
    for a, b in sorted(spans):
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return "".join([*out, text[done:]])
