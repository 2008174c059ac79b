"""Personal data by patterns and a skip-chain conditional random field over each document.

Patterns give base spans, which always stay. The field's nodes are the number phrases and the words
with an at sign of a whole document; its labels are the kinds and "none". Neighbours that touch
share a chain potential. Distant nodes that repeat or resemble each other (the same text, the same
last digits, the same mailbox) share a skip potential, each linked to the next such node and to the
first such base span, so links grow with the nodes and not with their pairs, and no mention is far
from its evidence. Weights are learned from the patterns' own findings by
pseudo-likelihood; loopy message passing with the base spans held fixed, until messages no longer
change, then carries a label to the other mentions. A node is added when it is linked to a base span and its marginal is high.

Defined cases: null and empty texts have no spans; null ids stay; repeated rows are searched each;
where no text holds a base span nothing is added; an empty table gives an empty result; other columns
are not read. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.frames import top_rows
from tallyspark.llm.text import as_bytes, in_blocks, mix, texts

# Kinds in the order of the results, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[\x20().-]{0,2}[0-9])*")
AT_WORD = re.compile(r"[^\s@<>()\[\],;:\"|]+@[^\s@<>()\[\],;:\"|]*")

# Distinct texts that the weights are learned from at most: so many of any kind, and the same number again shared by
# the kinds of base spans they hold; those with the least hash of the text.
TRAINING_DOCS = 4000
# Nodes of a text that are learned from at most, each with all its neighbours; every label of the text takes part.
NODES_A_DOC = 64
# Messages are passed until none changes by more, or for so many rounds where they swing for ever.
TOLERANCE = 1e-4
ROUNDS = 1000
DAMPING = 0.5
ADDED = 0.9
HELD = 20.0
SIMILAR_DIGITS = 7
# What the skip potential of equal labels is worth before anything is learned.
SAME = 6.0

_PLAIN = bytes(b for b in range(256) if chr(b) not in "0123456789@")

SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean,probability:double>>"


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[0::2]) + sum(sum(divmod(2 * d, 10)) for d in values[1::2])) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            free = found.end()
        at = text.find("@", max(at + 1, free))
    return out


def _addresses(text: str) -> list[tuple[int, int]]:
    out = []
    for run in DOTTED.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                out.append((at, at + size))
            at += size + 1
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, by kind and then start."""
    out = [(0, a, b) for a, b in _emails(text)] + [(1, a, b) for a, b in _addresses(text)]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, m.start(), m.end()))
    return out


@dataclass
class Graph:
    """Nodes and edges of some documents."""

    spans: list[tuple[int, int]]
    x: np.ndarray  # features
    label: np.ndarray  # 0 none, else kind + 1, by the base spans
    chain: np.ndarray  # pairs of neighbours
    skip: np.ndarray  # pairs of similar nodes


WIDTH = 26


def _features(text: str, a: int, b: int) -> list[float]:
    body = text[a:b]
    digits = sum(c.isdigit() for c in body)
    buckets = [float(lo <= digits < hi) for lo, hi in ((0, 1), (1, 3), (3, 5), (5, 7), (7, 9), (9, 10), (10, 12), (12, 13), (13, 17), (17, 20), (20, 1 << 30))]
    before, after = text[a - 1 : a], text[b : b + 1]
    return [
        1.0,
        float("@" in body),
        float("@" in body and "." in body.rpartition("@")[2]),
        float("." in body),
        float(body.count(".") == 3),
        float("-" in body),
        float("(" in body),
        float(" " in body),
        float(body.startswith("+")),
        float(body.isdigit()),
        float(before.isalpha()),
        float(after.isalpha()),
        float(before in ("'", '"')),
        float(after in ("%", "$")),
        float(before in ("$", "#")),
        *buckets,
    ]


def _keys(text: str) -> list[str]:
    keys = ["text " + text.casefold()]
    digits = "".join(c for c in text if c.isdigit())
    mailbox, at, _ = text.partition("@")
    if at and len(mailbox) > 2:
        keys.append("mailbox " + mailbox.casefold())
    elif len(digits) >= SIMILAR_DIGITS:
        keys.append("digits " + digits[-SIMILAR_DIGITS:])
    return keys


def document_graph(text: str, base: list[tuple[int, int, int]]) -> Graph:
    """The nodes of one document."""
    words = [m.span() for m in AT_WORD.finditer(text)] if "@" in text else []
    spans, at = [], 0
    for m in NUMBER.finditer(text):
        while at < len(words) and words[at][1] <= m.start():
            at += 1
        if at == len(words) or m.end() <= words[at][0]:
            spans.append(m.span())
    spans = sorted(spans + words)
    label = np.zeros(len(spans), dtype=np.int64)
    ordered, seen = sorted(base, key=lambda s: (s[1], s[2])), 0
    for i, (a, b) in enumerate(spans):
        while seen < len(ordered) and ordered[seen][2] <= a:
            seen += 1
        for kind, start, end in ordered[seen : seen + 4]:
            if start < b and end > a:
                label[i] = kind + 1
                break
    chain = [(i, i + 1) for i in range(len(spans) - 1) if spans[i + 1][0] - spans[i][1] <= 2]
    keys = [_keys(text[a:b]) for a, b in spans]
    hub: dict[str, int] = {}
    for i in np.flatnonzero(label).tolist():
        for key in keys[i]:
            hub.setdefault(key, i)
    skip, last = [], {}
    for i, mine in enumerate(keys):
        for key in mine:
            before, base_at = last.get(key), hub.get(key, i)
            if before is not None:
                skip.append((before, i))
            if base_at < i and base_at != before or base_at > i + 1:
                skip.append((base_at, i))
            last[key] = i
    x = np.array([_features(text, a, b) for a, b in spans], dtype=np.float32).reshape(-1, WIDTH)
    pairs = [np.array(e, dtype=np.int64).reshape(-1, 2) for e in (chain, skip)]
    return Graph(spans, x, label, *pairs)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


@dataclass
class Weights:
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def neighbour_labels(label: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """How often each label stands at the other end of a node's edges."""
    size = len(KINDS) + 1
    truth, beside = np.eye(size), np.zeros((len(label), size))
    np.add.at(beside, pairs[:, 0], truth[label[pairs[:, 1]]])
    np.add.at(beside, pairs[:, 1], truth[label[pairs[:, 0]]])
    return beside


def fit(x: np.ndarray, label: np.ndarray, neighbours: list[np.ndarray], steps: int = 300) -> Weights:
    """Pseudo-likelihood by gradient steps: each node given its neighbours' labels, by chain and by skip links."""
    size, n = len(KINDS) + 1, max(1, len(label))
    truth = np.eye(size)[label]
    prior = [np.zeros((WIDTH, size)), np.zeros((size, size)), SAME * np.eye(size)]
    parts = [p.copy() for p in prior]
    moment, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    decay = (5e-3, 1e-3, 1e-3)
    for step in range(1, steps + 1):
        off = truth - _softmax(x @ parts[0] + neighbours[0] @ parts[1] + neighbours[1] @ parts[2])
        slopes = [x.T @ off / n, neighbours[0].T @ off / n, neighbours[1].T @ off / n]
        slopes[1:] = [(s + s.T) / 2 for s in slopes[1:]]  # an edge has no direction
        for k in range(3):
            slope = slopes[k] - decay[k] * (parts[k] - prior[k])
            moment[k] = 0.9 * moment[k] + 0.1 * slope
            square[k] = 0.99 * square[k] + 0.01 * slope**2
            parts[k] += 0.05 * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return Weights(*parts)


def marginals(x: np.ndarray, label: np.ndarray, chain: np.ndarray, skip: np.ndarray, weights: Weights) -> np.ndarray:
    """Label probabilities by loopy message passing; nodes with a base label are held."""
    size = len(KINDS) + 1
    own = x @ weights.unary
    own[label > 0] += HELD * np.eye(size)[label[label > 0]]
    pairs = np.concatenate([chain, skip])
    source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
    count = len(pairs)
    back = (np.arange(2 * count) + count) % max(1, 2 * count)
    kind = np.tile(np.repeat([0, 1], [len(chain), len(skip)]), 2)
    potential = np.stack([weights.chain, weights.skip])[kind]
    message = np.zeros((2 * count, size))
    held = (label > 0)[source][:, None]  # what comes in doesn't move a base label
    for _ in range(ROUNDS if count else 0):
        belief = own.copy()
        np.add.at(belief, target, message)
        outgoing = np.where(held, own[source], belief[source] - message[back])[:, :, None] + potential
        top = outgoing.max(axis=1, keepdims=True)
        new = np.log(np.exp(outgoing - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        change = np.abs(new - message).max()
        message = DAMPING * message + (1 - DAMPING) * new
        if change <= TOLERANCE:
            break
    belief = own.copy()
    np.add.at(belief, target, message)
    return _softmax(belief)


def _joined(n: int, skip: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Which nodes are joined by skip links to a node with a base label."""
    root = np.arange(n)
    while len(skip):
        low = np.minimum(root[skip[:, 0]], root[skip[:, 1]])
        new = root.copy()
        np.minimum.at(new, skip[:, 0], low)
        np.minimum.at(new, skip[:, 1], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    based = np.zeros(n, dtype=bool)
    based[root[label > 0]] = True
    return based[root]


def _interesting(raw: list[bytes]) -> list[int]:
    """Texts with a digit or an at sign; no other text has a node or a base span."""
    return [i for i, text in enumerate(raw) if text.translate(None, _PLAIN)]


def _chosen(label: np.ndarray) -> np.ndarray:
    """Up to ``NODES_A_DOC`` nodes from anywhere in a text: of each label in turn the next by hash."""
    by_hash = np.argsort(mix(np.arange(1, len(label) + 1, dtype=np.uint64)), kind="stable")
    turn = np.zeros(len(label), dtype=np.int64)
    for value in np.unique(label):
        mine = by_hash[label[by_hash] == value]
        turn[mine] = np.arange(len(mine))
    return np.sort(by_hash[np.argsort(turn[by_hash], kind="stable")][:NODES_A_DOC])


def training_keys(docs: DataFrame, limit: int = TRAINING_DOCS) -> DataFrame:
    """Hashes of the distinct texts to learn from: the least of all that have nodes, and of each kind's."""

    def run(batches):
        for batch in in_blocks(batches):
            raw, keys = as_bytes(batch.column("text")), batch.column("key").to_pylist()
            kinds, out = [], []
            for i in _interesting(raw):
                text = raw[i].decode()
                if NUMBER.search(text) or AT_WORD.search(text):
                    mine = [-1, *sorted({kind for kind, _, _ in base_spans(text)})]
                    kinds += mine
                    out += [keys[i]] * len(mine)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(out, pa.int64())], names=["kind", "key"])

    found = _keyed(docs).mapInArrow(run, "kind int, key long").distinct()
    share = F.when(F.col("kind") < 0, limit).otherwise(-(-limit // len(KINDS)))
    first = top_rows(found, ["kind"], [F.col("key")], limit, "_rank").filter(F.col("_rank") <= share)
    return first.select("key").distinct()


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).select("text", F.xxhash64("text").alias("key"))


def learn(docs: DataFrame, limit: int = TRAINING_DOCS) -> Weights | None:
    """Weights from a bounded sample of the texts that have nodes; None where no text has a base span."""
    width = 2 * (len(KINDS) + 1)
    wanted = frozenset(row["key"] for row in training_keys(docs, limit).collect())

    def run(batches):
        done = set()  # a task gives one row of equal texts
        for batch in in_blocks(batches):
            rows = []
            for i, key in enumerate(batch.column("key").to_pylist()):
                if key not in wanted or key in done:
                    continue
                done.add(key)
                text = as_bytes(batch.column("text").slice(i, 1))[0].decode()
                g = document_graph(text, base_spans(text))
                at = _chosen(g.label)
                beside = np.concatenate([neighbour_labels(g.label, g.chain), neighbour_labels(g.label, g.skip)], axis=1)
                rows.append((key, g.label[at].astype("<i4").tobytes(), np.concatenate([g.x, beside], axis=1)[at].astype("<f4").tobytes()))
            columns = list(zip(*rows)) if rows else [()] * 3
            kinds = [pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "label", "x"])

    sample = sorted(_keyed(docs).mapInArrow(run, "key long, label binary, x binary").distinct().collect())
    label = np.frombuffer(b"".join(bytes(r["label"]) for r in sample), dtype="<i4").astype(np.int64)
    if not label.any():
        return None
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in sample), dtype="<f4").reshape(-1, WIDTH + width).astype(np.float64)
    return fit(x[:, :WIDTH], label, [x[:, WIDTH : WIDTH + width // 2], x[:, WIDTH + width // 2 :]])


def _together(graphs: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Several documents as one graph without edges between them."""
    shift = np.cumsum([0, *(len(g[1]) for g in graphs)])[:-1]
    edges = [np.concatenate([g[k] + s for g, s in zip(graphs, shift)]) for k in (2, 3)]
    return np.concatenate([g[0] for g in graphs]), np.concatenate([g[1] for g in graphs]), *edges


def find_spans(texts_: list[str], weights: Weights | None) -> list[list[tuple[str, int, int, bool, float]]]:
    """All spans of each text: by kind, then start."""
    based = [base_spans(text) for text in texts_]
    graphs = [document_graph(text, base) for text, base in zip(texts_, based)]
    added: list[list[tuple[int, int, int, float]]] = [[] for _ in texts_]
    if weights is not None and any(g.spans for g in graphs):
        x, label, chain, skip = _together([(g.x, g.label, g.chain, g.skip) for g in graphs])
        p = marginals(x, label, chain, skip, weights)
        best = p[:, 1:].argmax(axis=1)
        sure = (label == 0) & _joined(len(label), skip, label) & (p[np.arange(len(p)), best + 1] >= ADDED)
        owner = np.repeat(np.arange(len(graphs)), [len(g.spans) for g in graphs])
        first = np.searchsorted(owner, owner)
        for node in np.flatnonzero(sure).tolist():
            a, b = graphs[owner[node]].spans[node - first[node]]
            added[owner[node]].append((int(best[node]), a, b, float(p[node, best[node] + 1])))
    out = []
    for base, more in zip(based, added):
        spans = [(k, a, b, True, 1.0) for k, a, b in base] + [(k, a, b, False, q) for k, a, b, q in more]
        out.append([(KINDS[k], *rest) for k, *rest in sorted(spans)])
    return out


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: base spans of every whole text and those the field adds."""
    weights = learn(docs)

    def run(batches):
        for batch in in_blocks(batches):
            raw = as_bytes(batch.column("text"))
            found: list[list] = [[] for _ in raw]
            chosen = _interesting(raw)
            for i, spans in zip(chosen, find_spans([raw[i].decode() for i in chosen], weights)):
                found[i] = [dict(zip(("kind", "start", "end", "base", "probability"), s)) for s in spans]
            kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("probability", pa.float64())])
            columns = [batch.column("doc_id"), pa.array(found, pa.list_(kind))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "spans"])

    return texts(docs).mapInArrow(run, SPANS)
