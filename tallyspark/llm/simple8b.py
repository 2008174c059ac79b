"""Simple-8b: as many values of equal width as fit into the 60 low bits of a word, the selector above.

Values come in lanes of ``LANE``; a lane starts at a word of its own, whose offset is kept, so lanes
are coded and decoded side by side. A value of over 60 bits is an escape word and then the raw word.
"""

from __future__ import annotations

import numpy as np

LANE = 1024
# Bits of a value and values of a word, by selector 1 to 14; selector 15 escapes.
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = 15

_LIMITS = np.array([1 << b for b in BITS], dtype=np.uint64)
_SMALL = (np.searchsorted(_LIMITS, np.arange(1 << 17, dtype=np.uint64), side="right") + 1).astype(np.int8)
_COUNT_OF = np.array([0, *COUNTS, 1], dtype=np.int64)
_ALL = np.arange(1, ESCAPE + 1)
_ALL_COUNTS = _COUNT_OF[_ALL] - 1
_WIDE = _ALL[6:]  # selectors of eight values and fewer, tried first
_WIDE_COUNTS = _ALL_COUNTS[6:]


def _width(values: np.ndarray) -> np.ndarray:
    if int(values.max()) < len(_SMALL):
        return _SMALL[values]
    return (np.searchsorted(_LIMITS, values, side="right") + 1).astype(np.int8)


def _words(width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and its selector; all lanes take one word at each step."""
    n = len(width)
    lanes = -(-n // LANE)
    room = LANE + COUNTS[0]  # what follows a lane's end never hinders
    padded = np.zeros((lanes, room), dtype=np.int8)
    full = n // LANE
    padded[:full, :LANE] = width[: full * LANE].reshape(full, LANE)
    padded[full:, : n - full * LANE] = width[full * LANE :]
    flat = padded.ravel()
    lane, at = np.arange(lanes), np.zeros(lanes, dtype=np.int64)
    size = np.full(lanes, LANE)
    size[-1] = n - (lanes - 1) * LANE
    near = np.arange(COUNTS[6])
    far = np.arange(COUNTS[0])
    starts, selectors = [], []
    while len(lane):
        begin = lane * room + at
        most = np.maximum.accumulate(flat[begin[:, None] + near], axis=1)
        selector = _WIDE[(most[:, _WIDE_COUNTS] <= _WIDE).argmax(axis=1)]
        small = np.flatnonzero(most[:, -1] < _WIDE[0])  # many small values follow
        if len(small):
            most = np.maximum.accumulate(flat[begin[small, None] + far], axis=1)
            selector[small] = _ALL[(most[:, _ALL_COUNTS] <= _ALL).argmax(axis=1)]
        starts.append(lane * LANE + at)
        selectors.append(selector)
        at = at + _COUNT_OF[selector]
        live = at < size[lane]
        lane, at = lane[live], at[live]
    starts, selectors = np.concatenate(starts), np.concatenate(selectors)
    order = np.argsort(starts, kind="stable")
    return starts[order], selectors[order]


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and the word offset of each lane."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at, chosen = _words(_width(values))  # ids in front of each word, and its selector
    slot = np.cumsum(1 + (chosen == ESCAPE)) - 1  # an escape's own word comes before its raw word
    words = np.zeros(int(slot[-1]) + 1, dtype=np.uint64)
    for k in np.unique(chosen):
        mine = chosen == k
        if k == ESCAPE:
            words[slot[mine] - 1] = np.uint64(ESCAPE << 60)
            words[slot[mine]] = values[at[mine]]
            continue
        start, packed = at[mine], np.full(int(mine.sum()), int(k) << 60, dtype=np.uint64)
        for j in range(COUNTS[k - 1]):
            inside = start + j < np.minimum((start // LANE + 1) * LANE, n)
            value = np.where(inside, values[np.minimum(start + j, n - 1)], 0).astype(np.uint64)
            packed |= value << np.uint64(j * BITS[k - 1])
        words[slot[mine]] = packed
    first = np.searchsorted(at, np.arange(0, n, LANE))
    return words, slot[first] - (chosen[first] == ESCAPE)


def _heads(words: np.ndarray) -> np.ndarray:
    """Which words hold a selector; the others are raw values after an escape."""
    head = np.ones(len(words), dtype=bool)
    raw = -1
    for i in np.flatnonzero(words >> np.uint64(60) == ESCAPE).tolist():
        if i != raw:
            raw = i + 1
            head[raw] = False
    return head


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values behind ``encode``'s words and lane offsets."""
    out = np.zeros(n, dtype=np.uint64)
    if not n:
        return out
    at = np.flatnonzero(_heads(words))
    selector = (words[at] >> np.uint64(60)).astype(np.int64)
    count = _COUNT_OF[selector]
    lane = np.searchsorted(offsets, at, side="right") - 1
    total = np.cumsum(count) - count
    first = np.searchsorted(at, offsets)
    start = lane * LANE + total - total[first[lane]]
    lane_end = np.minimum((lane + 1) * LANE, n)
    for k in np.unique(selector):
        mine = selector == k
        begin = start[mine]
        if k == ESCAPE:
            out[begin] = words[at[mine] + 1]
            continue
        low = np.uint64((1 << BITS[k - 1]) - 1)
        word, stop = words[at[mine]], lane_end[mine]
        for j in range(COUNTS[k - 1]):
            inside = begin + j < stop
            out[begin[inside] + j] = (word[inside] >> np.uint64(j * BITS[k - 1])) & low
    return out
