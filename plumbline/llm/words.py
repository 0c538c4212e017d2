"""Words of whole texts as 64-bit hashes, a batch at a time.

A word is a maximal run of bytes other than space and TAB to CR, with A to Z lowered. Its
hash depends on its bytes alone, so it is the same in every task and at every place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Bytes of text that are hashed at a time; a longer text is taken whole.
SLICE_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_power = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_power[0]) < n:
        m = max(n, SLICE_BYTES + 1024)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for i, b in ((0, _BASE), (1, inverse)):
            steps = np.full(m, b, dtype=np.uint64)
            steps[0] = 1
            _power[i] = np.cumprod(steps)
    return _power[0][:n], _power[1][:n]


def spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end) of the words of texts laid end to end, and how many words each text has.

    ``data`` holds UTF-8 bytes; text i is data[starts[i]:starts[i + 1]]. Ends are exclusive.
    """
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(starts) - 1, dtype=np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[starts] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.diff(np.searchsorted(begin, starts)).astype(np.int64)


def hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts laid end to end, and how many words each text has."""
    begin, end, counts = spans(data, starts)
    if not len(begin):
        return np.zeros(0, dtype=np.uint64), counts
    out = np.empty(len(begin), dtype=np.uint64)
    # Words are taken in runs of bounded length, so a huge text needs no huge arrays.
    i = 0
    while i < len(begin):
        low = begin[i]
        j = max(i + 1, int(np.searchsorted(end, low + 2 * SLICE_BYTES, side="right")))
        part = data[low:end[j - 1]]
        power, inverse = _powers(len(part))
        total = np.cumsum(_VALUE[_LOWER[part]] * power)
        at, to = begin[i:j] - low, end[i:j] - low
        before = np.where(at > 0, total[at - 1], np.uint64(0))
        out[i:j] = (total[to - 1] - before) * inverse[at]
        i = j
    return mix(out), counts


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, starts) of pieces of a batch of about SLICE_BYTES.

    Null texts count as empty.
    """
    texts = batch.column(column)
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_large_string(texts.type):
        width = np.int64
    else:
        texts, width = texts.cast(pa.string()), np.int32
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(ends, ends[row] + SLICE_BYTES, side="right")) - 1)
        to = min(to, len(texts))
        yield row, to, raw[ends[row]:ends[to]], ends[row:to + 1] - ends[row]
        row = to


_STEPS = mix(np.arange(1, 17, dtype=np.uint64)) | np.uint64(1)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; the whole sequence if it is shorter.

    No words give none. The length is part of the hash, so a short whole sequence never
    equals a full run.
    """
    n = len(words)
    if not n:
        return words
    k = min(size, n)
    out = np.full(n - k + 1, np.uint64(k), dtype=np.uint64)
    for i in range(k):
        out += words[i:n - k + 1 + i] * _STEPS[i]
    return mix(out)
