"""Word and shingle hashes of whole batches of texts, in numpy.

A batch's UTF-8 bytes are one array.  Words are runs of bytes other than
0x20 and 0x09-0x0D.  A word's hash is a polynomial of its bytes modulo 2^64,
taken from a running sum over the batch, with its length mixed in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
#: Odd base of the byte polynomial, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of a batch handled at once.
BLOCK = 1 << 19
_POWERS: dict[str, np.ndarray] = {}

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_codes() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_CODES = _byte_codes()


def _powers(base: int, n: int, name: str) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        out = np.empty(max(n, 1), np.uint64)
        out[0] = 1
        k, p = 1, base
        while k < len(out):  # doubling: out[k:2k] = out[:k] * base^k
            m = min(k, len(out) - k)
            out[k:k + m] = out[:m] * np.uint64(p)
            k, p = 2 * k, p * p & _MASK
        _POWERS[name] = have = out
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; NULLs are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return data[first:int(offsets[-1]) if len(offsets) else 0], offsets - first


def _word_block(data: np.ndarray, lower: bool, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if lower:
        data = _LOWER[data]
    space = gaps[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    bounds = np.concatenate(([0], edge, [len(data)])) if len(data) else np.zeros(1, np.int64)
    if len(data) and space[0]:
        bounds = bounds[1:]
    if len(bounds) % 2:
        bounds = bounds[:-1]
    start, end = bounds[0::2], bounds[1::2]
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_CODES[data] * _powers(_BASE, len(data), "up"), out=sums[1:])
    back = _powers(_INVERSE, len(data) + 1, "down")
    h = (sums[end] - sums[start]) * back[start]
    return start, mix64(h ^ ((end - start).astype(np.uint64) << np.uint64(40)))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False,
          gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and each text's first word
    (len(texts) + 1 entries).  ``lower`` folds A-Z; ``gaps`` says which bytes
    (the blank is one) stand between words."""
    hashes, counts, k = [], [], 0
    n = len(offsets) - 1
    while k < n:
        # texts of about BLOCK bytes; a longer one is a block of its own
        e = max(k + 1, int(np.searchsorted(offsets, offsets[k] + BLOCK, "right")) - 1)
        # separators between the texts keep words apart
        lo, hi = int(offsets[k]), int(offsets[e])
        at = offsets[k:e + 1] - lo
        joined = np.insert(data[lo:hi], at[1:-1], 0x20)
        begin = at + np.arange(e - k + 1)
        begin[-1] -= 1 if e - k else 0
        start, h = _word_block(joined, lower, gaps)
        hashes.append(h)
        cut = np.searchsorted(start, begin[:-1], "left")
        counts.append(np.diff(np.concatenate((cut, [len(h)]))))
        k = e
    total = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1, np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), total.astype(np.int64)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, in order, and each text's
    first one.  A text of fewer than k words (but some) has one shingle, its
    whole word sequence; a text without words has none."""
    n = np.diff(first)
    m = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    begin = np.concatenate(([0], np.cumsum(m))).astype(np.int64)
    text = np.repeat(np.arange(len(n)), m)
    at = np.arange(begin[-1]) - begin[text] + first[:-1][text]
    left = np.minimum(first[1:][text] - at, k)
    out = np.full(len(at), 0x51ED270B, np.uint64)
    for i in range(k):
        on = left > i
        take = hashes[np.minimum(at + i, max(len(hashes) - 1, 0))] if len(hashes) else out
        out = np.where(on, mix64(out * np.uint64(0x9DDFEA08EB382D69) + take), out)
    return mix64(out ^ left.astype(np.uint64)), begin


def sort_slices(values: np.ndarray, begin: np.ndarray) -> None:
    """Sorts each text's values in place."""
    at = begin.tolist()
    for a, b in zip(at, at[1:]):
        if b - a > 1:
            values[a:b].sort()


def distinct(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text, its distinct values in ascending order."""
    v = values.copy()
    sort_slices(v, begin)
    keep = np.ones(len(v), bool)
    keep[1:] = v[1:] != v[:-1]
    some = begin[:-1][begin[:-1] < len(v)]
    keep[some] = True
    return v[keep], np.concatenate(([0], np.cumsum(keep)))[begin].astype(np.int64)
