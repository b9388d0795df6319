"""Vectorised word and shingle hashing of Arrow string columns, for use inside ``mapInArrow`` tasks.

A batch's UTF-8 bytes are viewed as one numpy array; word bounds, word hashes and shingle hashes
of all its texts are then computed without a Python loop over words.  Memory is bounded by
``chunks``: a chunk holds at most ``max_bytes`` of text, or a single longer text, whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_PLAIN_VALUE = np.arange(1, 257, dtype=np.uint64)       # a byte's value in a hash
_LOWER_VALUE = _PLAIN_VALUE[_LOWER]

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}
_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make):
    """What ``make`` returns, remembered by this worker until another key is asked for.

    Spark's workers go on from stage to stage, so tables that each operator kept for itself would add up.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd uint64 constants for a seed."""
    i = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)
    return mix(i * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POW.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _POW[key] = p
    up, down = _POW["up"], _POW["down"]
    if n <= CHUNK_BYTES + 1 < len(up):          # a single huge text has passed: do not keep its table
        _POW.clear()
        return _powers(n)
    return up, down


def chunks(batch: pa.RecordBatch, column: str, max_bytes: int = CHUNK_BYTES):
    """Slices of a batch with at most ``max_bytes`` of text each, or one longer text; nulls count 0."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    lo, total = 0, 0
    for i in range(n):
        if i > lo and total + sizes[i] > max_bytes:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += int(sizes[i])
    yield batch.slice(lo, n - lo)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null is the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray,
                separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, word_offsets): words ``[^\\x20\\x09-\\x0D]+``; text i owns words word_offsets[i:i+2].

    ``separator`` marks the bytes that part words.
    """
    if len(data) == 0:
        e = np.zeros(0, np.int64)
        return e, e, np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    edge = offsets[:-1][np.diff(offsets) > 0]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    final = offsets[1:][np.diff(offsets) > 0] - 1
    last[final] = inside[final]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of the bytes of each span, A-Z lower-cased first if asked."""
    up, down = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.take(_LOWER_VALUE if lower else _PLAIN_VALUE, data, out=total[1:], mode="clip")
    total[1:] *= up[:len(data)]
    np.cumsum(total, out=total)
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_sets(words: np.ndarray, word_offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; 1 to k-1 words: the whole sequence as one."""
    weight = constants(k, 11)
    n = len(words) - k + 1
    s = np.zeros(0, np.uint64)
    if n > 0:
        s = np.zeros(n, np.uint64)
        for j in range(k):
            s += words[j:j + n] * weight[j]
        s = mix(s)
    out = []
    for a, b in zip(word_offsets[:-1].tolist(), word_offsets[1:].tolist(), strict=True):
        if b - a >= k:
            h = np.sort(s[a:b - k + 1])
            keep = np.empty(len(h), dtype=bool)
            keep[0] = True
            np.not_equal(h[1:], h[:-1], out=keep[1:])
            out.append(h[keep])
        elif b > a:
            short = (words[a:b] * weight[:b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
