"""Vectorised helpers over the UTF-8 buffer of an Arrow text column.

Words are ``[^\\x20\\x09-\\x0D]+``.  Words, lines and word windows are known by
64-bit hashes: a polynomial hash modulo 2**64 over a random value per byte,
passed through an avalanche mix.  All functions work on one Arrow batch
inside a task; nothing here touches Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(20240917)
BYTE_VALUE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * U64(2) + U64(1)
_fold = np.arange(256)
_fold[65:91] += 32
BYTE_VALUE_LOWER = BYTE_VALUE[_fold]
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (a fresh array)."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, U64(base), dtype=np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def buffer_of(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null counts as empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.fill_null("").cast(pa.large_string())
    _, offsets, data = arr.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = int(offs[0]) if len(offs) else 0
    last = int(offs[-1]) if len(offs) else 0
    return raw[first:last], offs - first


def slices(offs: np.ndarray, max_bytes: int = 4 << 20):
    """Row ranges of at most ``max_bytes`` of text each (a longer single text
    is a range of its own, never cut)."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def text_slices(arr, max_bytes: int = 4 << 20):
    """(lo, hi, bytes, offsets) of row ranges of a text column."""
    buf, offs = buffer_of(arr)
    for lo, hi in slices(offs, max_bytes):
        yield lo, hi, buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]


def row_of(offs: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return np.searchsorted(offs, pos, side="right") - 1


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross a row border."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~WHITE[buf]
    start, end = ink.copy(), ink.copy()
    start[1:] &= ~ink[:-1]
    end[:-1] &= ~ink[1:]
    full = offs[:-1][offs[1:] > offs[:-1]]
    start[full] = ink[full]
    last = offs[1:][offs[1:] > offs[:-1]] - 1
    end[last] = ink[last]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, row_of(offs, s)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of every span of bytes (A-Z as a-z when ``lower``)."""
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((BYTE_VALUE_LOWER if lower else BYTE_VALUE)[buf] * up[:len(buf)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def windows(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every ``k``-word window inside a row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(row[:n] == row[k - 1:])
    acc = np.full(len(first), U64(0x243F6A8885A308D3 + k), dtype=np.uint64)
    for j in range(k):
        acc = (acc ^ h[first + j]) * U64(0x9FB21C651E98DF25)
        acc ^= acc >> U64(32)
    return mix(acc), first


def per_row(flag: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of a per-byte flag or count for every row."""
    total = np.zeros(len(flag) + 1, dtype=np.int64)
    np.cumsum(flag, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def repeated(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items (row, hash): whether the hash occurs again in its row, and
    whether the item is not the first of its kind there (item order = order
    in the text)."""
    order = np.lexsort((np.arange(len(h)), h, row))
    r, x = row[order], h[order]
    same = np.zeros(len(h), dtype=bool)
    if len(h) > 1:
        same[1:] = (r[1:] == r[:-1]) & (x[1:] == x[:-1])
    again = same.copy()
    if len(h) > 1:
        again[:-1] |= same[1:]
    out_again, out_later = np.empty(len(h), bool), np.empty(len(h), bool)
    out_again[order], out_later[order] = again, same
    return out_again, out_later


def group_counts(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, count) of the distinct pairs, sorted."""
    order = np.lexsort((key, row))
    r, k = row[order], key[order]
    if not len(r):
        return r, k, np.zeros(0, np.int64)
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    return r[at], k[at], np.diff(np.append(at, len(r)))
