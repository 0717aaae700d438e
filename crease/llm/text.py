"""Vectorised word and shingle hashing over Arrow text columns.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z folded to
a-z.  A word's hash is a polynomial over its bytes modulo 2**64 with one
pseudo-random factor per byte value, finished by a mixing step; a shingle's hash
combines the hashes of its words.  Work memory is bounded by ``SEGMENT`` bytes
at a time, whatever the batch or the text length.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


_KEPT: list = []


def keep_in_worker(key, make):
    """``make()``, kept in this Python worker for the tasks that follow with the same
    key.  A worker keeps one such object: another operator's replaces it."""
    if not _KEPT or _KEPT[0] != key:
        forget_in_worker()
        _KEPT[:] = [key, make()]
    return _KEPT[1]


def forget_in_worker() -> None:
    """Drop what an earlier operator's tasks kept in this Python worker, and hand its
    memory back; operators that keep nothing call this when a task starts."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
        if trim is not None:
            trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (the public splitmix64 step) on an unsigned array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    byte = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)
    byte[65:91] = byte[97:123]                    # A-Z as a-z
    byte[32] = 0
    byte[9:14] = 0                                # white space adds nothing
    power = np.empty(SEGMENT + 1, dtype=np.uint64)
    inverse = np.empty(SEGMENT + 1, dtype=np.uint64)
    power[0] = inverse[0] = 1
    back = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        power[1:] = np.multiply.accumulate(np.full(SEGMENT, _BASE, dtype=np.uint64))
        inverse[1:] = np.multiply.accumulate(np.full(SEGMENT, back, dtype=np.uint64))
    return byte, power, inverse


_TABLES: tuple | None = None
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    arr = column.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, offsets


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end positions of the words of consecutive texts."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    solid = ~_SPACE[raw[lo:hi]]
    if not solid.any():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cuts = offsets[1:-1] - lo                     # a new text begins here
    cuts = cuts[(cuts > 0) & (cuts < hi - lo)]
    first[cuts] = solid[cuts]
    last[cuts - 1] = solid[cuts - 1]
    return np.flatnonzero(first) + lo, np.flatnonzero(last) + lo + 1


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words of each text)."""
    starts, ends = word_bounds(raw, offsets)
    return hash_words(raw, starts, ends), np.diff(np.searchsorted(starts, offsets))


def hash_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every word that ``word_bounds`` found."""
    global _TABLES
    if _TABLES is None:
        _TABLES = _tables()
    byte, power, inverse = _TABLES
    out = np.empty(len(starts), dtype=np.uint64)
    k = 0
    while k < len(starts):
        base = starts[k]
        stop = int(np.searchsorted(ends, base + SEGMENT, side="right"))
        if stop == k:                             # one word longer than a segment
            word = raw[base:ends[k]].tobytes().translate(_FOLD)
            out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            k += 1
            continue
        piece = byte[raw[base:ends[stop - 1]]]
        piece *= power[:len(piece)]
        at = starts[k:stop] - base
        out[k:stop] = np.add.reduceat(piece, at) * inverse[at]
        k = stop
    return mix(out)


def _combine(hashes: np.ndarray, span: int, n: int) -> np.ndarray:
    """Hash of each of the ``n`` runs of ``span`` words."""
    acc = np.full(n, _U(span * 0x632BE59BD9B4E019 & (1 << 64) - 1), dtype=np.uint64)
    for j in range(span):
        acc += hashes[j:n + j] * _U((0xC2B2AE3D27D4EB4F * (2 * j + 1) | 1) & (1 << 64) - 1)
        acc = mix(acc)
    return acc


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    keep = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a string column, in order.

    Fewer than ``width`` words make one shingle of the whole sequence; no words
    (or a null) make none.
    """
    raw, offsets = text_buffer(column)
    at = 0
    while at < len(offsets) - 1:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + 4 * SEGMENT, side="right")) - 1)
        hashes, counts = word_hashes(raw, offsets[at:stop + 1])
        runs = _combine(hashes, width, max(0, len(hashes) - width + 1))
        lo = 0
        for n in counts.tolist():
            if n >= width:
                yield _distinct(runs[lo:lo + n - width + 1])
            else:
                yield _combine(hashes[lo:lo + n], n, 1) if n else hashes[:0]
            lo += n
        at = stop


def pieces(batch: pa.RecordBatch, max_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``max_bytes`` of ``column`` (at least a row)."""
    offsets = text_buffer(batch.column(batch.schema.get_field_index(column)))[1]
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop
