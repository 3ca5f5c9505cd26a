"""Numpy views of the text column of an Arrow batch."""

from __future__ import annotations

import ctypes
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: fixed odd multipliers of the hashes below
BASE = 0x9E3779B97F4A7C15 | 1
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)
_M = (1 << 64) - 1


def tidy(run):
    """A mapInArrow function that gives freed memory back when its task ends:
    Python workers live on and are reused, next to the executor's heap."""
    @wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
            if trim is not None:
                trim(0)
    return task


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n+1 offsets of its rows (null: empty)."""
    data = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], dtype=np.int64)[data.offset:data.offset + len(data) + 1]
    raw = data.buffers()[2]
    body = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return body[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, size: int = 1 << 20):
    """Parts of a batch whose values in ``column`` take about ``size`` bytes."""
    data = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(batch):
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(MIX[0])
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(MIX[2]))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for b in (BASE, inverse):
        p = np.full(n, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64, at least n of each."""
    size = 1 << max(16, (n - 1).bit_length())
    up, down = _powers(size)
    return up, down


def prefix_hash(body: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of value(byte j) * BASE^j over j < i, modulo 2^64."""
    up, _ = powers(len(body) + 1)
    out = np.zeros(len(body) + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[body] * up[:len(body)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of bytes [start, end): equal strings hash equally wherever they are."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start]
               + (end - start).astype(np.uint64) * np.uint64(MIX[3]))


def words(body: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: np.ndarray,
          piece: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of a batch, in text order.

    ``lower`` maps bytes first; ``is_word`` says which bytes make words.  About
    ``piece`` bytes are hashed at once; a piece ends at a row's end or before a
    byte that is no part of a word.
    """
    hashes, rows = [], []
    n, at = len(body), 0
    while at < n:
        stop = min(n, at + piece)
        if stop < n:
            end = int(offsets[np.searchsorted(offsets, stop, "left")])
            free = np.flatnonzero(~is_word[lower[body[stop:end]]])
            stop = stop + int(free[0]) if len(free) else end
        text = lower[body[at:stop]]
        inside = is_word[text]
        edge = offsets[(offsets > at) & (offsets < stop)] - at
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[edge] = inside[edge]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[edge - 1] = inside[edge - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes.append(range_hash(prefix_hash(text), start, end))
        rows.append(np.searchsorted(offsets, start + at, "right") - 1)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(rows)


#: A-Z to a-z, every other byte unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def coded_words(text: pa.Array, classes: np.ndarray, gaps: bytes):
    """(words, start, body, ends) of a string column: ``classes`` maps its bytes
    to ``body``, bytes of ``gaps`` then lie between words; every word of every
    row in order, dictionary-encoded, with its start in ``body``."""
    body, ends = flat(text)
    body = classes[body]
    inside = np.ones(len(body), bool)
    for gap in gaps:
        inside &= body != gap
    edge = ends[ends < len(body)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[edge] = inside[edge]
    before = ends[ends > 0] - 1
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[before] = inside[before]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(body[inside]))
    return words.dictionary_encode(), start, body, ends
