"""Vectorised reading of texts inside Spark tasks.

A text column reaches a task as Arrow batches. :func:`segments` hands it out as numpy
byte arrays of bounded size (a single longer text is one segment), so that no step needs
Python objects per word, and memory per task doesn't depend on the batch size Spark chose.

Word hashes are 64-bit polynomial hashes of a word's bytes with fixed random byte values;
they are the same in every task and run.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT_BYTES = 1 << 18

_rng = np.random.default_rng(20240607)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd: it has an inverse modulo 2**64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing (a letter beyond ASCII is bytes >= 0x80)
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: bytes of ``[^\x20\x09-\x0D]``
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False


#: what other modules keep in a worker between tasks of their own, as functions that drop it
KEPT: list = []


def lean(run, keep: bool = False):
    """A task's function that hands its memory back when the task is done: a Python worker lives on for other
    operators' tasks, and what it keeps adds up beside the executor's JVM. ``keep``: but for what KEPT drops."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release(keep)

    return wrapped


def release(keep: bool = False) -> None:
    _powers.cache_clear()
    for drop in [] if keep else KEPT:
        drop()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library can
        ctypes.CDLL(None).malloc_trim(0)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(2 * SEGMENT_BYTES, 1 << int(n).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every bit of 64-bit values over all bits."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at.astype(np.int64)


def segments(column: pa.Array, limit: int = SEGMENT_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of at most ``limit`` bytes, one row at least."""
    if not len(column):
        return
    data, at = text_bytes(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def words(data: np.ndarray, at: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash, document) of every word; a word ends with its document."""
    low = _LOWER[data]
    mask = in_word[low]
    first = np.zeros(len(data) + 1, bool)
    first[at] = True
    before = np.concatenate(([False], mask[:-1])) if len(mask) else mask
    after = np.concatenate((mask[1:], [False])) if len(mask) else mask
    start = np.flatnonzero(mask & (~before | first[:-1]))
    end = np.flatnonzero(mask & (~after | first[1:])) + 1
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_VALUES[low] * up[: len(data)], out=total[1:])
        hashes = mix((total[end] - total[start]) * down[start])
    return start, end, hashes, np.searchsorted(at, start, "right") - 1


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each run of ``width`` words; the whole sequence where a document has fewer, but not none."""
    count = np.bincount(doc, minlength=n_docs) if len(doc) else np.zeros(n_docs, np.int64)
    first = np.concatenate(([0], np.cumsum(count)))
    out = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = mix(out * np.uint64(31) + hashes[j : j + len(out)])
    whole = doc[: len(out)] == doc[width - 1 : width - 1 + len(out)] if len(out) else np.zeros(0, bool)
    value, owner = [out[whole]], [doc[: len(out)][whole]]
    for k in range(1, width):
        short = np.flatnonzero(count == k)
        if len(short):
            h = np.full(len(short), k, np.uint64)
            with np.errstate(over="ignore"):
                for j in range(k):
                    h = mix(h * np.uint64(37) + hashes[first[short] + j])
            value.append(h)
            owner.append(short)
    return np.concatenate(value), np.concatenate(owner)
