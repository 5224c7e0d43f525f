"""Arrow text columns in bounded blocks, and the words of a block as numpy arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D.  UTF-8 text is
handled as bytes throughout, so a block costs a few arrays of its own size.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(20240229)
#: A random 64-bit value per byte, and an odd multiplier: the polynomial hash of a word.
BYTE_VALUE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)


def give_back() -> None:
    """Return freed memory of Arrow and of the C library to the system; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim  # noqa: B018  glibc only
except (OSError, AttributeError):
    _LIBC = None


def giving_back(run: Callable) -> Callable:
    """``run`` for mapInArrow, giving memory back at the end of a partition."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (wrapping arithmetic is meant)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """BASE ** 0 .. n-1 modulo 2**64."""
    out = np.full(n, BASE, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def text_slices(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each; a row is never cut."""
    n = len(column)
    if not n:
        return
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64))
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit, side="right")))
        yield at, end
        at = end


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the offsets of each; null counts as empty."""
    column = pc.fill_null(column, "")
    column = pa.concat_arrays([column])  # offsets from zero
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each text (one more at the end)."""
    word = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a text ends or begins before this byte
    edge[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(s, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash per word, worked on some words at a time to bound the memory."""
    out = np.empty(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    lengths = ends - starts
    power = powers(int(lengths.max()))
    at = 0
    total = np.concatenate([[0], np.cumsum(lengths)])
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(total, total[at] + (step << 2), side="right")) - 1)
        n = lengths[at:to]
        first = total[at:to] - total[at]
        within = np.arange(total[to] - total[at]) - np.repeat(first, n)
        values = BYTE_VALUE[data[within + np.repeat(starts[at:to], n)]] * power[within]
        out[at:to] = np.add.reduceat(values, first)
        at = to
    return mix(out + lengths.astype(np.uint64))


def gram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a text, and the number of the first run of each text.

    A text with fewer words, but at least one, has its whole sequence as its only run.
    """
    counts = np.diff(first)
    runs = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(runs)])
    text = np.repeat(np.arange(len(counts)), runs)
    at = first[:-1][text] + np.arange(begin[-1]) - begin[:-1][text]
    length = np.minimum(counts, n)[text]
    acc = length.astype(np.uint64)
    for k in range(n):
        has = k < length
        value = words[np.where(has, at + k, 0)] if len(words) else np.zeros(len(at), dtype=np.uint64)
        acc = mix(acc * BASE + np.where(has, value, np.uint64(0)))
    return acc, begin
