"""Whole columns of text as arrays of numbers: words, their hashes, hashes of runs of words.

Everything works on the UTF-8 bytes of many texts laid end to end, so that a batch is
some dozen numpy calls however many words it has.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is worked on alone and whole.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_WORD_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


#: The longest powers of each base so far; shorter ones are their beginnings.
_held: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = _held.get(int(base))
    if powers is None or len(powers) <= n:
        powers = np.full(1 << int(n).bit_length(), base, np.uint64)
        powers[0] = 1
        _held[int(base)] = np.cumprod(powers, out=powers)
    return powers[: n + 1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@functools.cache
def _trim():
    # Only the GNU C library has it; others give back by themselves.
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on, and its next task may be of another kind."""
    _held.clear()
    pa.default_memory_pool().release_unused()
    _trim()(0)


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(end, n)
        at = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all else unchanged."""
    return data + ((data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words `[^\\x20\\x09-\\x0D]+`, and each text's first word.

    Words never cross from one text into the next.
    """
    n = len(data)
    inside = ~((data == 32) | ((data - np.uint8(9)) < 5))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _powers(_BASE, n)[:n], out=sums[1:])
    value = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, n)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def run_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every run of `size` words that starts at a word and stays in its text.

    Gives the starting words (numbers over the chunk) and the hashes.
    """
    n = len(hashes)
    counts = np.maximum(np.diff(first) - size + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(total) + np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _powers(_WORD_BASE, n)[:n], out=sums[1:])
    value = (sums[at + size] - sums[at]) * _powers(_WORD_INVERSE, n)[at]
    return at, mix(value + np.uint64(size))


def text_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each text's whole sequence of words."""
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _powers(_WORD_BASE, n)[:n], out=sums[1:])
    size = np.diff(first).astype(np.uint64)
    value = (sums[first[1:]] - sums[first[:-1]]) * _powers(_WORD_INVERSE, n)[first[:-1]]
    return mix(value + size)
