"""Words, spans and hashes of whole Arrow columns of text, without a Python loop over words.

Texts stay UTF-8 bytes in the column's own buffer. A word is a run of bytes outside the six ASCII
white-space bytes, which no multi-byte character contains. Hashes are polynomial in the bytes
(differences of prefix sums), then mixed; they depend on the bytes alone, never on place or process.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes worked on at once: bounds memory; a longer text is worked on by itself.
CHUNK_BYTES = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    kept = _powers.get(int(base))
    if kept is None or len(kept) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        kept = np.full(size, base, np.uint64)
        kept[0] = 1
        kept = np.multiply.accumulate(kept)
        if size <= 4 * CHUNK_BYTES:
            _powers[int(base)] = kept
    return kept[:n]


class Texts(NamedTuple):
    """Some rows of a column: ``data`` holds their bytes, row i at ``ends[i] - sizes[i]``."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column cut into runs of rows of at most ``limit`` bytes, or one row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        low = offsets[at]
        yield Texts(at, data[low:offsets[to]], offsets[at:to] - low, offsets[at + 1:to + 1] - low)
        at = to


class Spans(NamedTuple):
    """Byte spans in a chunk and the row of each; ``counts`` has one number per row."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray

    def offsets(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.counts)))


def _spans(apart: np.ndarray, texts: Texts) -> Spans:
    """Runs of bytes that are not apart, never across rows."""
    inside = ~apart
    begin = inside.copy()
    begin[1:] &= apart[:-1]
    first = texts.starts[texts.starts < texts.ends]
    begin[first] = inside[first]
    stop = np.zeros(len(apart) + 1, bool)
    stop[1:] = inside
    stop[1:-1] &= apart[1:]
    last = texts.ends[texts.starts < texts.ends]
    stop[last] = inside[last - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop)
    row = np.searchsorted(texts.ends, start, "right")
    return Spans(row, start, end, np.bincount(row, minlength=len(texts)))


def words(texts: Texts) -> Spans:
    return _spans(SPACE[texts.data], texts)


def lines(texts: Texts) -> Spans:
    """Parts between line feeds that are not empty."""
    return _spans(texts.data == 0x0A, texts)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    back = powers(_INVERSE, len(data) + 1)
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def range_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each run of hashes."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_BASE, len(hashes)), out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(_INVERSE, len(hashes) + 1)[start] + (end - start).astype(np.uint64))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive hashes, by place of the first."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _BASE
        out += hashes[k:k + n]
    return mix(out)


def whole(counts: np.ndarray, row: np.ndarray, size: int) -> np.ndarray:
    """Which places, one per word, begin a run of ``size`` words inside their row."""
    ends = np.cumsum(counts)
    return np.arange(len(row)) + size <= ends[row]


def covered(begins: np.ndarray, size: int) -> np.ndarray:
    """Which words lie in a run of ``size`` words that begins at a marked word."""
    steps = np.zeros(len(begins) + size, np.int32)
    at = np.flatnonzero(begins)
    steps[at] += 1
    steps[at + size] -= 1
    return np.cumsum(steps)[:len(begins)] > 0


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
