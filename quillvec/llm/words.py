"""Words, rolling hashes and anchored runs of whole batches of texts, as numpy arrays.

A word is a run of bytes other than space and the five ASCII control characters 9 to 13. All functions work on the
UTF-8 bytes of many texts laid end to end, and nothing crosses from one text to the next. Work arrays are bounded by
``SEGMENT`` bytes of text, however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
#: Low bits of a packed hash that hold the place in the segment.
PLACE_BITS = 24
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_GRAM = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; the usual size is kept, a larger one made when needed."""
    size = max(n, SEGMENT + 1)
    if size == SEGMENT + 1 and size in _POWERS:
        return _POWERS[size]
    tables = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
    if size == SEGMENT + 1:
        _POWERS[size] = tables
    return tables


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all others, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(texts: pa.Array, size: int = SEGMENT) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, after, bytes, offsets)`` for groups of texts of about ``size`` bytes, or one longer text alone.

    A null counts as an empty text.
    """
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    n = len(texts)
    at = np.frombuffer(offsets, np.int64, count=n + 1, offset=texts.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        after = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield first, after, raw[at[first]:at[after]], at[first:after + 1] - at[first]
        first = after


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


class Words:
    """Words of some texts: where each starts and ends, its hash, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, hashes = [], [], []
        for lo, hi in _segments(data, offsets):
            s, e = _borders(data, offsets, lo, hi)
            starts.append(s)
            ends.append(e)
            hashes.append(_word_hashes(data[lo:hi], s - lo, e - lo))
        self.data, self.offsets = data, offsets
        self.starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts long texts where a word ends."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + SEGMENT)
        while hi < n and not SPACE[data[hi]]:
            gap = np.flatnonzero(SPACE[data[hi:hi + SEGMENT]])
            hi = hi + int(gap[0]) if len(gap) else min(n, hi + SEGMENT)
        yield lo, hi
        lo = hi


def _borders(data, offsets, lo, hi) -> tuple[np.ndarray, np.ndarray]:
    inside = ~SPACE[data[lo:hi]]
    edge = offsets[(offsets > lo) & (offsets < hi)] - lo
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[edge] = inside[edge]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    end[edge - 1] = inside[edge - 1]
    return np.flatnonzero(start) + lo, np.flatnonzero(end) + lo + 1


def _word_hashes(data, starts, ends) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:len(data)], out=total[1:])
    length = (ends - starts).astype(np.uint64)
    return mix((total[ends] - total[starts]) * inverse[starts] + length * _GRAM)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` items from each place on; shorter by ``n - 1`` than its input."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = hashes[:len(hashes) - n + 1].copy()
    for j in range(1, n):
        out = out * _GRAM + hashes[j:len(hashes) - n + 1 + j]
    return mix(out)


def byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` bytes from each place on, for ``n`` a power of two."""
    if len(data) < n:
        return np.zeros(0, np.uint64)
    out, step, factor = _BYTE[data], 1, _BASE
    while step < n:
        out = out[:-step] * np.uint64(factor) + out[step:]
        step, factor = step * 2, factor * factor % 2**64
    return mix(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` neighbours from each place on."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchored_runs(gram: np.ndarray, item_ends: np.ndarray, window: int, size: int):
    """Windows of ``window`` items gathered by the gram they share.

    ``gram`` holds the hash of ``size`` items from each place on; ``item_ends`` gives, for each place, the end of its
    text. Each window is filed under its smallest gram, the leftmost of equal ones, so windows of equal content have
    their anchor at the same distance. Returns ``(anchor, first, last)`` of maximal runs of window starts with one
    anchor. Only windows that lie in one text count.
    """
    width = window - size + 1
    empty = np.zeros(0, np.int64)
    if len(gram) < width:
        return empty, empty, empty
    mask = np.uint64((1 << PLACE_BITS) - 1)
    packed = (gram & ~mask) | np.arange(len(gram), dtype=np.uint64)
    anchor = (sliding_min(packed, width) & mask).astype(np.int64)
    at = np.flatnonzero(np.arange(len(anchor)) + window <= item_ends[:len(anchor)])
    if not len(at):
        return empty, empty, empty
    anchor = anchor[at]
    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(at) != 1)) + 1
    head, tail = np.r_[0, cut], np.r_[cut, len(at)] - 1
    return anchor[head], at[head], at[tail]


def overlapping(ends: np.ndarray, window: int, size: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Parts of a long sequence of items that together hold every window once by its start."""
    n, lo = len(ends), 0
    while lo < n:
        hi = min(n, lo + size)
        yield lo, min(n, hi + window - 1)
        lo = hi


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals covered by half-open ones; those that touch become one."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.r_[True, lo[1:] > hi[:-1]]
    return lo[new], hi[np.r_[np.flatnonzero(new)[1:] - 1, len(hi) - 1]]
