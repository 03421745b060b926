"""Words and shingles of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Texts are worked on in slices of about so many bytes; a longer text is a slice by itself.
SLICE_BYTES = 1_000_000

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 0x20, _BYTES).astype(np.uint8)
# Byte classes that cut texts into words.
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
ALPHANUMERIC = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39))
    | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
    | (_BYTES >= 0x80)
)

_RADIX = 0x9E3779B97F4A7C15
_RADIX_INVERSE = pow(_RADIX, -1, 2**64)


_VALUES = LOWER.astype(np.uint64) + np.uint64(1)
_kept_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The radix and its inverse to the powers 0 to at least n - 1; kept for whole slices."""
    if n <= SLICE_BYTES and _kept_powers:
        return _kept_powers[0]
    both = []
    for radix in (_RADIX, _RADIX_INVERSE):
        powers = np.full(max(n, SLICE_BYTES), radix, np.uint64)
        powers[0] = 1
        both.append(np.multiply.accumulate(powers, out=powers))
    if n <= SLICE_BYTES:
        _kept_powers.append(tuple(both))
    return tuple(both)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings, and the offsets at which they begin and end. Null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(work: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """``work`` on a group's rows, after which freed memory goes back."""

    def tidied(*tables: pa.Table) -> pa.Table:
        try:
            return work(*tables)
        finally:
            give_back()

    # Spark looks at the number of arguments.
    return (lambda one: tidied(one)) if work.__code__.co_argcount == 1 else (lambda a, b: tidied(a, b))


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of texts with their bytes and their offsets in these."""
    data, offsets = utf8(column)
    for first, last in slices(offsets):
        yield first, last, data[offsets[first] : offsets[last]], (
            offsets[first : last + 1] - offsets[first]
        )
    give_back()


class Words(NamedTuple):
    """All words of some texts in order: their hashes, and where each text's words begin."""

    hashes: np.ndarray
    first: np.ndarray  # one more than there are texts
    starts: np.ndarray  # byte positions
    ends: np.ndarray

    def texts(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> Words:
    """The maximal runs of bytes of the class ``kept``, A-Z lower-cased, with 64-bit hashes."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = kept[data]
    begins = inside[1:-1] & ~inside[:-2]
    finishes = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] |= inside[1:-1][cuts]
    finishes[cuts - 1] |= inside[1:-1][cuts - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    powers, inverses = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.multiply(powers[:n], _VALUES[data], out=sums[1:])
    np.cumsum(sums, out=sums)
    hashes = (sums[ends] - sums[starts]) * inverses[starts] if len(starts) else sums[:0]
    hashes = mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends)


def shingle_sets(found: Words, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words.

    A text of fewer words has one hash, of all of them; a text without words has none.
    """
    h, n = found.hashes, len(found.hashes)
    runs = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size):
        factor = np.uint64(pow(_RADIX, k + 1, 2**64) ^ 0x5851F42D4C957F2D | 1)
        runs += h[k : k + len(runs)] * factor
    runs = mix(runs)
    for first, last in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if last - first >= size:
            own = np.sort(runs[first : last - size + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif last > first:
            whole = np.uint64(last - first)
            with np.errstate(over="ignore"):
                for x in h[first:last]:
                    whole = whole * np.uint64(_RADIX) + x
            yield mix(np.array([whole], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
