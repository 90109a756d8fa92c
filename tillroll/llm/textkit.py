"""Vectorised text helpers used inside Arrow tasks.

Texts are handled as the UTF-8 bytes of a whole Arrow column: one byte array
and row offsets. Everything works on slices of rows of a bounded total size;
a single row larger than the bound is a slice of its own, so a task holds a
small multiple of its longest text and never a whole partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64

# The byte classes of the two word definitions.
# [^\x20\x09-\x0D]+
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing A-Z)
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[0x00:0x30] = True
NON_ALNUM[0x3A:0x61] = True
NON_ALNUM[0x7B:0x80] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

SLICE_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(data, offsets)`` of a string or binary Arrow array; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if large else np.int32)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (or one row)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


class _Powers:
    """Powers of the hash base and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def upto(self, n: int) -> None:
        if n > len(self.up):
            size = 1 << max(16, int(n - 1).bit_length())
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                factors = np.full(size, base, U64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, in place: every output bit depends on every input bit."""
    h ^= h >> U64(33)
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def prefix_sums(values: np.ndarray) -> np.ndarray:
    n = len(values)
    _POWERS.upto(n + 1)
    out = np.zeros(n + 1, U64)
    np.cumsum((values.astype(U64) + U64(1)) * _POWERS.up[:n], out=out[1:])
    return out


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:end]`` for every span."""
    sums = prefix_sums(values)
    return mix((sums[ends] - sums[starts]) * _POWERS.down[starts])


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of every run of ``k`` consecutive values."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    sums = prefix_sums(values)
    return mix((sums[k:] - sums[:-k]) * _POWERS.down[:n])


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: byte spans of the words of all rows, and the
    index of each row's first word (one entry more than rows). ``offsets`` are
    relative to ``data``; no word crosses a row."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    word = ~separators[data]
    edge = np.empty(n + 1, bool)
    edge[0], edge[n] = word[0], word[-1]
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    inner = offsets[(offsets > 0) & (offsets < n)]
    joint = inner[word[inner] & word[inner - 1]]  # a word on both sides of a row boundary
    edge[joint] = True
    marks = np.flatnonzero(edge)
    if len(joint):  # such a boundary ends one word and begins the next
        marks = np.sort(np.concatenate([marks, np.unique(joint)]))
    starts, ends = marks[0::2], marks[1::2]
    return starts, ends, np.searchsorted(starts, offsets)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return out if span == width else np.minimum(out[:n], out[width - span : width - span + n])


_PLACE_BITS = 26
_PLACE = U64((1 << _PLACE_BITS) - 1)
_BLOCK = 1 << 16


def window_runs(grams: np.ndarray, row_ends: np.ndarray, row_of: np.ndarray | None, window: int, k: int):
    """Minimiser runs of all windows of ``window`` symbols.

    ``grams[i]`` hashes symbols ``i .. i+k-1``. A window's minimiser is the
    leftmost least gram inside it, which depends on the window's content only:
    equal windows have equal minimisers at equal places. Consecutive windows
    with the same minimiser form a run. ``row_ends[r]`` is the end of row
    ``r``'s symbols (ascending), so windows that would cross it are left out.
    Returns arrays ``(first window, last window, minimiser place)``.
    """
    width = window - k + 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    total = len(grams)
    starts = np.concatenate([[0], row_ends[:-1]])
    for lo in range(0, max(total - width + 1, 0), _BLOCK):
        part = grams[lo : lo + _BLOCK + width - 1]
        keys = (part & ~_PLACE) | np.arange(len(part), dtype=U64)
        place = (sliding_min(keys, width) & _PLACE).astype(np.int64)
        first = np.arange(len(place), dtype=np.int64)
        # a window belongs to the row of its first symbol and must end in it
        fits = np.zeros(len(place) + 1, np.int64)
        a = np.clip(starts - lo, 0, len(place))
        b = np.clip(row_ends - window + 1 - lo, 0, len(place))
        some = b > a
        np.add.at(fits, a[some], 1)
        np.add.at(fits, b[some], -1)
        ok = np.cumsum(fits[:-1]) > 0
        change = np.ones(len(place), bool)
        change[1:] = place[1:] != place[:-1]
        row_starts = a[some]
        change[row_starts[row_starts < len(place)]] = True
        change[1:] |= ok[1:] != ok[:-1]
        heads = np.flatnonzero(change)
        tails = np.append(heads[1:], len(place)) - 1
        keep = ok[heads]
        found.append((first[heads[keep]] + lo, tails[keep] + lo, place[heads[keep]] + lo))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*found))
