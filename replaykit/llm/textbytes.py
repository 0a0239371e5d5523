"""Vectorised helpers over the UTF-8 bytes of an Arrow string column."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_RADIX_INVERSE = np.uint64(pow(int(_RADIX), -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; a bijection, so distinct values stay distinct."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_table(name: str, radix: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        steps = np.full(size, radix, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte value times radix to the power of its place, one longer than data."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * _power_table("up", _RADIX, len(data)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]; equal bytes hash alike wherever they stand."""
    down = _power_table("down", _RADIX_INVERSE, len(sums))
    return (sums[ends] - sums[starts]) * down[starts]


class Texts(NamedTuple):
    """Whole texts of consecutive rows: text i is data[offsets[i]:offsets[i+1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The rows in runs of whole texts of about ``limit`` bytes; a longer text stands alone."""
    if not len(column):
        return
    data, offsets = string_buffers(column)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield Texts(at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        at = end


def word_spans(texts: Texts, gap: np.ndarray = ASCII_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all maximal runs of bytes that are no gap; none crosses a text."""
    data, offsets = texts.data, texts.offsets
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ink = np.zeros(len(data) + 1, bool)
    np.logical_not(gap[data], out=ink[:-1])
    begins = ink[:-1].copy()
    begins[1:] &= ~ink[:-2]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    begins[inner] = ink[inner]
    ends = ink[:-1] & ~ink[1:]
    before = inner[inner > 0] - 1
    ends[before] |= ink[before]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(texts: Texts, gap: np.ndarray = ASCII_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and, for each text, the index of its first word (one entry more)."""
    starts, ends = word_spans(texts, gap)
    first = np.searchsorted(starts, texts.offsets)
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # piecewise, so that the tables of powers stay small
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK_BYTES, "right")))
        low, high = int(starts[at]), int(ends[stop - 1])
        out[at:stop] = span_hashes(prefix_sums(texts.data[low:high]), starts[at:stop] - low, ends[at:stop] - low)
        at = stop
    return mix(out), first
