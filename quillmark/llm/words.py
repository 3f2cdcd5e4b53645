"""Words of whole texts as numpy arrays: places in the bytes and 64-bit codes.

Runs inside Arrow tasks. A slice of a batch is taken as one array of bytes, so nothing loops
over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MASK = (1 << 64) - 1


def splitmix(x: np.ndarray) -> np.ndarray:
    """A well mixing bijection of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


BYTE_CODES = splitmix(np.arange(256, dtype=np.uint64))


def byte_table(separators: bytes, lower: bool) -> np.ndarray:
    """Byte to byte: separators to 0, A-Z lowered if asked for. A zero byte that is no separator becomes 0xFF, which UTF-8 never has."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[0] = 0xFF
    table[list(separators)] = 0
    return table


BLANK_BYTES = b" \t\n\x0b\x0c\r"


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of some rows together; null is empty.

    Offsets are relative to the bytes, one more than rows. A row over the limit comes alone.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    large = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    _, offsets, data = large.buffers()
    offsets = np.frombuffer(offsets, np.int64)[large.offset : large.offset + len(large) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(large):
        last = max(int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1, first + 1)
        at = offsets[first : last + 1]
        yield first, last, data[at[0] : at[-1]], at - at[0]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(mapped bytes, starts, ends, first word of each row and the count at the end); words never cross rows."""
    mapped = table[data]
    inside = np.zeros(len(data) + 2, bool)
    np.not_equal(mapped, 0, out=inside[1:-1])
    starts = inside[1:-1] & ~inside[:-2]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    starts[cuts] = inside[1:-1][cuts]
    starts = np.flatnonzero(starts)
    ends = inside[1:-1] & ~inside[2:]
    before = cuts - 1
    ends[before] = inside[1:-1][before]
    ends = np.flatnonzero(ends) + 1
    return mapped, starts, ends, np.searchsorted(starts, offsets)


def word_codes(mapped: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit code for each word: the sum of byte codes times codes of their places."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    begin = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
    held = mapped[place + np.repeat(starts, lengths)]
    weights = splitmix(np.arange(1000, 1000 + int(lengths.max()), dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(BYTE_CODES[held] * weights[place], begin)
        return splitmix(sums + lengths.astype(np.uint64))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after the other."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
