"""Texts as flat numpy arrays: words, rolling hashes, packed number lists.

A hash is 64 bits wide: a sum of per-symbol random numbers times powers of an odd
number, so every window of any length costs the same, followed by a mixing step.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

# Bytes of text that are turned into arrays at once; a longer text is taken alone.
SLICE_BYTES = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SYMBOLS = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit numbers over all bits."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x81DADEF4BC2DD44D)
    values ^= values >> np.uint64(33)
    return values


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_arrays(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, kept while they are of usual size."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    size = max(n, 1 << 20)
    made = []
    for base in (_BASE, _BASE_INVERSE):
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        made.append(np.multiply.accumulate(powers))
    if size <= 2 * SLICE_BYTES:
        _powers = (made[0], made[1])
    return made[0][:n], made[1][:n]


def _sums(values: np.ndarray) -> np.ndarray:
    powers, _ = _power_arrays(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers, out=sums[1:])
    return sums


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of values[start:end] for each span."""
    sums = _sums(values)
    _, inverse = _power_arrays(len(values) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def rolling_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """The hash of each window of `width` values, by the position of its first."""
    if len(values) < width:
        return np.empty(0, np.uint64)
    sums = _sums(values)
    n = len(values) - width + 1
    _, inverse = _power_arrays(n)
    return mix((sums[width:] - sums[:n]) * inverse)


def symbols(data: np.ndarray) -> np.ndarray:
    return _SYMBOLS[data]


def text_slices(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return
    first = column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int64)[first : first + len(column) + 1]
    if column.buffers()[2] is None:
        data = np.empty(0, np.uint8)
    else:
        data = np.frombuffer(column.buffers()[2], np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + SLICE_BYTES, "right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def split_words(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and per text the index of its first word.

    `separator`: which bytes are between words, by default [\\x20\\x09-\\x0D]. The last array has one
    more entry, the number of words.
    """
    inside = ~separator[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    begins[borders] = inside[borders]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    borders = offsets[1:][offsets[1:] > 0] - 1
    stops[borders] = inside[borders]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def joined_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space after each, and where each begins; the last entry is the end."""
    lengths = ends - starts
    firsts = np.append(0, np.cumsum(lengths + 1))
    flat = np.full(int(firsts[-1]), 0x20, np.uint8)
    begins = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum()))
    flat[at + np.repeat(firsts[:-1] - begins, lengths)] = data[at + np.repeat(starts - begins, lengths)]
    return flat, firsts


def owners_of(bounds: np.ndarray) -> np.ndarray:
    """The text index of each item, from the bounds of the texts."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def whole_windows(bounds: np.ndarray, width: int) -> np.ndarray:
    """Positions at which a window of `width` items starts and ends in one text."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(bounds[:-1] - before, counts)


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of `size` items lie in a window that starts at one of `starts`."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + width, size), -1)
    return np.cumsum(edges[:-1]) > 0


_compressor = zstandard.ZstdCompressor(level=1)
_decompressor = zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned 64-bit arrays as bytes: sorted or small numbers take little room."""
    parts = [np.array([len(arrays), *map(len, arrays)], np.uint64).tobytes()]
    for values in arrays:
        values = np.asarray(values).astype(np.uint64)
        steps = values.copy()
        steps[1:] -= values[:-1]
        parts.append(steps.view(np.uint8).reshape(-1, 8).T.tobytes())
    return _compressor.compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(_decompressor.decompress(data), np.uint8)
    count = int(raw[:8].view(np.uint64)[0])
    lengths = raw[8 : 8 * (count + 1)].view(np.uint64).astype(int)
    at, arrays = 8 * (count + 1), []
    for n in lengths:
        planes = raw[at : at + 8 * n].reshape(8, n)
        arrays.append(np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64)))
        at += 8 * n
    return [a.astype(np.uint64) for a in arrays]


def compress_text(text: bytes) -> bytes:
    return _compressor.compress(text)


def decompress_text(data: bytes) -> bytes:
    return _decompressor.decompress(data)
