"""Words of whole Arrow text columns as arrays: bounds, owners and hashes.

Tasks work on the UTF-8 bytes of many texts at once, so no Python object is made
per word. Hashes only find candidates or group equal word sequences; they depend
on the words alone, not on where they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
SEGMENT_BYTES = 1 << 20
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
STEPS = (0xBF58476D1CE4E5B9, 0xFF51AFD7ED558CCD)

# [^\x20\x09-\x0D]+
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows in them; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64 if wide else np.int32) if bounds else np.zeros(1, int)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of the batches in runs of about ``limit`` bytes of text, with bytes and offsets.

    A longer text is a run of its own.
    """
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        start, rows = 0, batch.num_rows
        while start < rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), rows)
            low, high = offsets[start], offsets[stop]
            yield batch.slice(start, stop - start), data[low:high], offsets[start : stop + 1] - low
            start = stop


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def _power_tables(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known[0]) < size:
        length = max(size, SEGMENT_BYTES + 4096)
        tables = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(length, factor, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        known = (tables[0], tables[1])
        if length <= 8 * SEGMENT_BYTES:
            _powers[base] = known
    return known


@dataclass
class Words:
    """Words of a run of texts, in order. ``first`` has one bound more than there are texts."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: list[np.ndarray]
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))


def _segments(is_word: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of about ``SEGMENT_BYTES`` that cut no word."""
    start, size = 0, len(is_word)
    while start < size:
        stop = min(start + SEGMENT_BYTES, size)
        while stop < size and is_word[stop] and is_word[stop - 1]:
            ahead = is_word[stop : stop + 4096]
            gap = np.flatnonzero(~ahead)
            step = int(gap[0]) if len(gap) else len(ahead)
            edge = int(np.searchsorted(offsets, stop))
            if edge < len(offsets) and offsets[edge] <= stop + step:
                stop = int(offsets[edge])
                break
            stop += step
        yield start, stop
        start = stop


def find_words(
    data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray, hashes: int = 1
) -> Words:
    """Maximal runs of the bytes in ``alphabet`` inside each text, hashed ``hashes`` ways."""
    is_word = alphabet[data]
    opens = is_word.copy()
    opens[1:] &= ~is_word[:-1]
    closes = is_word.copy()
    closes[:-1] &= ~is_word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    opens[inner] = is_word[inner]
    closes[inner - 1] = is_word[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    found = [np.zeros(len(starts), np.uint64) for _ in range(hashes)]
    if hashes and len(starts):
        for low, high in _segments(is_word, offsets):
            a, b = np.searchsorted(starts, (low, high))
            if a == b:
                continue
            part = data[low:high].astype(np.uint64) + np.uint64(1)
            s, e = starts[a:b] - low, ends[a:b] - low
            for i in range(hashes):
                up, down = _power_tables(BASES[i], high - low)
                sums = np.zeros(high - low + 1, np.uint64)
                np.cumsum(part * up[: high - low], dtype=np.uint64, out=sums[1:])
                found[i][a:b] = mix((sums[e] - sums[s]) * down[s])
    return Words(starts, ends, found, np.searchsorted(starts, offsets).astype(np.int64))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of consecutive spans of bytes; of over-long spans only those up to a segment."""
    out = np.zeros(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        low = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, low + SEGMENT_BYTES, side="right")))
        high = min(int(ends[b - 1]), low + SEGMENT_BYTES)
        part = data[low:high].astype(np.uint64) + np.uint64(1)
        up, down = _power_tables(BASES[0], high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(part * up[: high - low], dtype=np.uint64, out=sums[1:])
        s, e = starts[a:b] - low, np.minimum(ends[a:b], high) - low
        out[a:b] = mix((sums[e] - sums[s]) * down[s])
        a = b
    return out


def grams(hashes: np.ndarray, size: int, step: int = STEPS[0]) -> np.ndarray:
    """Hash of the ``size`` words that begin at each word; runs past text ends are included."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    done, value = 0, np.zeros(len(hashes) + 1, np.uint64)
    power, length = hashes.copy(), 1
    factor = step
    rest = size
    while rest:
        if rest & 1:
            # value covers `done` words, power covers the next `length` words
            n = len(hashes) - done - length + 1
            scale = np.uint64(pow(factor, 1, 1 << 64))
            value = value[:n] * scale + power[done : done + n] if done else power[:n].copy()
            done += length
        rest >>= 1
        if rest:
            n = len(power) - length
            power = power[:n] * np.uint64(factor) + power[length : length + n]
            length *= 2
            factor = factor * factor % (1 << 64)
    return mix(value[:count] * np.uint64(STEPS[1]) + np.uint64(size))


def list_array(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Consecutive values as lists of the given lengths."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
