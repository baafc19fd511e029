"""Hashes of words and word shingles straight from UTF-8 bytes, a batch of rows at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
# Bytes hashed at a time; a longer run without white space is hashed whole. Each takes some 70 bytes of a worker while
# it is hashed, and what a worker once took it keeps beside the heap of its executor.
CHUNK = 1 << 18

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACES = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93], dtype=_U)
_LENGTHS = np.arange(WORDS + 1, dtype=_U) * _U(0xA0761D6478BD642F)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_POWERS: list[np.ndarray] = []


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all their bits matter."""
    values = (values ^ (values >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U(27))) * _U(0x94D049BB133111EB)
    return values ^ (values >> _U(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < size:
        size = max(size, CHUNK + 1)
        _POWERS[:] = [
            np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(size - 1, x, _U)])) for x in (_BASE, _INVERSE)
        ]
        if size > 2 * CHUNK:
            return tuple(_POWERS.pop(0) for _ in range(2))  # a giant is not kept
    return _POWERS[0], _POWERS[1]


def _hash_chunk(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of lower-cased bytes and the place each word starts; rows start at `begins`."""
    inside = _IN_WORD[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = begins[begins < len(raw)]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=_U)
    np.cumsum((raw.astype(_U) + _U(1)) * power[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U)), starts


def _long_row(raw: np.ndarray) -> np.ndarray:
    """Word hashes of one row, cut at white space into chunks."""
    found, at = [], 0
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        while end < len(raw) and _IN_WORD[raw[end]]:
            end += 1
        found.append(_hash_chunk(raw[at:end], np.zeros(1, dtype=np.int64))[0])
        at = end
    return np.concatenate(found) if found else np.zeros(0, _U)


def words_of_rows(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, word hashes, words of each row) for parts of a text column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK, side="right")) - 1)
        raw = _LOWER[data[offsets[start] : offsets[end]]]
        if end == start + 1 and len(raw) > CHUNK:
            hashes = _long_row(raw)
            yield start, end, hashes, np.array([len(hashes)])
        else:
            begins = offsets[start:end] - offsets[start]
            hashes, places = _hash_chunk(raw, begins) if len(raw) else (np.zeros(0, _U), np.zeros(0, np.int64))
            bounds = np.searchsorted(places, np.append(begins, len(raw)))
            yield start, end, hashes, np.diff(bounds)
        start = end


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all 5-word shingles of a row in order; of the whole sequence where it is shorter."""
    n = len(words)
    if n == 0:
        return words
    size = min(n, WORDS)
    total = np.full(n - size + 1, _LENGTHS[size], dtype=_U)
    for k in range(size):
        total += words[k : n - size + 1 + k] * _PLACES[k]
    return mix(total)


def shingles_of_rows(column: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, last row + 1, distinct sorted shingle hashes of each row)."""
    for start, end, hashes, counts in words_of_rows(column):
        stops = np.cumsum(counts).tolist()
        yield start, end, [np.unique(shingles(hashes[a:b])) for a, b in zip([0, *stops], stops, strict=False)]
