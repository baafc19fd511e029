"""Pairs of 64-bit values within a Hamming radius, by vertical bit planes and carry-save counters.

Bit k of all values lies in plane k, 64 values to a word. All values of a run are compared at once with those
`shift` places further on: the differing bits of each plane are added to counters that are bit planes themselves.
The counters start so high that a lane overflows just when its distance exceeds the radius. Blocks of words whose
lanes have all overflowed are abandoned.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
BITS = 64
_ALL = _U(0xFFFFFFFFFFFFFFFF)
# Planes added between two looks for blocks to abandon, and words of a block.
LOOK, BLOCK_WORDS = 8, 16


def planes_of(values: np.ndarray) -> np.ndarray:
    """(64, words + 1) words; the values are padded with zeros to whole words, and one word follows."""
    words = -(-len(values) // BITS)
    padded = np.zeros(words * BITS, dtype="<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.concatenate([packed.view("<u8").reshape(BITS, words), np.zeros((BITS, 1), _U)], axis=1)


def _words_of(mask: np.ndarray) -> np.ndarray:
    packed = np.packbits(mask, bitorder="little")
    return np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view("<u8")


def _exceeding(planes: np.ndarray, words: int, shift: int, radius: int, apart: np.ndarray) -> np.ndarray:
    """Lanes of the first `words` words that differ from those `shift` further in more than `radius` bits.

    Lanes set in `apart` are not compared.
    """
    bits = (radius + 1).bit_length()
    start = (1 << bits) - 1 - radius
    over = apart.copy()
    ahead, turn = divmod(shift, BITS)
    at = np.arange(words)
    counters = [np.full(words, _ALL if start >> k & 1 else 0, _U) for k in range(bits)]
    beyond = apart.copy()
    for k in range(BITS):
        if k % LOOK == 0:
            busy = np.add.reduceat(beyond != _ALL, np.arange(0, len(at), BLOCK_WORDS)) > 0 if len(at) else np.zeros(0, bool)
            if not busy.all():
                over[at] = beyond
                on = np.repeat(busy, BLOCK_WORDS)[: len(at)]
                at, beyond, counters = at[on], beyond[on], [c[on] for c in counters]
            if not len(at):
                return over
        plane = planes[k]
        there = np.minimum(at + ahead, planes.shape[1] - 1)
        other = plane[there]
        if turn:
            other = (other >> _U(turn)) | (plane[np.minimum(there + 1, planes.shape[1] - 1)] << _U(BITS - turn))
        carry = plane[at] ^ other
        for counter in counters:
            carry, counter[...] = counter & carry, counter ^ carry
        beyond |= carry
    over[at] = beyond
    return over


def linked(values: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (place, place) that join what lies within `radius` of each other, inside consecutive runs of `sizes`.

    All pairs of a run are compared; of the links those are returned that join two groups so far apart, fewer
    than the values.
    """
    sizes = np.asarray(sizes, np.int64)
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    # Long runs first: at every shift the runs that still have partners are a prefix.
    places = np.concatenate([np.zeros(0, np.int64), *[np.arange(begins[i], begins[i] + sizes[i]) for i in order]]) if len(sizes) < 64 else _joined(begins[order], sizes[order])
    sizes = sizes[order]
    ends = np.repeat(np.cumsum(sizes), sizes)
    planes = planes_of(values[places].astype(_U))
    lanes, group = np.arange(len(places)), np.arange(len(places))
    found = [], []
    for shift in range(1, int(sizes[0]) if len(sizes) else 0):
        n = int(sizes[: np.searchsorted(-sizes, -shift, side="left")].sum())
        words = -(-n // BITS)
        apart = np.ones(words * BITS, bool)
        apart[:n] = lanes[:n] + shift >= ends[:n]
        over = _exceeding(planes, words, shift, radius, _words_of(apart))
        a = np.flatnonzero(np.unpackbits((~over).view(np.uint8), bitorder="little"))
        a = a[group[a] != group[a + shift]]
        if len(a):
            kept = _join(group, a, a + shift, int(ends[n - 1]))
            found[0].append(places[a[kept]])
            found[1].append(places[a[kept] + shift])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)


def _joined(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of runs, one run after the other."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    steps = np.ones(int(sizes.sum()), np.int64)
    firsts = np.cumsum(sizes) - sizes
    steps[firsts] = begins - np.append(0, begins[:-1] + sizes[:-1] - 1)
    return np.cumsum(steps)


def _join(group: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Join the groups of a and b in place, over the first n lanes; whether each link joined two groups."""
    over: dict[int, int] = {}

    def top(x: int) -> int:
        while x in over:
            x = over[x]
        return x

    kept = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(group[a].tolist(), group[b].tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            over[max(x, y)] = min(x, y)
            kept[i] = True
    ids = np.fromiter(sorted(over), np.int64, len(over))
    tops = np.array([top(i) for i in ids.tolist()], np.int64)
    part = group[:n]
    at = np.minimum(np.searchsorted(ids, part), len(ids) - 1)
    hit = ids[at] == part
    part[hit] = tops[at[hit]]
    return kept
