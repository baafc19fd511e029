"""Canonical length-limited Huffman codes: lengths from counts, packing, and decoding by table.

Codes are packed most significant bit first. Every document starts at a byte; a checkpoint every
`LANE` ids holds the bit at which decoding can start, so all lanes of a block decode side by side.
"""

from __future__ import annotations

import numpy as np

# Ids between two checkpoints.
LANE = 256


def length_limit(symbols: int) -> int:
    """One bit more than a fixed-width code needs, 16 at least."""
    return max(16, int(max(symbols - 1, 1)).bit_length() + 1)


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits; 0 for symbols that do not occur (package-merge)."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) == 0:
        return lengths
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("the limit is too small for so many symbols")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    weights, is_leaf = leaves, [np.ones(len(leaves), dtype=bool)]
    for _ in range(limit - 1):
        even = len(weights) // 2 * 2
        packages = weights[0:even:2] + weights[1:even:2]
        both = np.concatenate([leaves, packages])
        place = np.argsort(both, kind="stable")
        weights = both[place]
        is_leaf.append(place < len(leaves))
    taken = 2 * len(leaves) - 2
    depth = np.zeros(len(leaves), dtype=np.int64)
    for level in reversed(is_leaf):
        own = int(level[:taken].sum())
        depth[:own] += 1
        taken = 2 * (taken - own)
    lengths[order] = depth
    return lengths


class Codebook:
    """Codes by symbol and the decoding table, both derived from the lengths alone."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        self.bits = int(lengths.max()) if len(used) else 1
        spans = 1 << (self.bits - self.lengths[order])
        left_aligned = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.codes[order] = (left_aligned >> (self.bits - self.lengths[order])).astype(np.uint64)
        self.symbol = np.zeros(1 << self.bits, dtype=np.uint32)
        self.step = np.ones(1 << self.bits, dtype=np.int64)
        filled = int(spans.sum())
        self.symbol[:filled] = np.repeat(order, spans)
        self.step[:filled] = np.repeat(self.lengths[order], spans)

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray, list[np.ndarray]]:
        """Pack the ids of several documents of `counts` ids each.

        Returns the bytes of all, each document's size in bytes and its checkpoints in bits from its start.
        """
        sizes = self.lengths[ids]
        before = np.cumsum(sizes) - sizes
        ends = np.cumsum(counts)
        firsts = ends - counts
        total = np.concatenate([before, [int(sizes.sum())]]) if len(ids) else np.zeros(1, np.int64)
        doc_bits = total[ends] - total[firsts]
        doc_bytes = (doc_bits + 7) // 8
        doc_start = (np.cumsum(doc_bytes) - doc_bytes) * 8
        shift = np.repeat(doc_start - total[firsts], counts)
        position = before + shift
        checkpoints = [
            (position[a:b:LANE] - start).astype(np.int64)
            for a, b, start in zip(firsts.tolist(), ends.tolist(), doc_start.tolist(), strict=True)
        ]
        words = np.zeros(int(doc_bytes.sum()) // 4 + 3, dtype=np.uint64)
        if len(ids):
            word = position >> 5
            room = (64 - (position & 31) - sizes).astype(np.uint64)
            value = self.codes[ids] << room
            change = np.flatnonzero(np.diff(word, prepend=-1))
            at = word[change]
            words[at] += np.add.reduceat(value >> np.uint64(32), change)
            words[at + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), change)
        packed = words.astype(">u4").tobytes()[: int(doc_bytes.sum())]
        return packed, doc_bytes, checkpoints

    def decode(self, packed: bytes, checkpoints: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of all lanes in order; `checkpoints` are bits in `packed`, `counts` ids of each lane."""
        out = np.zeros(int(counts.sum()), dtype=np.uint32)
        raw = np.frombuffer(packed + bytes(8), dtype=np.uint8).astype(np.uint32)
        peek = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        order = np.argsort(-counts, kind="stable")
        at = checkpoints[order].copy()
        place = (np.cumsum(counts) - counts)[order]
        left = counts[order]
        cut = np.uint32(32 - self.bits)
        for step in range(int(left[0]) if len(left) else 0):
            active = int(np.searchsorted(-left, -step, side="left"))
            here = at[:active]
            window = (peek[here >> 3] << (here & 7).astype(np.uint32)) >> cut
            out[place[:active] + step] = self.symbol[window]
            at[:active] += self.step[window]
        return out
