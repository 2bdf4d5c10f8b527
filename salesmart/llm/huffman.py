"""Canonical length-limited Huffman codes for token ids, vectorised with numpy."""

from __future__ import annotations

import numpy as np

#: Longest code, and ids between two bit-offset checkpoints.
LIMIT, STEP = 18, 128


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code length per symbol under ``limit`` (package-merge); 0: does not occur."""
    lengths = np.zeros(len(counts), np.uint8)
    order = np.argsort(counts, kind="stable")
    order = order[counts[order] > 0]
    n = len(order)
    if n < 2:
        lengths[order] = 1
        return lengths
    limit = max(limit, int(n - 1).bit_length())
    leaves = counts[order].astype(np.float64)
    levels, packed = [], np.empty(0)
    for _ in range(limit):
        merged = np.concatenate([leaves, packed])
        place = np.argsort(merged, kind="stable")
        levels.append(place < n)
        merged = merged[place]
        packed = merged[0:len(merged) // 2 * 2:2] + merged[1::2]
    take, deep = 2 * n - 2, np.zeros(n, np.uint8)
    for is_leaf in reversed(levels):
        own = int(is_leaf[:take].sum())
        deep[:own] += 1
        take = 2 * (take - own)
    lengths[order] = deep
    return lengths


class Code:
    """Canonical codes: ordered by length, then symbol."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, np.uint8)
        self.width = max(1, int(self.lengths.max(initial=0)))
        used = np.flatnonzero(self.lengths)
        used = used[np.argsort(self.lengths[used], kind="stable")]
        spans = np.left_shift(np.uint64(1), (self.width - self.lengths[used]).astype(np.uint64))
        starts = np.concatenate([[0], np.cumsum(spans)])[:-1].astype(np.uint64)
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[used] = starts >> (self.width - self.lengths[used]).astype(np.uint64)
        #: By the next ``width`` bits: symbol and length of its code.
        self.symbol = np.repeat(used.astype(np.uint32), spans.astype(np.int64))
        self.symbol = np.pad(self.symbol, (0, (1 << self.width) - len(self.symbol)))
        self.bits = self.lengths[self.symbol].astype(np.int64)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits of ``ids``, padded to whole bytes, and the bit offset of every STEP-th id."""
        payload, _, marks = self.encode_runs(ids, np.array([len(ids)]))
        return payload, marks

    def encode_runs(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Bits of runs of ``ids``, each padded to whole bytes, one run after the other;
        the bytes of each, and of each the bit offset (from its start) of every STEP-th id."""
        if not len(ids):
            return b"", np.zeros(len(sizes), np.int64), np.empty(0, np.uint64)
        lengths = self.lengths[ids].astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bits = np.diff(ends[edges])
        filled = (bits + 7) // 8
        starts = 8 * (np.cumsum(filled) - filled)
        begins, total = ends[:-1] + np.repeat(starts - ends[edges[:-1]], sizes), int(filled.sum())
        word, inside = begins >> 5, begins & 31
        # a code is shorter than 32 bits, so it lies in its 32-bit word and the next one
        pair = self.codes[ids] << (64 - inside - lengths).astype(np.uint64)
        size = total // 4 + 2
        words = np.bincount(word, (pair >> np.uint64(32)).astype(np.float64), size)
        words += np.bincount(word + 1, (pair & np.uint64(0xFFFFFFFF)).astype(np.float64), size + 1)[:size]
        out = words.astype(np.uint64).astype(">u4").tobytes()[:total]
        marked = np.flatnonzero((np.arange(len(ids)) - np.repeat(edges[:-1], sizes)) % STEP == 0)
        marks = begins[marked] - np.repeat(starts, (sizes + STEP - 1) // STEP)
        return out, filled, marks.astype(np.uint64)

    def decode(self, payload: bytes, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of all lanes, one after the other.

        Lane i begins at bit ``offsets[i]`` and holds ``counts[i]`` ids (STEP at
        most); the lanes are decoded side by side, one id of each at a time.
        """
        raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, counts = offsets.astype(np.int64), counts.astype(np.int64)
        out = np.zeros((int(counts.max(initial=0)), len(counts)), np.uint32)
        shift, mask = 32 - self.width, (1 << self.width) - 1
        for i in range(len(out)):
            look = (window[np.minimum(at >> 3, len(window) - 1)] >> (shift - (at & 7))) & mask
            out[i] = self.symbol[look]
            at += self.bits[look]
        return out.T[np.arange(len(out)) < counts[:, None]]
