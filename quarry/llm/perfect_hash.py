"""A minimal perfect hash in numpy: n distinct 64-bit keys to places 0..n-1.

Levels of bit arrays: a key that has a bit of a level to itself stays there, the
others go on to the next level, which is as wide as ``SPREAD`` times what is
left.  A key's place is the number of set bits before its own.  About
``SPREAD`` * e**(1/SPREAD) bits a key; no key is stored.
"""

from __future__ import annotations

import numpy as np

from quarry.llm.common import mix64

SPREAD = 2.0
LEVELS = 64  # a level leaves 0.4 of its keys: far more levels than distinct keys can need
STEP = 0x9E3779B97F4A7C15


def _bit(keys: np.ndarray, level: int, width: int) -> np.ndarray:
    return (mix64(keys + np.uint64(STEP * (level + 1) % 2**64)) % np.uint64(width)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``widths, words``: bits of each level, and all levels as 64-bit words."""
    widths, words = [], []
    left = keys
    while len(left):
        if len(widths) == LEVELS:
            raise ValueError("keys of a perfect hash must be distinct")
        width = -(-max(64, int(SPREAD * len(left))) // 64) * 64
        at = _bit(left, len(widths), width)
        alone = np.bincount(at, minlength=width) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        widths.append(width)
        left = left[~alone[at]]
    return np.array(widths, np.int64), np.concatenate(words) if words else np.empty(0, np.uint64)


class PerfectHash:
    """Places of keys by what ``build`` returned."""

    def __init__(self, widths: np.ndarray, words: np.ndarray):
        self.widths, self.words = widths, words
        self.first = np.cumsum(widths) - widths
        set_bits = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(set_bits) - set_bits

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; of a key that was not built in, any place or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, width in enumerate(self.widths.tolist()):
            if not len(left):
                break
            bit = self.first[level] + _bit(keys[left], level, width)
            word = self.words[bit >> 6]
            inside = (bit & 63).astype(np.uint64)
            here = (word >> inside & np.uint64(1)).astype(bool)
            below = word & ((np.uint64(1) << inside) - np.uint64(1))
            out[left[here]] = (self.before[bit >> 6] + np.bitwise_count(below))[here]
            left = left[~here]
        return out
