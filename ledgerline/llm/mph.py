"""Minimal perfect hash of 64-bit keys, built and probed with numpy.

Level by level every remaining key is hashed into a bit array; keys alone on their bit are
placed there, the others go on to the next, smaller level. A key's slot is the
number of set bits before its own, so n distinct keys take the slots 0 to n - 1 in
about 3 bits a key. Keys left after the last level (practically none) are kept in a list.
"""

from __future__ import annotations

import numpy as np

from .blocks import mix

GAMMA = 2.0
LEVELS = 32
_SEED = 0x9E3779B97F4A7C15


def _hash(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((_SEED * (level + 1)) & (2**64 - 1))
    return (mix(keys ^ seed) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest  # bit arrays, keys without a bit
        self._before = []
        at = 0
        for bits in levels:
            self._before.append(at + np.cumsum(bits, dtype=np.int64) - bits)
            at += int(bits.sum())
        self._placed = at

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct uint64."""
        levels = []
        while len(keys) and len(levels) < LEVELS:
            size = max(8, -(-int(GAMMA * len(keys)) // 8) * 8)
            h = _hash(keys, len(levels), size)
            bits = np.bincount(h, minlength=size) == 1
            levels.append(bits)
            keys = keys[~bits[h]]
        return cls(levels, np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key; a key that was not built in gets -1 or any slot (its fingerprint tells)."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            h = _hash(keys[open_], level, len(bits))
            hit = bits[h]
            out[open_[hit]] = self._before[level][h[hit]]
            open_ = open_[~hit]
            if not len(open_):
                return out
        if len(self.rest):
            at = np.searchsorted(self.rest, keys[open_])
            ok = self.rest[np.minimum(at, len(self.rest) - 1)] == keys[open_]
            out[open_[ok]] = self._placed + at[ok]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), len(self.rest), *(len(x) for x in self.levels)], dtype="<i8").tobytes()
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels) + self.rest.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        n, rest = np.frombuffer(raw, "<i8", 2).tolist()
        sizes = np.frombuffer(raw, "<i8", n, 16).tolist()
        at, levels = 16 + 8 * n, []
        for size in sizes:
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, size // 8, at)).astype(bool))
            at += size // 8
        return cls(levels, np.frombuffer(raw, "<u8", rest, at))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)
