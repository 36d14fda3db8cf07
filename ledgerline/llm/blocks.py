"""Vectorised byte and word hashing over blocks of UTF-8 texts.

A block is the concatenation of several texts: a ``uint8`` array and the
``n + 1`` offsets of the texts in it. Every function works on whole blocks with
numpy; the Spark operators cut Arrow batches into blocks of bounded size, so
memory does not grow with a partition.

Hashes are polynomial prefix sums modulo 2**64 over a fixed random byte table,
finished with a bit mixer: the hash of any substring costs one subtraction and
one multiplication, and equal substrings hash equally in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finisher: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, grown on demand and kept up to a block's size."""
    have = _powers.get("p")
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1024)
        p = np.full(size, _BASE, dtype=np.uint64)
        q = np.full(size, _BASE_INV, dtype=np.uint64)
        p[0] = q[0] = 1
        p, q = np.multiply.accumulate(p), np.multiply.accumulate(q)
        if size > 2 * BLOCK_BYTES:  # an over-long text: do not keep its tables
            return p[:n], q[:n]
        _powers["p"], _powers["q"] = p, q
    return _powers["p"][:n], _powers["q"][:n]


class Hasher:
    """Substring hashes of one block."""

    def __init__(self, data: np.ndarray):
        p, self._inv = _power(len(data) + 1)
        self._sum = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * p[:-1], out=self._sum[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._inv[start])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k bytes at every position that has k bytes."""
        return mix((self._sum[k:] - self._sum[:-k]) * self._inv[: len(self._sum) - k])


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive row ranges; a text longer than
    ``limit`` is a block of its own. NULL texts count as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    big = texts.cast(pa.large_string())
    n = len(big)
    if not n:
        return
    _, off, raw = big.buffers()
    off = np.frombuffer(off, dtype=np.int64)[big.offset : big.offset + n + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(off, off[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, data[off[first] : off[last]], off[first : last + 1] - off[first]
        first = last


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word ``[^\\x20\\x09-\\x0D]+`` and, per text, the index of
    its first word (``n + 1`` values). A word never crosses a text's border."""
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True
    gap = np.ones(n + 1, dtype=bool)
    gap[:n] = _SPACE[data]
    before = np.ones(n + 1, dtype=bool)
    before[1:] = gap[:-1]
    inside = ~gap
    start = np.flatnonzero(inside[:n] & (before | cut)[:n])
    end = np.flatnonzero(~before[1:] & (gap[1:] | cut[1:])) + 1
    return start, end, np.searchsorted(start, off)


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct hashes of its ``size``-word shingles (the whole
    sequence when it has fewer words, nothing without words); A-Z are lower-cased."""
    low = LOWER[data]
    start, end, first = words(low, off)
    w = Hasher(low).spans(start, end)
    m = len(w)
    acc = np.zeros(m, dtype=np.uint64)
    for j in range(size):
        if m > j:
            acc[: m - j] = acc[: m - j] * np.uint64(0xD6E8FEB86659FD93) + w[j:]
    acc = mix(acc)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(acc[a : b - size + 1])
        elif b > a:
            h = np.uint64(b - a)
            for x in w[a:b]:
                with np.errstate(over="ignore"):
                    h = h * np.uint64(0xD6E8FEB86659FD93) + x
            yield mix(np.array([h], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)
