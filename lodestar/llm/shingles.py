"""Word shingles of whole texts as sorted 64-bit hashes, computed per document with numpy.

Words are the maximal runs of bytes outside space and 0x09-0x0D after lower-casing
A-Z only.  A shingle is ``width`` consecutive words joined by one space; a text of
fewer words is one shingle, a text without words (or a null) has none.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class _Powers:
    """Powers of the hash base and of its inverse, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 14)
            ups, downs = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            ups[0] = downs[0] = 1
            self.up, self.down = np.multiply.accumulate(ups), np.multiply.accumulate(downs)
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the input sways every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes (uint64) of the whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    joined = np.frombuffer(b" ".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(width, len(words))
    first, last = starts[: len(words) - span + 1], ends[span - 1 :]
    up, down = _POWERS.upto(len(joined) + 1)
    sums = np.empty(len(joined) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * up[: len(joined)], out=sums[1:])
    return np.unique(mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))


def signature_seeds(size: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, size, np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, size, np.uint64)


def minwise(hashes: np.ndarray, seeds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The minimum of the set under each of the seeded hash functions, as int32 values."""
    out = np.full(len(seeds[0]), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(hashes), 512):
        block = hashes[at : at + 512, None] * seeds[0][None, :] + seeds[1][None, :]
        np.minimum(out, block.min(axis=0), out=out)
    return (mix(out) >> np.uint64(33)).astype(np.int32)


def pack(hashes: np.ndarray) -> bytes:
    """The set as sorted 48-bit values of six bytes each: what a comparison ships.

    Two different shingles of two sets of n and m fall together with a chance of n m / 2**48.
    """
    return np.ascontiguousarray((hashes >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :6] = raw
    return wide.view("<u8").ravel()


def overlap(a: bytes, b: bytes) -> int:
    """Size of the intersection of two packed sets."""
    x, y = unpack(a), unpack(b)
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())
