"""Sets of hashed word shingles of texts.

Words are runs of bytes that are no ASCII white space, with A-Z lower-cased. A word's hash is a keyed
hash of its bytes (XXH3, 64 bits); a shingle's hash combines those of its words by place. Equality of
sets is told by 128 bits, and the key is drawn by the caller, so that no text can be written to clash.

:func:`running_hash` is a polynomial modulo 2^64, for substrings of whole arrays of bytes at once. Texts
can be written that clash under it whatever its base, so it only finds candidates and never decides.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import xxhash

WORDS = 5
_BLOCK = 1 << 18
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
# Odd multipliers: of the polynomial, its inverse, and of a word's place in a shingle.
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.array([0xD1B54A32D192ED03 + 2 * k * 0x8CB92BA72F3D8DD7 for k in range(64)], dtype=object)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as many as have been asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, _BLOCK + 1)
            row = lambda base: np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, base, np.uint64))])
            self.up, self.down = row(np.uint64(_BASE)), row(np.uint64(pow(_BASE, -1, 1 << 64)))
        return self.up, self.down


_POWERS = _Powers()
_FACTORS = np.array([int(x) % (1 << 64) | 1 for x in _PLACE], dtype=np.uint64)


def running_hash(raw: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Hashes of substrings by their places, from running sums over the bytes."""
    up, down = _POWERS.of(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return lambda start, end: (sums[end] - sums[start]) * down[start]


def _block_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block, and where each begins."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~_BLANK[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    return mixed(running_hash(raw)(starts, ends) + (ends - starts).astype(np.uint64)), starts


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each begins; never more than a block, or a word, at once."""
    hashes, starts, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(data):
        end = min(at + _BLOCK, len(data))
        while end < len(data) and not _BLANK[data[end]]:
            end += 1
        h, s = _block_words(data[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def word_hashes(text: str, seed: int = 0) -> np.ndarray:
    """The hashes of the words of a text, in order; never more than a block's, or a word's, bytes are cut at once."""
    data, at, out = text.encode().translate(_LOWER), 0, [np.zeros(0, np.uint64)]
    while at < len(data):
        end = min(at + _BLOCK, len(data))
        while end < len(data) and not _BLANK[data[end]]:
            end += 1
        words = data[at:end].split()
        out.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(seed)), np.uint64, len(words)))
        at = end
    return np.concatenate(out)


def shingle_sets(texts: list[str], words: int = WORDS, seed: int = 0) -> list[np.ndarray]:
    """Per text its distinct shingles in ascending order; fewer words than a shingle make one."""
    out = []
    for text in texts:
        h = word_hashes(text, seed)
        n = len(h)
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        size = min(n, words)
        total = np.full(n - size + 1, size, np.uint64)
        for k in range(size):
            total += h[k : n - size + 1 + k] * _FACTORS[k]
        out.append(np.unique(mixed(total)))
    return out


def set_hash(items: np.ndarray, seed: int = 0) -> tuple[int, int]:
    """Two signed 64-bit halves of a hash of a set, given in ascending order."""
    halves = np.frombuffer(xxhash.xxh3_128_digest(items.tobytes(), seed), "<i8")
    return int(halves[0]), int(halves[1])
