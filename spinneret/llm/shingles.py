"""Word shingles of many texts at once, hashed with numpy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x5851F42D4C957F2D
_UNBASE = pow(_BASE, -1, 1 << 64)
#: Tables of powers up to this length are kept.
_BLOCK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word, A-Z lower-cased. A word is a run of anything but U+0020 and U+0009 to U+000D.

    Each word's hash is a polynomial in its bytes, read off one running sum over the text.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~_SPACE[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_LOWER[raw] + np.uint64(1)) * _power_table(len(raw), _BASE), out=total[1:])
    return mix((total[ends] - total[starts]) * _power_table(len(raw), _UNBASE)[starts] + (ends - starts).astype(np.uint64))


_TABLES: dict[int, np.ndarray] = {}


def _power_table(n: int, base: int) -> np.ndarray:
    """The first ``n`` powers modulo 2^64."""
    if n > _BLOCK:
        return _powers(base, n)
    if base not in _TABLES:
        _TABLES[base] = _powers(base, _BLOCK)
    return _TABLES[base][:n]


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Distinct hashed shingles of ``width`` words, ascending; a shorter text is one shingle, none without words."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < width:
        width = len(words)
    n = len(words) - width + 1
    hashed = np.full(n, width, np.uint64)
    for k in range(width):
        hashed = mix(hashed + words[k : k + n])
    return np.unique(hashed)


def text_key(text: str | None) -> tuple[int, int]:
    """128 bits that stand for the whole sequence of words; texts without words share the key (0, 0)."""
    words = word_hashes(text)
    if not len(words):
        return 0, 0
    place = mix(np.arange(1, len(words) + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        one, two = int(mix(words + place).sum()), int(mix(words ^ (place * np.uint64(0x9E3779B97F4A7C15))).sum())
    return one - (1 << 63) or 1, two - (1 << 63)


def minhash_parameters(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and masks of ``n`` hash functions on 32-bit numbers."""
    drawn = mix(np.arange(2 * n, dtype=np.uint64) + np.uint64(seed << 32))
    return (drawn[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (drawn[n:] >> np.uint64(32)).astype(np.uint32)


def minhashes(sets: Sequence[np.ndarray], factors: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """A row of 16-bit min-hash values for each set; an empty set has all ones."""
    out = np.full((len(sets), len(factors)), 0xFFFF, np.uint16)
    for row, s in enumerate(sets):
        if not len(s):
            continue
        least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
        low = (s >> np.uint64(32)).astype(np.uint32)
        step = max(1, _BLOCK * 4 // len(factors))
        for at in range(0, len(low), step):
            part = low[at : at + step, None]
            hashed = (part ^ masks) * factors
            hashed ^= hashed >> np.uint32(15)
            np.minimum(least, (hashed * np.uint32(0x85EBCA6B)).min(axis=0), out=least)
        out[row] = ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
    return out
