"""Word shingles as 64-bit hashes, vectorised over a text's bytes."""

from __future__ import annotations

import numpy as np

WORDS = 5
CHUNK = 1 << 20
_P = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for p in (_P, pow(_P, -1, 1 << 64)):
            x = np.full(size, p & _MASK, np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        _powers[:] = both
    return _powers


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that are not ASCII white space."""
    word = np.empty(len(raw) + 2, bool)
    word[0] = word[-1] = False
    np.logical_not(IS_SPACE[raw], out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    return edges[0::2], edges[1::2]


def hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One hash per word, and where each starts and ends; long texts in chunks
    that end between words."""
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + CHUNK)
        while end < len(raw) and not IS_SPACE[raw[end]]:
            end += 1
        part = np.frombuffer(raw, np.uint8, end - at, at)
        starts, ends = word_spans(part)
        if len(starts):
            p, inverse = powers(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * p[:len(part)], out=sums[1:])
            out.append((mix((sums[ends] - sums[starts]) * inverse[starts]), starts + at, ends + at))
        at = end
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def word_hashes(raw: bytes) -> np.ndarray:
    """One hash per word."""
    return hashed_words(raw)[0]


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` lower-cased words; a
    text of fewer words is one shingle, a text of none has none."""
    h = word_hashes((text or "").lower().encode("utf-8", "replace"))
    if not len(h):
        return h
    n = max(1, len(h) - words + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(words, len(h))):
        total = (total * np.uint64(_P)) + h[k:k + n]
    return np.unique(mix(total))


def minhash(hashes: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """``size`` independent minima of the hashed set, as int32."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 63, (size, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, (size, 1), dtype=np.uint64)
    low = np.full(size, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(hashes), 4096):
        low = np.minimum(low, ((hashes[None, i:i + 4096] * a + b) >> np.uint64(32)).min(axis=1))
    return low.astype(np.uint32).view(np.int32)
