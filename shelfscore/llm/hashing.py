"""Vectorised hashes of words, shingles and windows of one text, for use inside tasks.

A word's hash is a polynomial over random numbers of its bytes, taken from one
running sum over the text, so no step works word by word. All arithmetic wraps
at 64 bits; the final mix makes every bit depend on the whole word."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_spans(data: np.ndarray, letters: np.ndarray = ~_IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every run of bytes that are letters by the table."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = letters[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span. Equal bytes give equal hashes anywhere."""
    powers, inverses = _grown(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers[: len(data)], out=total[1:])
    raw = (total[ends] - total[starts]) * inverses[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * _ODD)


def word_hashes(text: bytes, lower: bool = False) -> np.ndarray:
    data = np.frombuffer(text, dtype=np.uint8)
    if lower:
        data = LOWER[data]
    starts, ends = word_spans(data)
    return span_hashes(data, starts, ends)


def sequence_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` words, in the order of their starts."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    run = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        run = run * _BASE + words[k : k + n]
    return mix(run + np.uint64(length))


def shingle_set(text: bytes | None, length: int, lower: bool = True) -> np.ndarray:
    """Sorted distinct shingle hashes. A shorter text is one shingle of all its
    words, and a text without words has none."""
    words = word_hashes(text or b"", lower)
    return np.unique(sequence_hashes(words, min(length, len(words)) or 1))
