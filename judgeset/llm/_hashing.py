"""Vectorised hashing of bytes, words and shingles of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    if len(_powers["up"]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, b in (("up", _BASE), ("down", inverse)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """c with c[j] - c[i] = the polynomial hash of data[i:j], times base^i."""
    up, _ = _power(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
    return out


def span_hashes(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the spans, mixed with their lengths."""
    _, down = _power(len(c))
    return mix((c[end] - c[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each followed by one blank, and where each begins (and the last ends)."""
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
    return np.frombuffer(b" ".join(texts) + b" ", np.uint8) if texts else np.zeros(0, np.uint8), np.concatenate([[0], ends]).astype(np.int64)


def slices(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about limit bytes each; a longer text stands alone. Bounds the arrays in work at once."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


def shingles(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of every text, sorted within it, and where each text's begin.

    Letters A to Z count as lower case. A text of fewer words has its whole sequence as one shingle; one without words
    has none.
    """
    data, begins = joined(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    words = span_hashes(prefix_sums(_LOW[data]), start, end)
    doc = np.searchsorted(begins, start, side="right") - 1
    count = np.bincount(doc, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(count)])
    n = np.maximum(count - width + 1, np.minimum(count, 1))  # shingles with repeats
    take = np.minimum(count, width)
    of = np.repeat(np.arange(len(texts)), n)
    at = np.repeat(first[:-1], n) + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n))
    value = np.zeros(len(of), np.uint64)
    for k in range(width):
        here = k < take[of]
        value = np.where(here, mix(value * np.uint64(0x9FB21C651E98DF25) + words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else value), value)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    value, of = value[new], of[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))]).astype(np.int64)
