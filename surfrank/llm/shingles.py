"""Sets of word shingles as sorted 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 2 * CHUNK_BYTES)
        both = []
        for base in (_BASE, _BACK):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def word_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Hashes of the words of each text in order; A-Z count as a-z, words are runs of no white space."""
    return (words for words, _ in words_and_ends(texts))


def words_and_ends(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its words' hashes and last three bytes (as a number)."""
    held: list[bytes] = []
    size = 0
    for t in texts:
        data = (t or "").encode("utf-8", "surrogatepass")
        held.append(data)
        size += len(data)
        if size >= CHUNK_BYTES:
            yield from _words(held)
            held, size = [], 0
    if held:
        yield from _words(held)


def _words(held: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    raw = np.frombuffer(b" " + b" ".join(held) + b" ", np.uint8)
    gap = _SPACE[raw]
    edge = np.diff(gap.astype(np.int8))
    start, end = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
    power, back = _powers(len(raw) + 1)
    low = _LOWER[raw]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((low + np.uint64(1)) * power[: len(raw)], out=sums[1:])
    words = mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    last = np.zeros(len(start), np.int64)
    for i in (3, 2, 1):
        at = end - i
        last = last * 256 + np.where(at >= start, low[at], 0).astype(np.int64)
    cuts = np.searchsorted(start, np.cumsum([len(h) + 1 for h in held])[:-1] + 1)
    return zip(np.split(words, cuts), np.split(last, cuts), strict=True)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Distinct k-word shingles, sorted; with fewer words the whole sequence is one, without words none."""
    n = len(words)
    if not n:
        return words
    width = min(n, k)
    out = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : n - width + 1 + i]
    return np.unique(mix(out + np.uint64(width)))


def digest(shingles: np.ndarray) -> int:
    """One 64-bit number for a set, signed."""
    both = np.array([mix(shingles + np.uint64(7)).sum(dtype=np.uint64) + np.uint64(len(shingles))])
    return int(mix(both).view(np.int64)[0])
