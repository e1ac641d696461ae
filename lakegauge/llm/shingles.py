"""Sets of word shingles of texts, as hashes for search and exactly for proof."""

from __future__ import annotations

import numpy as np

WIDTH = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = _RNG.integers(1, 2**63, WIDTH, dtype=np.uint64) | np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Bytes whose prefix sums are held at once; a longer word is taken as a whole.
BLOCK_BYTES = 1 << 18
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(n + n // 4, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of UTF-8 data."""
    raw = np.frombuffer(data, np.uint8)
    space = _IS_SPACE[raw]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        fits = int(np.searchsorted(ends, begin + BLOCK_BYTES, side="right"))
        own = slice(at, max(at + 1, fits))
        first, last = starts[own] - begin, ends[own] - begin
        block = raw[begin : begin + last[-1]]
        up, down = _powers_to(len(block) + 1)
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_BYTE[block] * up[: len(block)], out=total[1:])
        sums[own] = (total[last] - total[first]) * down[first]
        at = own.stop
    return mixed(sums), starts


def hashed_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    parts = [(text or "").encode().lower() for text in texts]
    words, starts = word_hashes(b"\n".join(parts))
    ends = np.cumsum([len(part) + 1 for part in parts])
    bounds = np.concatenate(([0], np.searchsorted(starts, ends)))
    count = max(0, len(words) - WIDTH + 1)
    windows = np.zeros(count, np.uint64)
    for k in range(WIDTH):
        windows += words[k : k + count] * _PLACE[k]
    windows = mixed(windows)
    sets = []
    for first, last in zip(bounds[:-1], bounds[1:]):
        n = last - first
        if n >= WIDTH:
            sets.append(np.unique(windows[first : last - WIDTH + 1]))
        else:
            whole = (words[first:last] * _PLACE[:n]).sum(keepdims=True) + np.uint64(n)
            sets.append(mixed(whole) if n else whole[:0])
    return sets


def exact_set(text: str | None) -> set[bytes]:
    words = (text or "").encode().lower().split()
    if len(words) < WIDTH:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[k : k + WIDTH]) for k in range(len(words) - WIDTH + 1)}
