"""Words and hashed word shingles of whole texts, as numpy arrays.

A word is a run of characters outside ``[\\x20\\x09-\\x0D]``; only A-Z are lower-cased. On UTF-8
bytes that is what ``bytes.lower`` and ``bytes.split`` do.
"""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
WORD_SQL = "[^\\\\x20\\\\x09-\\\\x0D]+"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def words(text: str | None) -> list[bytes]:
    """The words of a text in order; none for NULL."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        if size > 1 << 20:  # an exceptionally long text: not kept
            return _power_table(size)
        _powers[size] = _power_table(size)
    return _powers[size]


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, dtype=np.uint64), np.full(size, _INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word, in order, from prefix sums over the bytes."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[0::2], edge[1::2]
    up, down = _powers_to(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_hashes(hashes: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """One hash per run of ``size`` words; a shorter text is one run as a whole, an empty one none."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < size:
        out = np.full(1, n, dtype=np.uint64)
        for h in hashes:
            out = out * _STEP + h
        return mix(out)
    out = np.full(n - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = out * _STEP + hashes[k : n - size + 1 + k]
    return mix(out)


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> frozenset[bytes]:
    """The distinct shingles themselves, for exact comparisons."""
    found = words(text)
    if not found:
        return frozenset()
    return frozenset(b" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))
