"""Word shingles of whole texts as 64-bit hashes, computed on the text's bytes with numpy."""

from __future__ import annotations

import numpy as np

SHINGLE = 5

_rng = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MULT = 0x5851F42D4C957F2D
_INV = pow(_MULT, -1, 1 << 64)
_PLACE = np.array([pow(0xD1342543DE82EF95, k + 1, 1 << 64) for k in range(SHINGLE)], dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; grown by doubling and kept by the worker."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, dtype=np.uint64)
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    _powers[base] = have
    return have[:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (a published finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each span of bytes, A-Z as a-z: a polynomial from running sums over all bytes."""
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _power_table(_MULT, len(b)), dtype=np.uint64)])
    return mix64((run[ends] - run[starts]) * _power_table(_INV, len(b))[starts])


def word_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One hash for each word between ASCII white space, A-Z lower-cased; byte starts and ends."""
    if not text:
        none = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), none, none
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    space = np.concatenate([[True], _SPACE[b], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    return span_hashes(b, starts, ends), starts, ends


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; fewer words are one run."""
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    width = min(n, size)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out += words[k : n - width + 1 + k] * _PLACE[k]
    return mix64(out)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(shingle_hashes(word_hashes(text)[0]))
