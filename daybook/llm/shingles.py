"""Hashed word shingles of whole texts, in numpy."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = int(_RNG.integers(1, 2**62)) * 2 + 1
_STEP_INVERSE = pow(_STEP, -1, 2**64)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | _U(1)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i below n."""
    key = str(base)
    known = _powers.get(key)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 20), _U(base), dtype=np.uint64)
        steps[0] = 1
        known = _powers[key] = np.multiply.accumulate(steps)
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers (splitmix64's published constants)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs without blanks, A-Z in lower case) of the texts one
    after the other, and the offsets at which each text's words start (one more at the end).

    A word's hash is a difference of prefix sums over random byte values times powers of an
    odd base, brought to the same power, so no step loops over words or bytes in Python.
    """
    raw = b"\n".join(raws).lower()
    b = np.frombuffer(raw, dtype=np.uint8)
    word = np.zeros(len(b) + 2, dtype=np.int8)
    word[1:-1] = ~_BLANK[b]
    edge = np.diff(word)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
    firsts = np.concatenate(([0], np.cumsum(lengths + 1)))
    offsets = np.searchsorted(start, firsts)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[b] * _power(_STEP, len(b)), out=sums[1:])
        h = (sums[end] - sums[start]) * _power(_STEP_INVERSE, len(b) + 1)[start]
        return mix(h + (end - start).astype(np.uint64)), offsets


def shingle_sets(raws: list[bytes], width: int = 4) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its ``width``-word shingles; the whole
    sequence as one shingle if it has fewer words, none if it has no words."""
    if not raws:
        return []
    w, at = word_hashes(raws)
    out = []
    with np.errstate(over="ignore"):
        n = max(0, len(w) - width + 1)
        full = np.full(n, _U(width), dtype=np.uint64)
        for i in range(width if n else 0):
            full += w[i:n + i] * _PLACE[i]
        full = mix(full)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= width:
                s = np.sort(full[a:b - width + 1])
                keep = np.ones(len(s), dtype=bool)
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                out.append(s[keep])
            elif b > a:
                whole = (w[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64) + _U(b - a)
                out.append(mix(np.array([whole], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
