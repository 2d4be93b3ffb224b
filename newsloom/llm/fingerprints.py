"""Hashes of words, shingles and windows of one text, with numpy.

All hashes are 64 bits wide. A polynomial (Rabin-Karp) hash is kept as prefix sums of `value * BASE**place`, modulo 2**64;
as BASE is odd it has an inverse, and the hash of any stretch is a difference of two sums, scaled back.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
INVERSE = U64(pow(int(BASE), -1, 2**64))
_MIX_1, _MIX_2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_powers = {int(BASE): np.ones(1, dtype=U64), int(INVERSE): np.ones(1, dtype=U64)}


def powers(base: U64, n: int) -> np.ndarray:
    """base**0 ... base**(n-1); kept between calls."""
    have = _powers[int(base)]
    if len(have) < n:
        have = np.full(max(n, 2 * len(have)), base, dtype=U64)
        have[0] = 1
        have = _powers[int(base)] = np.cumprod(have, dtype=U64)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits; a bijection."""
    x = (x ^ (x >> U64(33))) * _MIX_1
    x = (x ^ (x >> U64(33))) * _MIX_2
    return x ^ (x >> U64(33))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end], mixed with their lengths."""
    plain = (sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts]
    return mixed(plain + (ends - starts).astype(U64) * _MIX_1)


def window_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all stretches of `size` values."""
    if len(sums) <= size:
        return np.zeros(0, dtype=U64)
    plain = sums[size:] - sums[:-size]
    return mixed(plain * powers(INVERSE, len(plain)) + U64(size * int(_MIX_1) % 2**64))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words among the bytes of a text."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def word_hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash for each word of a text given as bytes, A-Z lower-cased on demand."""
    starts, ends = word_bounds(data)
    if lower:
        data = _LOWER[data]
    return stretch_hashes(prefix_sums(data.astype(U64) + U64(1)), starts, ends)


def as_bytes(text: str | bytes) -> np.ndarray:
    return np.frombuffer(text.encode() if isinstance(text, str) else text, dtype=np.uint8)


#: Low bits that hold a place when the smallest hash in a stretch is looked for, and the longest stretch so possible.
PLACE_BITS = 24
MOST_PLACES = 1 << PLACE_BITS


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each stretch of `width` grams, the place of the gram with the smallest hash, the first one of equals.

    Only the gram's contents and order within the stretch decide, so equal stretches choose alike wherever they lie.
    """
    n = len(grams)
    if n >= MOST_PLACES:
        raise ValueError("cut longer texts into overlapping pieces")
    if n < width:
        return np.zeros(0, dtype=np.int64)
    places = U64(MOST_PLACES - 1)
    least = (grams & ~places) | np.arange(n, dtype=U64)
    done = 1
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[:n - width + 1], least[width - done:])
    return (least & places).astype(np.int64)


def runs(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of neighbouring windows with the same anchor: first window, and the one after the last."""
    if len(chosen) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    cuts = np.flatnonzero(np.diff(chosen)) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts, [len(chosen)]])


def union(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the stretches."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def as_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
