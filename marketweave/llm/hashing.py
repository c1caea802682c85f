"""Word and shingle hashes of many texts at once, as numpy passes over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def _words(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1)


#: A-Z become a-z; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes 32 and 9 to 13 part words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = _words(11, 256)
_BASE = int(_words(12, 1)[0])
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _words(13, 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; a million are kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            full = np.full(max(n, 1 << 20), base, dtype=np.uint64)
            full[0] = 1
            have = np.multiply.accumulate(full)
        if n <= 1 << 20:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all its bits (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        return x ^ (x >> _U(32))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which span() has the hash of any stretch of bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def span(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of bytes start to end; equal for equal bytes wherever they stand."""
    with np.errstate(over="ignore"):
        return mix((sums[end] - sums[start]) * powers(_INVERSE, len(sums))[start] + (end - start).astype(np.uint64) * _PLACE[63])


def find_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are no white space, within one text) and the number of the text each is in."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    solid = ~SPACE[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = solid[:-1]
    inner = at[(at > 0) & (at < n)]
    before[inner] = False
    before[0] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = solid[1:]
    after[inner - 1] = False
    start, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return start, end, np.searchsorted(at, start, "right") - 1


def shingles(data: np.ndarray, at: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles of lower-cased texts and the bounds of each text's own; a text of 1 to k-1 words has one, its whole sequence."""
    data = LOWER[data]
    start, end, text = find_words(data, at)
    count = np.bincount(text, minlength=len(at) - 1) if len(text) else np.zeros(len(at) - 1, dtype=np.int64)
    words = span(prefix_sums(data), start, end)
    first = np.concatenate(([0], np.cumsum(count)))
    number = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    bounds = np.concatenate(([0], np.cumsum(number)))
    owner = np.repeat(np.arange(len(count)), number)
    base = first[owner] + np.arange(len(owner)) - bounds[owner]
    size = np.minimum(count, k)[owner]
    out = size.astype(np.uint64) * _PLACE[62]
    with np.errstate(over="ignore"):
        for j in range(k):
            has = size > j
            if has.all():
                out += words[base + j] * _PLACE[j]
            else:
                out[has] += words[base[has] + j] * _PLACE[j]
    return mix(out), bounds
