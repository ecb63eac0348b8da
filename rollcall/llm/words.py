"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than space and 0x09 to 0x0D; A-Z count as a-z. Its hash is the sum of random byte values, each times a
random number for its place in the word, then mixed. With ``rolling`` it is a polynomial, which can be taken of any part of a word as
well, but which different words of regular patterns share.
"""

from __future__ import annotations

import numpy as np

_random = np.random.default_rng(20240607)
BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE[65:91] = BYTE_VALUE[97:123]
IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
BASE = 0x9E3779B97F4A7C15
PLACE = _random.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHINGLE = 5


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits of the argument."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def numbers_of(place: np.ndarray) -> np.ndarray:
    return mix(mix(place.astype(np.uint64) * np.uint64(BASE) + PLACE[6])) | np.uint64(1)


#: The numbers of the places that most words have.
NUMBERS = numbers_of(np.arange(256))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def running_hash(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``out[i]``: the polynomial of the first i bytes, so that ``out[j] - out[i]`` belongs to bytes i to j, times BASE ** i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(BASE, len(data)), out=out[1:])
    return out


def inverse_powers(n: int) -> np.ndarray:
    return powers(pow(BASE, -1, 1 << 64), n)


def by_place(word: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each byte the random number of its place in its word."""
    at = np.arange(len(word))
    place = at - np.maximum.accumulate(np.where(begins, at, 0))
    out = NUMBERS[np.minimum(place, len(NUMBERS) - 1)]
    far = np.flatnonzero(word & (place >= len(NUMBERS)))
    out[far] = numbers_of(place[far])
    return out


def words(data: np.ndarray, offsets: np.ndarray, rolling: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word, and the first word of each text with the number of words at the end."""
    word = IS_WORD[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[filled] = word[filled]
    lasts = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    ends[lasts] = word[lasts]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if rolling:
        sums = running_hash(data, BYTE_VALUE)
        hashes = mix((sums[last] - sums[first]) * inverse_powers(len(data) + 1)[first])
    else:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * by_place(word, begins), out=sums[1:])
        hashes = mix(sums[last] - sums[first] + (last - first).astype(np.uint64) * PLACE[7])
    return hashes, first, last, np.searchsorted(first, offsets)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """For each text its distinct shingles of ``size`` words, ascending; with fewer words the whole sequence is the only one."""
    n, out = len(hashes), []
    grams = np.zeros(max(0, n - size + 1), np.uint64)
    for j in range(size):
        grams += hashes[j : j + len(grams)] * PLACE[j]
    grams = mix(grams)
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if last - first >= size:
            own = np.sort(grams[first : last - size + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif last > first:
            out.append(mix((hashes[first:last] * PLACE[: last - first]).sum(dtype=np.uint64, keepdims=True) + np.uint64(last - first)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def hash_of(word: str) -> int:
    """The hash of one word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(words(data, np.array([0, len(data)]), rolling=True)[0][0])
