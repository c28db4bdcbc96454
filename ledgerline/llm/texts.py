"""Word and hash helpers that several operators share (numpy over whole UTF-8 texts)."""

from __future__ import annotations

import numpy as np

#: fixed values: the white space of all word rules, bytes 9 to 13 and 32
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POSITIONS = 64
with np.errstate(over="ignore"):
    #: one 64-bit value for each byte value and place in a word (tabulation hashing)
    _TABLE = mix64((np.arange(_POSITIONS * 256, dtype=np.uint64) + np.uint64(1))
                   * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text with A-Z lower-cased.

    A word's hash is the sum of a random value for each (byte, place); places from 64 on derive
    theirs by mixing, so words of any length count whole.
    """
    if not text:
        return np.empty(0, dtype=np.uint64)
    raw = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    inside = ~_IS_SPACE[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start = np.flatnonzero(edge == 1)
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    end = np.flatnonzero(edge == -1)
    at = np.flatnonzero(inside)
    length = end - start
    place = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    byte = raw[at].astype(np.int64)
    with np.errstate(over="ignore"):
        value = _TABLE[np.minimum(place, _POSITIONS - 1) * 256 + byte]
        far = place >= _POSITIONS
        if far.any():
            value[far] = mix64(value[far] + place[far].astype(np.uint64)
                               * np.uint64(0x9E3779B97F4A7C15))
        sums = np.add.reduceat(value, np.cumsum(length) - length)
        return mix64(sums)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words, in order; of the whole sequence if there are fewer."""
    if not len(words):
        return words
    k = min(k, len(words))
    with np.errstate(over="ignore"):
        n = len(words) - k + 1
        h = np.full(n, np.uint64(k), dtype=np.uint64)
        for i in range(k):
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n])
    return h
