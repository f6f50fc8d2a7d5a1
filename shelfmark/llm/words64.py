"""64-bit hashes of the words of many texts at once.

Works on the bytes of all texts of a batch, so no Python runs per word.
"""

from __future__ import annotations

import numpy as np

from shelfmark.llm.common import mix

POWER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(POWER), -1, 1 << 64))
SALT = np.uint64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def _byte_values(lower: bool) -> np.ndarray:
    """A random 64-bit value per byte, equal for a letter's two cases if ``lower``."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * SALT)
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


BYTE_VALUES = _byte_values(True)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(which: int, factor: np.uint64, size: int) -> np.ndarray:
    """The first ``size`` powers of ``factor`` modulo 2^64, kept for later calls up to four million."""
    if len(_powers[which]) < size:
        made = np.full(max(size, 1 << 20), factor, np.uint64)
        made[0] = 1
        made = np.cumprod(made, dtype=np.uint64)
        if size > 1 << 22:
            return made[:size]
        _powers[which] = made
    return _powers[which][:size]


def hash_words(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word ``[^\\x20\\x09-\\x0D]+``, A-Z taken as a-z, in order.

    ``data`` holds the texts one after the other and ``places`` their beginnings and the end.
    """
    return hash_spans(data, places)[:2]


def hash_spans(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same, and where each word begins and ends in ``data``."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = places[:-1][np.diff(places) > 0]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[data] * _grown(0, POWER, len(data)), out=sums[1:])
    value = (sums[end] - sums[start]) * _grown(1, INVERSE, len(data))[start]
    owner = np.searchsorted(places, start, "right") - 1
    return mix(value + (end - start).astype(np.uint64) * SALT), owner, start, end
