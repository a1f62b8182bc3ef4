"""Words of many texts at once: places and 64-bit hashes by NumPy over the bytes of an Arrow array."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at a time.
STRETCH = 1 << 20

_random = np.random.default_rng(20240229)
#: A random odd number for each byte; 0 for a separator.
BYTE_VALUE = _random.integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE[0] = 0
STEP = np.uint64(0x9E3779B97F4A7C15)


def _classes(kept: bytes, fold: bool) -> np.ndarray:
    found = np.zeros(256, np.uint8)
    for byte in kept:
        found[byte] = byte + 32 if fold and 65 <= byte <= 90 else byte
    if 0 in kept:
        # The null character takes the class of the blank, which is none of the kept bytes.
        found[0] = 32
    return found


#: Byte classes: 0 separates words, A-Z become a-z. Letters and digits with everything beyond ASCII, or all but white space.
ALNUM = _classes(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]), True)
VISIBLE = _classes(bytes(byte for byte in range(256) if byte not in b" \t\n\x0b\x0c\r"), True)
#: The same with case, and every byte as it is (a null character hashes by its place).
EXACT = _classes(bytes(byte for byte in range(256) if byte not in b" \t\n\x0b\x0c\r"), False)
ALL = np.arange(256, dtype=np.uint8)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    return values * np.uint64(0x94D049BB133111EB)


def word_places(data: np.ndarray, marks: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; texts end at ``marks``, and no word goes over one."""
    inside = classes[data] > 0
    starts, ends = inside.copy(), inside.copy()
    inner = marks[(marks > 0) & (marks < len(data))]
    joined = inside[1:] & inside[:-1]
    joined[inner - 1] = False
    starts[1:] &= ~joined
    ends[:-1] &= ~joined
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's folded bytes, computed over bounded stretches of ``data``."""
    found = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + STRETCH, side="right")))
        lengths = ends[first:last] - starts[first:last]
        offsets = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum()))
        within = place - np.repeat(offsets, lengths)
        values = BYTE_VALUE[classes[data[within + np.repeat(starts[first:last], lengths)]]]
        values = mix(values + (within.astype(np.uint64) + np.uint64(1)) * STEP)
        found[first:last] = mix(np.add.reduceat(values, offsets) + lengths.astype(np.uint64))
        first = last
    return found


def text_bounds(starts: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Index of the first word of each text, and the number of words at the end."""
    return np.searchsorted(starts, marks, side="left")


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` neighbouring words of one text."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(count, np.uint64)
    for place in range(size):
        found = mix(found * np.uint64(5) + words[place : place + count] + np.uint64(place + 1))
    return found
