"""Hashes of words and word shingles of whole texts, computed on byte arrays."""

from __future__ import annotations

import numpy as np

# Bytes hashed at once; a text is cut only between words.
BLOCK = 2 * 1024 * 1024
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _table() -> np.ndarray:
    """A random number for each byte; A-Z as a-z."""
    numbers = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    numbers[65:91] = numbers[97:123]
    return numbers


TABLE = _table()
BASE = 0x5851F42D4C957F2D


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, BASE, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _block(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each word, hash of each word) of bytes that end in white space."""
    white = WHITE[raw]
    solid = ~white
    first = solid.copy()
    first[1:] &= white[:-1]
    starts = np.flatnonzero(first)
    if not starts.size:
        return starts, np.zeros(0, np.uint64)
    packed = raw[solid]
    begins = (np.cumsum(solid) - 1)[starts]
    lengths = np.diff(np.append(begins, packed.size))
    place = np.arange(packed.size) - np.repeat(begins, lengths)
    sums = np.add.reduceat(TABLE[packed] * _powers(int(lengths.max()))[place], begins)
    return starts, mixed(sums + lengths.astype(np.uint64))


def _cut(raw: bytes) -> list[tuple[int, int]]:
    """Blocks of about ``BLOCK`` bytes that end behind white space."""
    cuts, begin = [], 0
    while begin < len(raw):
        end = min(begin + BLOCK, len(raw))
        while end < len(raw) and raw[end - 1] not in b" \t\n\v\f\r":
            end += 1
        cuts.append((begin, end))
        begin = end
    return cuts


def hash_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, index of each text's first word and one more for the end).

    Words are runs without space or the controls 9 to 13; A-Z count as a-z.
    """
    encoded = [t.encode("utf-8", "replace") for t in texts]
    raw = b" ".join(encoded) + b" "
    offsets = np.cumsum([0, *(len(e) + 1 for e in encoded)])
    view = np.frombuffer(raw, np.uint8)
    found = [(a, *_block(view[a:b])) for a, b in _cut(raw)]
    starts = np.concatenate([s + a for a, s, _ in found])
    return np.concatenate([h for _, _, h in found]), np.searchsorted(starts, offsets)


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` words, in order."""
    sums = np.zeros(words.size - n + 1, np.uint64)
    for i in range(n):
        sums = sums * np.uint64(BASE) + words[i : words.size - n + 1 + i]
    return mixed(sums + np.uint64(n))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of one text; a shorter text is one shingle of all its words."""
    return np.unique(windows(words, min(k, words.size))) if words.size else words
