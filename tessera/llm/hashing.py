"""Hashes of words and word shingles over many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text that are hashed at once.
BLOCK = 1 << 19

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(0x100000001B3)
#: White space and the other ASCII characters that are no letters or digits.
_GAP = np.array([not (c >= 128 or chr(c).isalnum()) for c in range(256)])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _PRIME
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts in lower case, words being what stands between gaps; and how many words each text has."""
    coded = [b" " + t.lower().encode("utf-8", "replace") + b" " for t in texts]
    sizes = np.array([len(c) for c in coded], np.int64)
    raw = np.frombuffer(b"".join(coded), np.uint8)
    gap = _GAP[raw]
    starts, ends = np.flatnonzero(~gap[1:] & gap[:-1]) + 1, np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    length = ends - starts
    first = np.cumsum(length) - length
    inside = np.flatnonzero(~gap)
    power = np.cumprod(np.full(int(length.max()), _POWER, np.uint64))
    value = (raw[inside].astype(np.uint64) + np.uint64(1)) * power[np.arange(len(inside)) - np.repeat(first, length)]
    of = np.searchsorted(np.cumsum(sizes), starts, "right")
    return mixed(np.add.reduceat(value, first)), np.bincount(of, minlength=len(texts))


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order. A text of fewer words has one shingle of all of them, one without words the empty shingle."""
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total + len(texts[end]) <= BLOCK):
            total += len(texts[end])
            end += 1
        hashes, counts = word_hashes(texts[at:end])
        sums = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for j in range(words):
            sums = sums * _POWER + hashes[j : j + len(sums)]
        sums = mixed(sums)
        first = 0
        for n in counts.tolist():
            if n >= words:
                yield np.unique(sums[first : first + n - words + 1])
            else:
                short = n
                for h in hashes[first : first + n].tolist():
                    short = (short * int(_POWER) + h) % (1 << 64)
                yield mixed(np.array([short], np.uint64))
            first += n
        at = end
