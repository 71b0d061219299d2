"""Word shingles of many texts at once, as 64-bit hashes, with numpy.

Words are maximal runs outside \\x20 and \\x09-\\x0D of the UTF-8 bytes, with A-Z lower-cased. A word's hash sums one random
number per (place, byte), drawn by a fixed rule; a shingle's hash mixes those of its words in order.
"""

from __future__ import annotations

import numpy as np

_PLACES = 32


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE = _mix((np.arange(_PLACES * 256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)).reshape(-1)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the number of words of each text."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = ~_BLANK[raw]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # of each word, within at
    lengths = np.diff(first, append=len(at))
    place = np.arange(len(at), dtype=np.int64) - np.repeat(first, lengths)
    h = _TABLE[(np.minimum(place, _PLACES - 1) << 8) + _LOWER[raw[at]]]
    if lengths.max() > _PLACES:
        late = np.flatnonzero(place >= _PLACES)
        h[late] = _mix(h[late] + place[late].astype(np.uint64) * _ODD[0])
    words = _mix(np.add.reduceat(h, first) + lengths.astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(at[first], ends)
    return words, np.diff(upto, prepend=0)


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts): text i has the sorted distinct hashes[starts[i]:starts[i + 1]].

    A text of fewer words than width, but not none, has its whole sequence as its one shingle.
    """
    words, counts = word_hashes(texts)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), n)
    base = np.concatenate([[0], np.cumsum(counts)[:-1]])
    within = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    at = base[owner] + within
    h = np.zeros(len(owner), np.uint64)
    short = counts[owner] < width
    size = np.where(short, counts[owner], width)
    for k in range(width):
        has = size > k
        h += np.where(has, words[np.minimum(at + k, max(len(words) - 1, 0))] * _ODD[k] if len(words) else np.uint64(0), np.uint64(0))
        h = np.where(has, (h ^ (h >> np.uint64(29))) * _ODD[7], h)
    h = _mix(h + size.astype(np.uint64))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    return h, np.searchsorted(owner, np.arange(len(texts) + 1))
