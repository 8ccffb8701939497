"""Hashed word shingles of whole texts, many rows at a time."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Multipliers of a shingle's words, by place.
_PLACES = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


#: The longest table of powers so far, by base. (A cached function would not travel with its code.)
_tables: dict[int, np.ndarray] = {}


def powers(base: int, length: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    out = _tables.get(base, np.ones(1, np.uint64))
    while len(out) < length:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    _tables[base] = out
    return out[:length]


def stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased, and how many words precede each row.

    Words are runs of bytes other than 0x20 and 0x09 to 0x0D; they end where their row ends.
    """
    size = 1 << max(12, int(len(data) + 1).bit_length())
    lower = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    inside = (data != 32) & ((data < 9) | (data > 13))
    first, last = inside.copy(), inside.copy()
    border = np.zeros(len(data) + 1, bool)
    border[starts] = True
    first[1:] &= ~inside[:-1] | border[1:-1]
    last[:-1] &= ~inside[1:] | border[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * powers(_BASE, size)[: len(data)], out=sums[1:])
    hashed = (sums[end] - sums[begin]) * powers(_INVERSE, size)[begin]
    return stir(hashed + (end - begin).astype(np.uint64)), np.searchsorted(begin, starts)


def shingle_sets(data: np.ndarray, starts: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word shingles of every row; with fewer words, the
    whole sequence as one; without words, none."""
    words, cut = word_hashes(data, starts)
    count = np.diff(cut)
    total = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for place in range(n):
        total += words[place : len(words) - n + 1 + place] * np.uint64(_PLACES[place % len(_PLACES)] + 2 * (place // len(_PLACES)))
    total = stir(total)
    out = []
    for row, k in enumerate(count):
        if k >= n:
            out.append(np.unique(total[cut[row] : cut[row] + k - n + 1]))
        elif k:
            part = words[cut[row] : cut[row + 1]]
            whole = sum(int(w) * _PLACES[i % len(_PLACES)] for i, w in enumerate(part)) + int(k) * 0x2545F4914F6CDD1D
            out.append(stir(np.array([whole & ((1 << 64) - 1)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
