"""Suffix arrays by two-stage sorting, in numpy.

Symbols are small whole numbers and 0 ends a piece; what follows a 0 counts as equal. Suffixes are in order as far as
their first `DEPTH` symbols tell.
"""

from __future__ import annotations

import numpy as np

#: Symbols in one 63-bit word, and words that are compared.
PACKED, WORDS = 7, 15
DEPTH = PACKED * WORDS


class Packed:
    """The next `PACKED` symbols of every suffix as one number, zero behind the end of its piece."""

    def __init__(self, s: np.ndarray):
        n = len(s)
        ends = np.flatnonzero(s == 0)
        self.left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # symbols before the end
        wide = np.concatenate([s, np.zeros(PACKED, s.dtype)]).astype(np.uint64)
        word = np.zeros(n, np.uint64)
        for k in range(PACKED):
            word = (word << np.uint64(9)) | wide[k : k + n]
        kept = np.array([((1 << 63) - 1) & ~((1 << (9 * (PACKED - k))) - 1) for k in range(PACKED + 1)], np.uint64)
        self.word = word & kept[np.minimum(self.left, PACKED)]

    def at(self, suffixes: np.ndarray, k: int) -> np.ndarray:
        """Word `k` of suffixes."""
        far = PACKED * k
        inside = self.left[suffixes] > far
        return np.where(inside, self.word[np.minimum(suffixes + far, len(self.word) - 1)], np.uint64(0))

    def sorted(self, suffixes: np.ndarray) -> np.ndarray:
        """By content: all by their first word, then only those that still tie, word by word."""
        first = self.word[suffixes]
        order = np.argsort(first, kind="stable")
        out, key = suffixes[order], first[order]
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(out) else key.astype(np.int64)
        open_at = np.arange(len(out))
        for k in range(1, WORDS):
            g = group[open_at]
            tied = np.concatenate([[False], g[1:] == g[:-1]])
            tied[:-1] |= tied[1:].copy()
            open_at, g = open_at[tied], g[tied]
            # A suffix that has ended has no more to compare.
            if not len(open_at):
                break
            members = out[open_at]
            key = self.at(members, k)
            order = np.lexsort((key, g))
            out[open_at], key, g = members[order], key[order], g[order]
            new = np.concatenate([[True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])])
            group[open_at] = open_at[new][np.cumsum(new) - 1]
        return out


def two_stage(s: np.ndarray, packed: Packed) -> np.ndarray:
    """Suffix array of `s`, whose last symbol is 0.

    Suffixes smaller than their successor are sorted directly. Every other one follows from its successor: a scan over
    the buckets of first symbols, from the least, puts the predecessor of each suffix at the head of its own bucket.
    """
    n, size = len(s), int(s.max(initial=0)) + 1
    step = np.sign(np.diff(s.astype(np.int32)))
    step = np.concatenate([step, [1]])
    # Equal neighbours have the type of the next unequal one.
    turn = np.where(step != 0, np.arange(n), n)
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    induced = step[turn] < 0
    count = np.bincount(s, minlength=size)
    start = np.concatenate([[0], np.cumsum(count)])
    n_induced = np.bincount(s[induced], minlength=size)
    sa = np.empty(n, np.int64)

    direct = packed.sorted(np.flatnonzero(~induced))
    symbol = s[direct].astype(np.int64)
    first = np.concatenate([[0], np.cumsum(count - n_induced)])
    sa[start[symbol] + n_induced[symbol] + np.arange(len(direct)) - first[symbol]] = direct

    head = start[:-1].copy()
    for c in np.flatnonzero(count).tolist():
        low = start[c]
        while low < head[c]:  # runs of one symbol feed their own bucket
            before = sa[low : head[c]] - 1
            low = head[c]
            before = before[before >= 0]
            before = before[(s[before] == c) & induced[before]]
            sa[low : low + len(before)] = before
            head[c] += len(before)
        before = sa[start[c] : start[c + 1]] - 1
        before = before[before >= 0]
        symbol = s[before].astype(np.int64)
        before, symbol = before[symbol > c], symbol[symbol > c]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        n_each = np.bincount(symbol, minlength=size)
        within = np.arange(len(symbol)) - (np.cumsum(n_each) - n_each)[symbol]
        sa[head[symbol] + within] = before
        head += n_each
    return sa


def common_prefixes(sa: np.ndarray, packed: Packed, most: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in `sa`, up to `most` symbols (at most `DEPTH`)."""
    out = np.zeros(len(sa), np.int64)
    live = np.arange(1, len(sa))
    for k in range(-(-most // PACKED)):
        x = packed.at(sa[live], k) ^ packed.at(sa[live - 1], k)
        bits = np.zeros(len(x), np.int64)
        unequal = x != 0
        # Equal leading symbols of 9 bits in words of 63: from the place of the highest differing bit.
        bits[unequal] = np.frexp((x[unequal] >> np.uint64(9)).astype(np.float64))[1] + 9
        small = unequal & (x < 512)
        bits[small] = np.frexp(x[small].astype(np.float64))[1]
        out[live] += np.where(unequal, (63 - bits) // 9, PACKED)
        live = live[~unequal]
    out = np.minimum(out, most)
    return np.minimum(out, np.concatenate([[0], np.minimum(packed.left[sa[1:]], packed.left[sa[:-1]])])) if len(sa) else out
