"""Words of whole Arrow columns as arrays: where they lie and a 64-bit hash of each, without a loop over words."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from tiffinmart.llm.frames import byte_view

#: Odd multiplier of the rolling hash, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Words(NamedTuple):
    data: np.ndarray  # bytes of all texts, A-Z lowered
    starts: np.ndarray  # of each word in `data`
    ends: np.ndarray
    rows: np.ndarray  # text of each word
    counts: np.ndarray  # words of each text
    hashes: np.ndarray  # uint64 of each word


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Karp-Rabin hash of each span of `values` (uint64), by differences of one running sum."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values))[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(_INVERSE, len(values))[starts])


def byte_values(data: np.ndarray) -> np.ndarray:
    """A fixed large number for each byte value."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))[data]


def words(texts: pa.Array) -> Words:
    """Words `[^\\x20\\x09-\\x0D]+` of each text, A-Z lowered; a null text has none."""
    raw, offsets = byte_view(texts)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    space = np.zeros(256, bool)
    space[[0x20, 9, 10, 11, 12, 13]] = True
    data, gap = lower[raw], space[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[True], gap[:-1]]) if len(raw) else gap
    after = np.concatenate([gap[1:], [True]]) if len(raw) else gap
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return Words(data, starts, ends, rows, np.bincount(rows, minlength=len(offsets) - 1), span_hashes(byte_values(data), starts, ends))


def shingles(w: Words, size: int, whole_if_short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each run of `size` words; a text with fewer words gives its whole sequence as one."""
    first = np.concatenate([[0], np.cumsum(w.counts)])
    at = np.arange(len(w.rows))
    full = at + size <= first[w.rows + 1]
    begin, end = at[full], at[full] + size
    rows = w.rows[full]
    if whole_if_short:
        short = np.flatnonzero((w.counts > 0) & (w.counts < size))
        begin, end = np.concatenate([begin, first[short]]), np.concatenate([end, first[short + 1]])
        rows = np.concatenate([rows, short])
    return span_hashes(w.hashes, begin, end), rows
