"""Suffix arrays by induced sorting, on whole numpy arrays."""

from __future__ import annotations

import numpy as np

from .common import BASE, BASE_INV, mix

#: Reduced strings with more names than this are sorted by doubling: induction walks one bucket per name.
MAX_NAMES = 2048


def _types(t: np.ndarray) -> np.ndarray:
    """True for S-type suffixes (smaller than the next one); the last symbol must be a unique least one."""
    n = t.size
    differs = np.flatnonzero(t[:-1] != t[1:])
    after = np.searchsorted(differs, np.arange(n - 1))
    s = np.ones(n, bool)
    at = differs[np.minimum(after, differs.size - 1)]
    s[:-1] = t[at] < t[at + 1]
    return s


def _place(sa: np.ndarray, ends: np.ndarray, where: np.ndarray, symbols: np.ndarray, step: int) -> None:
    """Append positions to their buckets in order; ``step`` 1 fills upwards from ``ends``, -1 downwards."""
    order = np.argsort(symbols, kind="stable")
    symbols, where = symbols[order], where[order]
    counts = np.bincount(symbols, minlength=ends.size)
    rank = np.arange(symbols.size) - (np.cumsum(counts) - counts)[symbols]
    sa[ends[symbols] + (rank if step > 0 else -1 - rank)] = where
    ends += counts if step > 0 else -counts


def induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """All suffixes in order, induced from the leftmost S-type ones given in order.

    Buckets are visited once upwards for L-type and once downwards for S-type
    suffixes; a bucket that feeds itself (runs of one symbol) goes in waves.
    """
    sizes = np.bincount(t, minlength=k)
    end = np.cumsum(sizes)
    start = end - sizes
    low = np.bincount(t[~s], minlength=k)  # L-type suffixes come first in a bucket
    sa = np.full(t.size, -1, np.int64)
    lms_at = np.searchsorted(t[lms], np.arange(k + 1))  # lms is ordered by first symbol
    heads = start.copy()
    for c in np.flatnonzero(sizes):
        lo = start[c]
        while lo < heads[c]:
            cur, lo = sa[lo:heads[c]], heads[c]
            prev = cur[cur > 0] - 1
            prev = prev[~s[prev]]
            if prev.size:
                _place(sa, heads, prev, t[prev], 1)
        prev = lms[lms_at[c]:lms_at[c + 1]] - 1
        prev = prev[prev >= 0]
        if prev.size:  # the symbol before a leftmost S-type suffix is L-type
            _place(sa, heads, prev, t[prev], 1)
    tails = end.copy()
    for c in np.flatnonzero(sizes)[::-1]:
        hi = end[c]
        if c == t[-1]:
            sa[hi - 1] = t.size - 1
            tails[c] -= 1
        while tails[c] < hi:
            cur, hi = sa[tails[c]:hi][::-1], tails[c]
            prev = cur[cur > 0] - 1
            prev = prev[s[prev]]
            if prev.size:
                _place(sa, tails, prev, t[prev], -1)
        cur = sa[start[c]:start[c] + low[c]][::-1]
        prev = cur[cur > 0] - 1
        prev = prev[s[prev]]
        if prev.size:
            _place(sa, tails, prev, t[prev], -1)
    return sa


def _doubling(names: np.ndarray) -> np.ndarray:
    """Suffix order of a reduced string whose last name is a unique least one."""
    rank, k = names.astype(np.int64), 1
    while True:
        nxt = np.zeros_like(rank)
        nxt[:-k] = rank[k:] + 1 if k < rank.size else 0
        key = rank * (rank.size + 2) + nxt
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = np.empty_like(rank)
        rank[order] = new
        if new[-1] == rank.size - 1:
            return order
        k *= 2


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of symbols below ``k``; the last symbol must be a unique least one."""
    if t.size < 3:
        return np.argsort(t, kind="stable")
    s = _types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    first = induce(t, s, lms[np.argsort(t[lms], kind="stable")], k)
    is_lms = np.zeros(t.size, bool)
    is_lms[lms] = True
    ordered = first[is_lms[first]]
    # equal leftmost S-type substrings (up to and with the next one's start) get one name
    hashes = Prefixes(t)
    stop = np.full(t.size, t.size, np.int64)
    stop[lms[:-1]] = lms[1:] + 1
    length = stop[ordered] - ordered
    h = hashes.of(ordered, length)
    names = np.empty(t.size, np.int64)
    names[ordered] = np.concatenate(([0], np.cumsum((h[1:] != h[:-1]) | (length[1:] != length[:-1]))))
    reduced = names[lms]
    m = int(reduced.max()) + 1
    if m == reduced.size:
        order = np.argsort(reduced)
    elif m <= MAX_NAMES:
        order = suffix_array(reduced, m)
    else:
        order = _doubling(reduced)
    return induce(t, s, lms[order], k)


class Prefixes:
    """Hash of any substring of a symbol array, from prefix sums."""

    def __init__(self, t: np.ndarray):
        power, back = np.full(t.size + 1, BASE, np.uint64), np.full(t.size + 1, BASE_INV, np.uint64)
        power[0] = back[0] = 1
        self.back = np.multiply.accumulate(back)
        self.total = np.zeros(t.size + 1, np.uint64)
        np.cumsum(mix(t.astype(np.uint64), 31) * np.multiply.accumulate(power)[:-1], out=self.total[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return mix((self.total[start + length] - self.total[start]) * self.back[start])


def repeated_starts(t: np.ndarray, sa: np.ndarray, length: int) -> np.ndarray:
    """True where a substring of ``length`` symbols starts that also starts elsewhere.

    Permuted common prefixes: each suffix is compared, in text order, with the
    one before it in the suffix array; both are repeated where the common
    prefix reaches ``length``.
    """
    phi = np.full(t.size, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    hashes = Prefixes(t)
    i = np.flatnonzero(phi >= 0)
    i = i[(i + length <= t.size) & (phi[i] + length <= t.size)]
    own = hashes.of(np.arange(t.size - length + 1), length) if t.size >= length else np.zeros(0, np.uint64)
    same = i[own[i] == own[phi[i]]]
    out = np.zeros(t.size, bool)
    out[same] = True
    out[phi[same]] = True
    return out
