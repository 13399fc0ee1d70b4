"""Suffix arrays by induced sorting, and permuted common prefixes, over one shard's symbols."""

from __future__ import annotations

import numpy as np

#: A bucket costs a few numpy calls: with fewer symbols than this for each, sorting them is cheaper.
SYMBOLS_PER_CALL = 120


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of `t` in their order; the last symbol is 0 and found nowhere else.

    Suffixes are classified as smaller or larger than their right neighbour; substrings between
    leftmost-smaller positions are sorted by induction and named; the string of names, a third as
    long or less, is sorted by recursion; and all suffixes are induced from that in two scans. Short
    strings over many symbols, as those of names are, are sorted by ranks of doubling length.
    """
    n = len(t)
    if n < 3:
        return np.arange(n - 1, -1, -1)
    t = t.astype(np.int32)
    if (int(t.max()) + 1) * SYMBOLS_PER_CALL >= n:
        return _doubled(t)
    rises = _smaller(t)
    lms = np.flatnonzero(rises[1:] & ~rises[:-1]) + 1
    ordered = _induce_waves(t, rises, lms)
    marked = np.zeros(n, bool)
    marked[lms] = True
    ordered = ordered[marked[ordered]]
    names = _names(t, lms, ordered)
    if names[-1] + 1 < len(lms):
        place = np.empty(n, np.int32)
        place[ordered] = names
        ordered = lms[suffix_array(place[lms])]
    return _induce_waves(t, rises, ordered)


def _smaller(t: np.ndarray) -> np.ndarray:
    """Is the suffix smaller than the one that begins a place further on?"""
    n = len(t)
    step = np.sign(t[1:] - t[:-1])
    decides = np.where(step != 0, np.arange(n - 1), n)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    out = np.empty(n, bool)
    out[:-1] = step[decides] > 0
    out[-1] = True
    return out


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """The rank of each leftmost-smaller substring, equal ones with equal ranks."""
    length = np.zeros(len(t), np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        equal = t[a[left] + k] == t[b[left] + k]
        same[left[~equal]] = False
        k += 1
        left = left[equal]
        left = left[length[a[left]] > k]
    return np.r_[0, np.cumsum(~same)]


def _grouped(symbol: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by symbol, the symbols in it, their counts, and each one's place in its group."""
    order = np.argsort(symbol.astype(np.uint16) if k < 1 << 16 else symbol, kind="stable")
    symbol = symbol[order]
    counts = np.bincount(symbol, minlength=k)
    first = np.cumsum(counts) - counts
    return order, symbol, counts, np.arange(len(symbol)) - first[symbol]


def _induce_waves(t: np.ndarray, rises: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Both scans, bucket by bucket; entries that a bucket adds to itself come as a further wave."""
    n, k = len(t), int(t.max()) + 1
    sa = np.empty(n, np.int32)
    size = np.bincount(t, minlength=k)
    end = np.cumsum(size)
    begin = end - size
    order, _, counts, _ = _grouped(t[lms], k)
    seeds = lms[order].astype(np.int32)
    seed_at = np.r_[0, np.cumsum(counts)]

    head = begin.copy()

    def push_larger(found):
        j = found[found > 0] - 1
        j = j[~rises[j]]
        if len(j):
            order, symbol, counts, place = _grouped(t[j], k)
            sa[head[symbol] + place] = j[order]
            np.add(head, counts, out=head)

    for c in np.flatnonzero(size):
        done = begin[c]
        while done < head[c]:
            wave = sa[done : head[c]].copy()
            done = head[c]
            push_larger(wave)
        push_larger(seeds[seed_at[c] : seed_at[c + 1]])

    tail = end.copy()

    def push_smaller(found):
        j = found[found > 0] - 1
        j = j[rises[j]]
        if len(j):
            order, symbol, counts, place = _grouped(t[j], k)
            sa[tail[symbol] - 1 - place] = j[order]
            np.subtract(tail, counts, out=tail)

    for c in np.flatnonzero(size)[:0:-1]:
        done = end[c]
        while done > tail[c]:
            wave = sa[tail[c] : done][::-1].copy()
            done = tail[c]
            push_smaller(wave)
        push_smaller(sa[begin[c] : head[c]][::-1].copy())
    sa[0] = n - 1
    return sa


def _doubled(t: np.ndarray) -> np.ndarray:
    """The suffix array by ranks of the first 2, 4, 8 ... times as many symbols as fit into 63 bits.

    A rank is the first place of its group in the array; groups of one are settled, and only the
    others are sorted again, by the rank of what follows.
    """
    n = len(t)
    bits = int(t.max()).bit_length()
    ahead = max(1, 63 // bits)
    padded = np.zeros(n + ahead, np.int64)
    padded[:n] = t
    key = padded[:n].copy()
    for k in range(1, ahead):
        key <<= bits
        key |= padded[k : k + n]
    sa = np.empty(n, np.int64)
    rank = np.empty(n, np.int64)
    open_, found = np.arange(n), np.arange(n)
    while True:
        order = np.argsort(key)
        found, key = found[order], key[order]
        fresh = np.ones(len(key) + 1, bool)
        fresh[1:-1] = key[1:] != key[:-1]
        begin = np.flatnonzero(fresh)
        sa[open_] = found
        rank[found] = np.repeat(open_[begin[:-1]], np.diff(begin))
        several = ~(fresh[:-1] & fresh[1:])
        open_, found = open_[several], found[several]
        if not len(open_):
            return sa.astype(np.int32)
        # the last symbol is unique: what is not settled goes on beyond the symbols compared
        key = rank[found] << 32 | rank[found + ahead]
        ahead *= 2


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each position, in text order: the symbols its suffix shares with the one before it in
    `sa`, counted up to `most`. Symbols fit into 16 bits; 4 of them are compared at a time."""
    n = len(t)
    padded = np.zeros(n + most + 8, np.uint64)
    padded[:n] = t
    four = (padded[:-3] << np.uint64(48)) | (padded[1:-2] << np.uint64(32)) | (padded[2:-1] << np.uint64(16)) | padded[3:]
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    shared = np.zeros(n, np.int32)
    left = np.flatnonzero(before >= 0)
    for k in range(0, most, 4):
        differs = four[left + k] ^ four[before[left] + k]
        equal = differs == 0
        stop = differs[~equal]
        shared[left[~equal]] = k + (
            (stop < np.uint64(1 << 48)).astype(np.int32)
            + (stop < np.uint64(1 << 32))
            + (stop < np.uint64(1 << 16))
        )
        left = left[equal]
        if not len(left):
            break
    shared[left] = most
    return np.minimum(shared, most)
