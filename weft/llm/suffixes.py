"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Induced sorting (Nong, Zhang and Chan 2009) derives the order of all suffixes from that of the leftmost-smaller ones,
which it finds by sorting their substrings the same way and naming these; if names repeat, the string of names is sorted
by recursion. The scans over the array are sequential by nature. Where there are few buckets, one is scanned in waves:
what a wave adds to its own bucket is the next wave, so each wave is a handful of array operations. Where there are
many, as in the reduced strings, or long runs of one symbol, the scan goes suffix by suffix. Both give the same array.
"""

from __future__ import annotations

import numpy as np

#: Suffixes that a scan passes in the time of one wave.
WAVE_COST = 100


def _smaller_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last symbol is the unique least."""
    n = len(t)
    turn = np.full(n, n, np.int64)
    turn[:-1] = np.where(t[:-1] != t[1:], np.arange(n - 1), n)
    nearest = np.minimum.accumulate(turn[::-1])[::-1]
    out = np.ones(n, bool)
    at = nearest[:-1]
    out[:-1] = t[at] < t[np.minimum(at + 1, n - 1)]
    return out


def _most_waves(t: np.ndarray) -> int:
    """Symbols in use and, for each, the length of its longest run: no scan takes more waves."""
    cuts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1], [True]]))
    longest = np.zeros(int(t.max()) + 1, np.int64)
    np.maximum.at(longest, t[cuts[:-1]], np.diff(cuts))
    return int(longest.sum() + np.count_nonzero(longest))


def _induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array that follows from ``seeds``, the leftmost-smaller suffixes in some order."""
    return (_by_suffix if _most_waves(t) * WAVE_COST > len(t) else _by_waves)(t, small, seeds, sizes)


def _by_suffix(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n, ends = len(t), np.cumsum(sizes)
    # the symbol of the suffix one to the left, if it is larger (or smaller) than this one; free places, -1, read the end
    up, down = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
    np.copyto(up[1:n], t[:-1], where=~small[:-1])
    np.copyto(down[1:n], t[:-1], where=small[:-1])
    up, down = up.tolist(), down.tolist()
    sa = _seeded(t, seeds, sizes, ends).tolist()
    sa[0] = n - 1
    heads = (ends - sizes).tolist()
    for k in sa:
        c = up[k]
        if c >= 0:
            h = heads[c]
            sa[h] = k - 1
            heads[c] = h + 1
    tails = ends.tolist()
    for k in reversed(sa):
        c = down[k]
        if c >= 0:
            tails[c] = h = tails[c] - 1
            sa[h] = k - 1
    sa[0] = n - 1
    return np.array(sa, np.int64)


def _seeded(t: np.ndarray, seeds: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """An array with the seeds, in their order, at the ends of their buckets, and -1 elsewhere."""
    sa = np.full(len(t), -1, np.int64)
    symbols = t[seeds]
    seed_sizes = np.bincount(symbols, minlength=len(sizes))
    order = np.argsort(symbols, kind="stable")
    symbols = symbols[order]
    sa[ends[symbols] - seed_sizes[symbols] + np.arange(len(seeds)) - (np.cumsum(seed_sizes) - seed_sizes)[symbols]] = seeds[order]
    return sa


def _by_waves(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = _seeded(t, seeds, sizes, ends)
    seed_sizes = np.bincount(t[seeds], minlength=len(sizes))

    def put(before: np.ndarray, want_small: bool, place: np.ndarray, down: bool) -> None:
        before = before[before > 0] - 1
        before = before[small[before] == want_small]
        if not len(before):
            return
        symbols = t[before]
        order = np.argsort(symbols, kind="stable")
        symbols, before = symbols[order], before[order]
        counts = np.bincount(symbols, minlength=len(sizes))
        rank = np.arange(len(symbols)) - (np.cumsum(counts) - counts)[symbols]
        if down:
            sa[place[symbols] - 1 - rank] = before
            place -= counts
        else:
            sa[place[symbols] + rank] = before
            place += counts

    heads, used = starts.copy(), np.flatnonzero(sizes)
    for c in used:
        done = starts[c]
        while done < heads[c]:
            wave, done = sa[done : heads[c]], heads[c]
            put(wave, False, heads, False)
        put(sa[ends[c] - seed_sizes[c] : ends[c]], False, heads, False)
    larger_end = heads
    tails = ends.copy()
    for c in used[::-1]:
        done = ends[c]
        while tails[c] < done:
            wave, done = sa[tails[c] : done][::-1], tails[c]
            put(wave, True, tails, True)
        put(sa[starts[c] : larger_end[c]][::-1], True, tails, True)
    sa[0] = len(t) - 1  # the end mark has no suffix after it that could induce it
    return sa


def _by_symbols(t: np.ndarray, small: np.ndarray, places: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For each leftmost-smaller substring the number of lesser ones, found by as many symbols at a time as a machine word
    takes. Symbols come with their type, so no substring is a beginning of another."""
    kind = 2 * t.astype(np.int64) + small + 1
    bits = int(kind.max()).bit_length()
    width = max(1, 62 // bits)
    rank, todo, at = np.zeros(len(places), np.int64), np.arange(len(places)), 0
    while len(todo):
        packed = np.zeros(len(todo), np.int64)
        for k in range(at, at + width):
            packed = packed << bits | np.where(k < length[todo], kind[np.minimum(places[todo] + k, len(t) - 1)], 0)
        order = np.lexsort((packed, rank[todo])) if at else np.argsort(packed, kind="stable")
        group, packed = rank[todo[order]], packed[order]
        other = np.concatenate([[True], group[1:] != group[:-1]])
        first = np.flatnonzero(np.concatenate([[True], other[1:] | (packed[1:] != packed[:-1])]))
        size = np.diff(np.append(first, len(order)))
        begin = np.maximum.accumulate(np.where(other, np.arange(len(order)), 0))[first]
        rank[todo[order]] = np.repeat(group[first] + first - begin, size)
        at += width
        todo = todo[order[np.repeat(size > 1, size)]]
        todo = todo[length[todo] > at]
    return rank


def suffix_array(t: np.ndarray) -> np.ndarray:
    """The suffix array of ``t``, small non-negative integers of which the last is the unique least."""
    if len(t) < 3:
        return np.argsort(t, kind="stable")
    sizes = np.bincount(t)
    small = _smaller_types(t)
    marked = np.zeros(len(t), bool)
    marked[1:] = small[1:] & ~small[:-1]
    places = np.flatnonzero(marked)
    length = np.diff(np.append(places, len(t) - 1)) + 1
    if _most_waves(t) * WAVE_COST > len(t):
        rank = _by_symbols(t, small, places, length)
    else:
        rank = _by_induction(t, small, places, length, marked, sizes)
    unique = np.unique(rank, return_inverse=True)
    ordered = places[np.argsort(rank, kind="stable")]
    if len(unique[0]) < len(rank):
        ordered = places[suffix_array(unique[1])]
    return _induce(t, small, ordered, sizes)


def _by_induction(t: np.ndarray, small: np.ndarray, places: np.ndarray, length: np.ndarray, marked: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same ranks but for gaps, from an induced sort of the substrings."""
    sa = _induce(t, small, places, sizes)
    ordered = sa[marked[sa]]
    width = np.zeros(len(t), np.int64)
    width[places] = length
    one, two = ordered[:-1], ordered[1:]
    differ = width[one] != width[two]
    open_, k = np.flatnonzero(~differ), 0
    while len(open_):
        unequal = t[one[open_] + k] != t[two[open_] + k]
        differ[open_[unequal]] = True
        open_, k = open_[~unequal], k + 1
        open_ = open_[width[one[open_]] > k]
    names = np.zeros(len(t), np.int64)
    names[ordered[1:]] = np.cumsum(differ)
    return names[places]


def permuted_lcp(data: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position of ``data`` (bytes), the length that it shares with the suffix before it in ``sa``.

    Only irreducible values are compared, eight bytes a step; the others follow from their left neighbour
    (Kärkkäinen, Manzini and Puglisi 2009).
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
    word = padded[: n + 8].copy()
    for k in range(1, 8):
        word |= padded[k : n + 8 + k] << np.uint64(8 * k)
    i = np.arange(n)
    reducible = np.zeros(n, bool)
    reducible[1:] = (before[1:] > 0) & (data[:-1] == data[before[1:] - 1])
    open_, done = i[~reducible & (before >= 0)], 0
    value = np.zeros(n, np.int64)
    while len(open_):
        x = word[open_ + done] ^ word[before[open_] + done]
        same = x == 0
        low = x[~same] & (~x[~same] + np.uint64(1))
        value[open_[~same]] = done + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        value[open_[same]] = done = done + 8
        open_ = open_[same]
        open_ = open_[np.maximum(open_, before[open_]) + done < n]
    value = np.minimum(value, n - np.maximum(i, before))
    last = np.maximum.accumulate(np.where(reducible, 0, i))
    return np.maximum(value[last] - (i - last), 0)
