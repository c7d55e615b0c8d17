"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are classified as smaller or larger than the next one; the leftmost smaller ones (LMS)
cut the text into substrings. These are sorted by induction, named by rank, the string of names
is sorted, and from its order all suffixes are induced in linear work. Induction runs over the
buckets of first symbols, each of which is filled by whole-array operations: what stands in a
bucket is final when its turn comes, but for repeats of its own symbol, which follow in waves.

The string of names has too many symbols for buckets. It is sorted by doubling of ranks, and only
up to ``depth`` symbols of the text: suffixes that agree that far may stand in any order, which
is all that a search for common strings of that length needs.
"""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``s`` by their first ``depth`` symbols or more.

    ``s`` holds small integers; its last symbol must be smaller than all others.
    """
    n = len(s)
    if n < 2:
        return np.arange(n)
    smaller = classify(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sizes = np.bincount(s)
    # By induction from the LMS suffixes in order of place, the LMS substrings get sorted ...
    order = induce(s, smaller, lms[np.argsort(s[lms], kind="stable")], sizes)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    substrings = order[is_lms[order]]
    names = name(s, smaller, lms, substrings)
    # ... and from the sorted LMS suffixes all suffixes.
    ranked = lms[double(names, lms, depth)]
    return induce(s, smaller, ranked, sizes)


def classify(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last one counts as smaller."""
    n = len(s)
    differs = np.empty(n, bool)
    differs[:-1] = s[:-1] != s[1:]
    differs[-1] = True
    decided = np.flatnonzero(differs)
    value = np.empty(len(decided), bool)
    value[:-1] = s[decided[:-1]] < s[decided[:-1] + 1]
    value[-1] = True
    return np.repeat(value, np.diff(decided, prepend=-1))


def induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes in order (grouped by first symbol)."""
    n, symbols = len(s), len(sizes)
    order = np.full(n, -1, np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    by_symbol = np.searchsorted(s[lms], np.arange(symbols + 1))
    # Larger suffixes, buckets ascending: each is put in place by the suffix after it.
    heads = starts.copy()
    for c in range(symbols):
        if not sizes[c]:
            continue
        done = starts[c]
        while done < heads[c]:  # larger ones of this bucket; repeats of its symbol add to it
            stop = heads[c]
            spread(s, smaller, order, order[done:stop], heads, False)
            done = stop
        spread(s, smaller, order, lms[by_symbol[c] : by_symbol[c + 1]], heads, False)
    # Smaller suffixes, buckets descending; the last suffix is no one's successor.
    tails = ends.copy()
    tails[s[n - 1]] -= 1
    order[tails[s[n - 1]]] = n - 1
    for c in range(symbols - 1, -1, -1):
        if not sizes[c]:
            continue
        done = ends[c]
        while done > tails[c]:
            stop = tails[c]
            spread(s, smaller, order, order[stop:done][::-1], tails, True)
            done = stop
        spread(s, smaller, order, order[starts[c] : heads[c]][::-1], tails, True)
    return order


def spread(
    s: np.ndarray, smaller: np.ndarray, order: np.ndarray, found: np.ndarray, edge: np.ndarray, which: bool
) -> None:
    """Put the predecessors of ``found``, of one type, at the edges of their buckets."""
    before = found[found > 0] - 1
    before = before[smaller[before] == which]
    if not len(before):
        return
    symbols = s[before]
    if len(before) > 1:
        by = np.argsort(symbols, kind="stable")  # small integers: a radix sort
        before, symbols = before[by], symbols[by]
    firsts = np.flatnonzero(np.diff(symbols, prepend=-1))
    counts = np.diff(firsts, append=len(symbols))
    place = np.arange(len(symbols)) - np.repeat(firsts, counts)
    buckets = symbols[firsts]
    base = np.repeat(edge[buckets], counts)
    if which:
        order[base - 1 - place] = before
        edge[buckets] -= counts
    else:
        order[base + place] = before
        edge[buckets] += counts


def name(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, substrings: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings in order of place: equal substrings share one."""
    n = len(s)
    following = np.full(n, n, np.int64)
    following[lms[:-1]] = lms[1:]
    lengths = np.minimum(following[substrings], n - 1) - substrings + 1
    # Compare neighbours in order, one symbol at a time, as long as they agree.
    same = np.zeros(len(substrings), bool)
    same[1:] = lengths[1:] == lengths[:-1]
    active, k = np.flatnonzero(same), 0
    while len(active):
        active = active[lengths[active] > k]
        a, b = substrings[active] + k, substrings[active - 1] + k
        equal = (s[a] == s[b]) & (smaller[a] == smaller[b])
        same[active[~equal]] = False
        active, k = active[equal], k + 1
    names = np.empty(n, np.int64)
    names[substrings] = np.cumsum(~same) - 1
    return names[lms]


def double(names: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of the string of names, up to ``depth`` symbols of the text."""
    m = len(names)
    rank, step = names, 1
    order = np.argsort(rank, kind="stable")
    while step < m and rank.max() + 1 < m:
        after = np.zeros(m, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (m + 1) + after
        order = np.argsort(key, kind="stable")
        fresh = np.empty(m, np.int64)
        fresh[order] = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        rank, step = fresh, step * 2
        # Every stretch of so many substrings is long enough: what still ties may tie.
        if step < m and (lms[step:] - lms[:-step]).min() >= depth:
            break
    return order


def common_prefixes(s: np.ndarray, order: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """For the places ``at``: whether ``depth`` symbols agree with a neighbour in the order.

    The permuted prefix of a place is compared with its predecessor in order; a place agrees
    with its successor if the successor agrees with it.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    wanted = np.zeros(n, bool)
    wanted[at] = True
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    following = order[np.minimum(rank[at] + 1, n - 1)]
    wanted[following] = True
    places = np.flatnonzero(wanted & (before >= 0) & (np.arange(n) + depth <= n))
    places = places[before[places] + depth <= n]
    symbols = np.concatenate([s.astype(np.int16), np.zeros(4, np.int16)])
    words = np.lib.stride_tricks.as_strided(symbols, (n, 4), (2, 2))
    for k in [*range(0, depth - 3, 4), max(0, depth - 4)]:
        a = np.ascontiguousarray(words[places + k]).view(np.uint64)[:, 0]
        b = np.ascontiguousarray(words[before[places] + k]).view(np.uint64)[:, 0]
        places = places[a == b]
    agree = np.zeros(n, bool)
    agree[places] = True
    agree[before[places]] = True
    return agree[at]
