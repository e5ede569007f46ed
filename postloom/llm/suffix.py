"""Suffix arrays by induced sorting and their permuted common prefixes, in numpy.

Induction is a scan in which each entry may place its predecessor further along. The scan goes in chunks: a chunk
ends before the first place that one of its own entries fills, so everything in it is final, and its placements are
made at once. Bucket by bucket or, for the large alphabets of the recursion, some hundreds of entries at a time,
that is the order of the plain scan.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 16


def ranks_within(c: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = c.argsort(kind="stable")
    s = c[order]
    at = np.arange(len(c))
    start = at.copy()
    start[1:][s[1:] == s[:-1]] = 0
    np.maximum.accumulate(start, out=start)
    at -= start
    rank = np.empty(len(c), "i8")
    rank[order] = at
    return rank


def induce(t: np.ndarray, smaller: np.ndarray, sums: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones in order (equal first letters stay as they come)."""
    n = len(t)
    sa = np.full(n, -1, "i8")
    if len(seeds):
        c = t[seeds]
        sa[sums[c] - np.bincount(c, minlength=len(sums))[c] + ranks_within(c)] = seeds

    heads = np.concatenate([[0], sums[:-1]])
    sa[heads[t[n - 1]]] = n - 1  # the end of the text comes before every letter
    heads[t[n - 1]] += 1
    at, size = 0, 256
    while at < n:
        end = min(n, at + size)
        part = sa[at:end]
        src = (part > 0).nonzero()[0]
        j = part[src] - 1
        ok = (~smaller[j]).nonzero()[0]
        if len(ok):
            j = j[ok]
            c = t[j]
            to = heads[c] + ranks_within(c)
            first = int(to.min())
            if first < end:
                end = first
                k = src[ok].searchsorted(end - at)
                j, to, c = j[:k], to[:k], c[:k]
            sa[to] = j
            heads[c] = to + 1  # of equal letters the last counts
        size = min(CHUNK, max(64, 2 * (end - at)))
        at = end

    tails = sums.copy()
    at, size = n, 256
    while at > 0:
        end = max(0, at - size)
        part = sa[end:at][::-1]
        src = (part > 0).nonzero()[0]
        j = part[src] - 1
        ok = smaller[j].nonzero()[0]
        if len(ok):
            j = j[ok]
            c = t[j]
            to = tails[c] - 1 - ranks_within(c)
            last = int(to.max())
            if last >= end:
                end = last + 1
                k = src[ok].searchsorted(at - end)
                j, to, c = j[:k], to[:k], c[:k]
            sa[to] = j
            tails[c] = to
        size = min(CHUNK, max(64, 2 * (at - end)))
        at = end
    return sa


def suffix_array(t: np.ndarray, letters: int = 256) -> np.ndarray:
    """Places of the suffixes of ``t`` (values below ``letters``) in order."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    changes = np.flatnonzero(t[1:] != t[:-1])
    starts = np.concatenate([[0], changes + 1])
    rising = np.append(t[starts[1:]] > t[starts[:-1]], False)
    smaller = np.repeat(rising, np.diff(np.append(starts, n)))
    seeds = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sums = np.cumsum(np.bincount(t, minlength=letters))
    if len(seeds) > 1:
        order = induce(t, smaller, sums, seeds)
        is_seed = np.zeros(n, bool)
        is_seed[seeds] = True
        order = order[is_seed[order]]
        length = np.zeros(n, "i8")
        length[seeds[:-1]] = np.diff(seeds) + 1
        a, b = order[:-1].astype("i8"), order[1:].astype("i8")
        differ = length[a] != length[b]
        differ |= (a == seeds[-1]) | (b == seeds[-1])
        live = np.flatnonzero(~differ)
        k = 0
        while len(live):
            unlike = t[a[live] + k] != t[b[live] + k]
            differ[live[unlike]] = True
            live = live[~unlike]
            k += 1
            live = live[length[a[live]] > k]
        names = np.concatenate([[0], np.cumsum(differ)])
        if names[-1] + 1 < len(seeds):
            named = np.empty(n, "i4")
            named[order] = names
            seeds = seeds[suffix_array(named[seeds], int(names[-1]) + 1)]
        else:
            seeds = order
    return induce(t, smaller, sums, seeds)


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place of the text: the longest common prefix with the suffix before it and with the one after it in order.

    Where the letters before two neighbours are equal, their common prefix is that of the places before, less one;
    only the others are compared.
    """
    n = len(t)
    before = np.full(n, -1, "i8")
    before[sa[1:]] = sa[:-1]
    here = np.arange(n)
    compare = (before <= 0) | (here == 0)
    rest = np.flatnonzero(~compare)
    compare[rest] = t[rest - 1] != t[before[rest] - 1]
    a = np.flatnonzero(compare)
    b = before[a]
    limit = np.where(b < 0, 0, n - np.maximum(a, b))
    length = np.zeros(len(a), "i8")
    live, step = np.flatnonzero(limit > 0), 16
    while len(live):
        la, lb, done = a[live], b[live], length[live]
        span = np.arange(step)
        off = np.minimum(done[:, None] + span, limit[live, None] - 1)
        alike = t[la[:, None] + off] == t[lb[:, None] + off]
        alike &= done[:, None] + span < limit[live, None]
        run = np.where(alike.all(1), step, (~alike).argmax(1))
        length[live] = done + run
        live = live[run == step]
        step = max(16, min(4096, 2 * step, (1 << 20) // max(1, len(live))))
    last = np.maximum.accumulate(np.where(compare, here, 0))
    full = np.zeros(n, "i8")
    full[a] = length
    prefix = full[last] - (here - last)
    after = np.zeros(n, "i8")
    after[sa[:-1]] = prefix[sa[1:]]
    return prefix, after


def repeated(t: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Which places of ``t`` start a string of ``width`` that starts elsewhere too and stays within its part.

    ``ends`` has, per place, the end of its part; parts are divided by a value that no part holds.
    """
    before, after = common_prefixes(t, suffix_array(t))
    return (np.maximum(before, after) >= width) & (np.arange(len(t)) + width <= ends)
