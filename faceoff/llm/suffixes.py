"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays."""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (type S); the last one is of type L
    (it is followed by an imagined end that is smaller than everything)."""
    n = len(t)
    s = np.zeros(n, bool)
    if n < 2:
        return s
    # equal neighbours have the type of the next position whose right neighbour differs
    change = np.flatnonzero(t[:-1] != t[1:])
    rises = np.zeros(n, bool)
    rises[change] = t[change] < t[change + 1]
    nearest = np.full(n, n - 1)
    nearest[change] = change
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    return rises[nearest]


def _induce_bytes(t: np.ndarray, k: int, s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Suffix array induced from leftmost S suffixes in the given order, bucket by bucket:
    all suffixes of a bucket induce their left neighbours at once. For small alphabets."""
    n = len(t)
    char = t[lms]
    order = np.argsort(char, kind="stable")
    seeds = np.split(lms[order], np.searchsorted(char[order], np.arange(1, k)))

    def deal(queue, cur, want_s, here):
        """Left neighbours of the wanted type: those of this bucket are returned, others queued."""
        left = cur[cur > 0] - 1
        left = left[s[left] == want_s]
        c = t[left]
        away = left[c != here]
        if len(away):
            ca = c[c != here]
            o = np.argsort(ca, kind="stable")
            away, ca = away[o], ca[o]
            cuts = np.flatnonzero(np.diff(ca)) + 1
            for part, at in zip(np.split(away, cuts), [0, *cuts.tolist()]):
                queue[ca[at]].append(part)
        return left[c == here]

    larger = [[] for _ in range(k)]
    larger[t[n - 1]].append(np.array([n - 1]))  # induced by the imagined end
    l_part = []
    for c in range(k):
        cur, got = (np.concatenate(larger[c]) if larger[c] else np.zeros(0, np.int64)), []
        while len(cur):
            got.append(cur)
            cur = deal(larger, cur, False, c)
        l_part.append(np.concatenate(got) if got else np.zeros(0, np.int64))
        if len(seeds[c]):
            deal(larger, seeds[c], False, c)
    smaller = [[] for _ in range(k)]
    s_part = [None] * k
    for c in range(k - 1, -1, -1):  # from the right: parts are kept in descending order
        cur, got = (np.concatenate(smaller[c]) if smaller[c] else np.zeros(0, np.int64)), []
        while len(cur):
            got.append(cur)
            cur = deal(smaller, cur, True, c)
        s_part[c] = np.concatenate(got)[::-1] if got else np.zeros(0, np.int64)
        if len(l_part[c]):
            deal(smaller, l_part[c][::-1], True, c)
    return np.concatenate([x for c in range(k) for x in (l_part[c], s_part[c])])


def _induce_names(t: list[int], k: int, s: list[bool], lms: list[int]) -> list[int]:
    """The same for large alphabets: one pass from the left and one from the right."""
    n = len(t)
    count = np.bincount(np.array(t), minlength=k)
    ends = np.cumsum(count)
    sa = [-1] * n
    tail = ends.tolist()
    for i in reversed(lms):
        c = t[i]
        tail[c] -= 1
        sa[tail[c]] = i
    head = (ends - count).tolist()
    c = t[n - 1]
    sa[head[c]] = n - 1
    head[c] += 1
    for i in sa:  # grows while it is read: induced suffixes always lie further right
        if i > 0 and not s[i - 1]:
            c = t[i - 1]
            sa[head[c]] = i - 1
            head[c] += 1
    tail = ends.tolist()
    for x in range(n - 1, -1, -1):
        i = sa[x]
        if i > 0 and s[i - 1]:
            c = t[i - 1]
            tail[c] -= 1
            sa[tail[c]] = i - 1
    return sa


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Positions of the suffixes of ``t`` (values below ``k``) in ascending order."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    s = _types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    small = k <= 1024
    if small:
        induce = lambda order: _induce_bytes(t, k, s, order)
    else:
        tl, sl = t.tolist(), s.tolist()
        induce = lambda order: np.array(_induce_names(tl, k, sl, order.tolist()))
    if not len(lms):
        return induce(lms)
    # one induction sorts the substrings between leftmost S positions
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    rough = induce(lms)
    by_substring = rough[is_lms[rough]]
    # name them: equal neighbours get equal names
    number = np.full(n, -1)
    number[lms] = np.arange(len(lms))
    stop = np.append(lms[1:], n - 1)
    length = (stop - lms + 1)[number[by_substring]]
    same = np.zeros(len(by_substring), bool)
    a, b = by_substring[:-1], by_substring[1:]
    cand = np.flatnonzero((length[1:] == length[:-1]) & (by_substring[1:] != lms[-1]) & (by_substring[:-1] != lms[-1]))
    step = 0
    while len(cand):
        done = length[cand] <= step
        same[cand[done] + 1] = True
        cand = cand[~done]
        cand = cand[t[a[cand] + step] == t[b[cand] + step]]
        step += 1
    name = np.cumsum(~same) - 1
    reduced = np.empty(len(lms), np.int64)
    reduced[number[by_substring]] = name
    if name[-1] + 1 == len(lms):
        order = by_substring
    else:
        order = lms[suffix_array(reduced, int(name[-1]) + 1)]
    return induce(order)


def common_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for every position the number of leading values that its
    suffix has in common with the suffix before it in the array, up to ``most``.

    All positions are extended together, by halving steps over hashes of stretches."""
    n = len(t)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    levels = [(t.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)]
    while 1 << len(levels) <= most:
        h, half = levels[-1], 1 << (len(levels) - 1)
        if len(h) <= half:
            break
        x = h[:-half] * np.uint64(0xD6E8FEB86659FD93) + (h[half:] ^ (h[half:] >> np.uint64(31)))
        levels.append((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    out = np.zeros(n, np.int64)
    at = np.flatnonzero(before >= 0)
    for k in range(len(levels) - 1, -1, -1):
        h = levels[k]
        i, j = at + out[at], before[at] + out[at]
        inside = (i < len(h)) & (j < len(h))
        grow = at[inside][h[i[inside]] == h[j[inside]]]
        out[grow] += 1 << k
    # the halving steps reach all lengths below twice the largest step
    return np.minimum(out, most)


def repeated_starts(t: np.ndarray, k: int, width: int) -> np.ndarray:
    """For every position: does its first ``width`` values also start elsewhere in ``t``."""
    sa = suffix_array(t, k)
    plcp = common_prefixes(t, sa, width)
    hit = plcp >= width
    out = hit.copy()
    before = np.full(len(t), -1)
    before[sa[1:]] = sa[:-1]
    out[before[hit]] = True
    return out
