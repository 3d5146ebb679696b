"""Suffix arrays of shards by induced sorting, and their permuted common prefixes, in numpy.

Suffixes are classified (S: smaller than the next one, L: larger), leftmost S suffixes (LMS) are sorted, and all others
are induced from them bucket by bucket: one scan upwards for L, one downwards for S. A scan takes a bucket's entries as
arrays, so its steps are as many as symbols and runs of equal symbols, not as suffixes. LMS substrings are sorted by the same induction,
named, and the string of names is sorted in turn; as names are too many for bucket scans, names of pairs, of pairs of
pairs and so on are sorted until all differ.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is S; the last symbol is the smallest and unique."""
    n = len(t)
    out = np.ones(n, bool)
    if n > 1:
        at = np.where(t[:-1] == t[1:], np.int32(n), np.arange(n - 1, dtype=np.int32))
        decides = np.minimum.accumulate(at[::-1])[::-1]
        out[:-1] = (t[:-1] < t[1:])[np.minimum(decides, n - 2)]
    return out


def _induced(t: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Suffix array from LMS suffixes in their order (each bucket's in its order)."""
    ends = np.cumsum(sizes)
    heads, tails = ends - sizes, ends.copy()
    sa = np.full(len(t), -1, np.int32)
    marks = t[lms]
    own = np.bincount(marks, minlength=len(sizes))
    first = np.cumsum(own) - own
    sa[(tails - own)[marks] + np.arange(len(lms)) - first[marks]] = lms
    start = heads.copy()

    def dealt(batch: np.ndarray, want: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        p = batch[batch > 0] - 1
        p = p[small[p] == want]
        c = t[p]
        if want:  # the scan goes down: the first to come lies last
            p, c = p[::-1], c[::-1]
        order = np.argsort(c, kind="stable")
        n = np.bincount(c, minlength=len(sizes))
        c = c[order]
        return p[order], c, n, np.arange(len(c)) - (np.cumsum(n) - n)[c]

    for b in np.flatnonzero(sizes).tolist():
        at = start[b]
        while at < heads[b]:  # grows while entries of the bucket induce others in it
            batch, at = sa[at : heads[b]], heads[b]
            p, c, n, k = dealt(batch, False)
            sa[heads[c] + k] = p
            heads += n
        if own[b]:
            p, c, n, k = dealt(sa[tails[b] - own[b] : tails[b]], False)
            sa[heads[c] + k] = p
            heads += n
    low = heads.copy()  # end of each bucket's L part
    tails = ends.copy()
    for b in np.flatnonzero(sizes).tolist()[::-1]:
        at = ends[b]
        while at > tails[b]:
            batch, at = sa[tails[b] : at], tails[b]
            p, c, n, k = dealt(batch, True)
            sa[tails[c] - 1 - k] = p
            tails -= n
        if low[b] > start[b]:
            p, c, n, k = dealt(sa[start[b] : low[b]], True)
            sa[tails[c] - 1 - k] = p
            tails -= n
    return sa


def _names(t: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names of LMS substrings (by text position) from their sorted order."""
    length = np.empty(len(t), np.int32)
    length[lms] = np.append(np.diff(lms), 0) + 1
    a, b = ordered[:-1], ordered[1:]
    same = np.flatnonzero(length[a] == length[b])
    k = 0
    equal = np.zeros(len(a), bool)
    while len(same):
        same = same[t[a[same] + k] == t[b[same] + k]]
        k += 1
        done = length[a[same]] <= k
        equal[same[done]] = True
        same = same[~done]
    name = np.empty(len(t), np.int32)
    name[ordered] = np.concatenate([[0], np.cumsum(~equal)])
    return name[lms]


def _sorted_names(name: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, whose last is the smallest and unique."""
    rank, n, step = name.astype(np.int64), len(name), 1
    order = np.argsort(rank, kind="stable")
    # only groups of equal rank are sorted on; every round doubles the names compared
    tied = _tied(rank, order)
    while len(tied):
        ahead = np.where(tied + step < n, rank[np.minimum(tied + step, n - 1)], -1)
        key = rank[tied] * (n + 1) + ahead + 1
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        # a tied suffix's rank is the place where its group begins in the whole order
        base = rank[tied]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        group = np.flatnonzero(np.concatenate([[True], base[1:] != base[:-1]]))
        within = np.repeat(new, np.diff(np.append(new, len(key)))) - np.repeat(group, np.diff(np.append(group, len(key))))
        rank[tied] = base + within
        sizes = np.diff(np.append(new, len(key)))
        tied = tied[np.repeat(sizes > 1, sizes)]
        step *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def _tied(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Sets ranks to where their group begins; the members of groups of two or more."""
    r = rank[order]
    new = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
    sizes = np.diff(np.append(new, len(r)))
    rank[order] = np.repeat(new, sizes)
    return order[np.repeat(sizes > 1, sizes)]


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Sorted suffixes of up to 2^31 small unsigned symbols; the last symbol must be the smallest and unique."""
    small = _types(t)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    sizes = np.bincount(t)
    if len(lms) < 2:
        return _induced(t, small, lms, sizes) if len(t) > 1 else np.zeros(1, np.int64)
    rough = _induced(t, small, lms[np.argsort(t[lms], kind="stable")], sizes)
    leftmost = np.zeros(len(t), bool)
    leftmost[lms] = True
    ordered = rough[leftmost[rough]]
    name = _names(t, ordered, lms)
    return _induced(t, small, lms[_sorted_names(name)], sizes)


def common_prefixes(t: np.ndarray, sa: np.ndarray, starts: np.ndarray, windows: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes, up to `most`, of each window's suffix with the one before it in the suffix array.

    Windows i of a piece stand at starts[piece] + i; a window is worth `most` symbols inside its piece. Going from one
    window to the next loses one symbol at most, so each step begins where the last one ended. All pieces go side by side.
    Returns values by text position (0 where no window stands).
    """
    before = np.full(len(t), len(t) - 1, np.int32)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(len(t), np.int16)
    h = np.zeros(len(starts), np.int64)
    order = np.argsort(-windows, kind="stable")
    starts, windows = starts[order], windows[order]
    for i in range(int(windows.max(initial=0))):
        m = int(np.searchsorted(-windows, -i, side="left"))
        at = starts[:m] + i
        other = before[at]
        run = np.maximum(h[:m] - 1, 0)
        # never past the end: a window holds `most` symbols and the last symbol of all differs from any other
        alive = np.flatnonzero(run < most)
        while len(alive):
            alive = alive[t[at[alive] + run[alive]] == t[np.minimum(other[alive] + run[alive], len(t) - 1)]]
            run[alive] += 1
            alive = alive[run[alive] < most]
        h[:m] = run
        out[at] = run
    return out
