"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays."""

from __future__ import annotations

import numpy as np

# Alphabets up to this size are induced bucket by bucket with array operations; larger ones,
# which only recursion makes, symbol by symbol.
BY_BUCKET = 1024


def suffix_array(s: np.ndarray, symbols: int) -> np.ndarray:
    """Order of the suffixes of ``s``, whose last symbol is a unique smallest 0."""
    n = len(s)
    if n <= 2:
        return np.arange(n - 1, -1, -1)
    # Classify: a suffix is S-type if it is smaller than the next one.
    smaller = np.zeros(n, dtype=bool)
    smaller[-1] = True
    differs = np.flatnonzero(s[:-1] != s[1:])
    if len(differs):
        rise = s[differs] < s[differs + 1]
        smaller[: differs[-1] + 1] = np.repeat(rise, np.diff(differs, prepend=-1))
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    induce = induce_by_bucket if symbols <= BY_BUCKET else induce_by_symbol

    names = name_substrings(s, smaller, lms)
    distinct = int(names.max()) + 1
    ranked = np.empty_like(lms)
    if distinct == len(lms):
        ranked[names] = lms
    else:
        ranked = lms[suffix_array(names, distinct)]
    return induce(s, symbols, smaller, ranked)


def name_substrings(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """In text order, the rank of each leftmost-smaller substring; equal ones share a rank.

    Symbols with their types are compared several at a time, packed in a number; a rank is the
    number of smaller substrings, and only those that still share theirs are looked at again.
    """
    ends = np.append(lms[1:] + 1, len(s))
    bits = int(s.max()).bit_length() + 1
    per = max(62 // bits, 1)
    ranks = np.zeros(len(lms), dtype=np.int64)
    shared = np.arange(len(lms))
    at = 0
    while len(shared):
        start, end = lms[shared] + at, ends[shared]
        value = np.zeros(len(shared), dtype=np.int64)
        for k in range(per):
            place = np.minimum(start + k, len(s) - 1)
            symbol = s[place] * 2 + smaller[place]  # never 0, as the only 0 is S-type
            value = value << bits | np.where(start + k < end, symbol, 0)
        order = np.lexsort((value, ranks[shared])) if at else np.argsort(value)
        group, value = ranks[shared][order], value[order]
        first = np.concatenate([[True], (group[1:] != group[:-1]) | (value[1:] != value[:-1])])
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        place = np.arange(len(order))
        in_group = place - np.maximum.accumulate(np.where(new_group, place, 0))
        heads = np.flatnonzero(first)
        sizes = np.diff(np.append(heads, len(order)))
        shared = shared[order]
        ranks[shared] = group + np.repeat(in_group[heads], sizes)
        at += per
        shared = shared[(np.repeat(sizes, sizes) > 1) & (lms[shared] + at < ends[shared])]
    present = np.zeros(len(lms), dtype=np.int64)
    present[ranks] = 1
    return (np.cumsum(present) - 1)[ranks]


def induce_by_bucket(s: np.ndarray, symbols: int, smaller: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order: first L, then S types."""
    starts = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols))])
    out = np.full(len(s), -1, dtype=np.int64)
    head, tail = starts[:-1].copy(), starts[1:].copy()
    lms_ends = np.searchsorted(s[ranked], np.arange(symbols + 1))

    def deal(source: np.ndarray, forward: bool) -> None:
        """Puts the suffixes one before ``source`` at the open ends of their buckets."""
        before = source[source > 0] - 1
        before = before[smaller[before] != forward]
        if not len(before):
            return
        keys = s[before]
        order = np.argsort(keys, kind="stable")
        before, keys = before[order], keys[order]
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(firsts, len(keys)))
        own = keys[firsts]
        rank = np.arange(len(keys)) - np.repeat(firsts, sizes)
        if forward:
            out[np.repeat(head[own], sizes) + rank] = before
            head[own] += sizes
        else:
            out[np.repeat(tail[own], sizes) - 1 - rank] = before
            tail[own] -= sizes

    for c in range(symbols):
        done = starts[c]
        while done < head[c]:  # L types of this symbol, which may add more of it
            source = out[done : head[c]]
            done = head[c]
            deal(source, True)
        deal(ranked[lms_ends[c] : lms_ends[c + 1]], True)
    for c in range(symbols - 1, -1, -1):
        done = starts[c + 1]
        while done > tail[c]:  # S types of this symbol
            source = out[tail[c] : done][::-1]
            done = tail[c]
            deal(source, False)
        deal(out[starts[c] : head[c]][::-1], False)
    if s[-1] == 0:
        out[0] = len(s) - 1
    return out


def induce_by_symbol(s: np.ndarray, symbols: int, smaller: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    n = len(s)
    starts = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols))]).tolist()
    # For each suffix, the bucket of the one before it, if that is of the wanted type; the last
    # entry is for places that are still empty, which hold -1.
    before_l, before_s = np.full(n + 1, -1), np.full(n + 1, -1)
    before_l[1:n] = np.where(smaller[:-1], -1, s[:-1])
    before_s[1:n] = np.where(smaller[:-1], s[:-1], -1)
    out, tail = [-1] * n, starts[1:]
    for k, c in zip(ranked[::-1].tolist(), s[ranked[::-1]].tolist(), strict=True):
        tail[c] -= 1
        out[tail[c]] = k
    head, bucket = starts[:-1], before_l.tolist()
    for k in out:  # which is filled as it is read
        c = bucket[k]
        if c >= 0:
            out[head[c]] = k - 1
            head[c] += 1
    tail, bucket = starts[1:], before_s.tolist()
    for k in reversed(out):
        c = bucket[k]
        if c >= 0:
            tail[c] -= 1
            out[tail[c]] = k - 1
    out[0] = n - 1
    return np.array(out, dtype=np.int64)


def permuted_common_prefixes(s: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """In text order, how far each suffix agrees with the one before it in ``order``, up to ``most``.

    All suffixes are compared together, several symbols packed in a number at a time, so the work
    is linear for a fixed ``most``. The last symbol is unique, so suffixes differ before they end.
    ``order`` may leave suffixes out; theirs, and that of the first, is 0.
    """
    n = len(s)
    bits = max(int(s.max()).bit_length(), 1)
    per = max(62 // bits, 1)
    packed = np.zeros(n + most + per, dtype=np.int64)
    for k in range(per):
        packed[: max(n - k, 0)] |= s[k:].astype(np.int64) << (bits * k)
    common = np.zeros(n, dtype=np.int64)
    here, before = order[1:], order[:-1]
    for at in range(0, most, per):
        differs = packed[here + at] ^ packed[before + at]
        same = differs == 0
        ends, differs = here[~same], differs[~same]
        lowest = np.log2((differs & -differs).astype(np.float64)).astype(np.int64)
        common[ends] = at + lowest // bits
        here, before = here[same], before[same]
    common[here] = most
    return np.minimum(common, most)
