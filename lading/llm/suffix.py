"""Suffix arrays of byte shards by induced sorting, and their common prefixes.

Suffixes are classified as smaller or larger than their successor. The leftmost-smaller ones
are sorted by their substrings, which get names; the string of names is sorted in turn, and all
other suffixes are induced from that order, bucket by bucket: each pass handles a whole bucket
at a time, and every suffix once. Orders are only needed to a given depth.
"""

from __future__ import annotations

import numpy as np

# Strings over more symbols than this are sorted by doubling ranks instead of by buckets.
BUCKETS = 1024


def suffix_array(text: np.ndarray, symbols: int, depth: int) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes, as far as ``depth`` symbols decide.

    ``text`` holds numbers from 0 to ``symbols`` - 1 and ends with a 0 that occurs nowhere else.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32)
    smaller = _smaller(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(np.int32) + 1
    # Substrings first: the order among leftmost-smaller suffixes is still arbitrary here.
    order = _induce(text, symbols, smaller, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sorted_lms = order[is_lms[order]]
    names, n_names = _named(text, lms, sorted_lms)
    if n_names == len(lms):
        ranked = sorted_lms
    else:
        # The last substring is the end mark alone and has the smallest name, 0.
        if n_names <= BUCKETS:
            below = suffix_array(names, n_names, depth)
        else:
            below = _by_doubling(names, depth)
        ranked = lms[below]
    return _induce(text, symbols, smaller, ranked)


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; equal runs go with what ends them."""
    n = len(text)
    step = np.ones(n, np.int8)
    step[:-1] = (text[1:] > text[:-1]).astype(np.int8) - (text[1:] < text[:-1])
    at = np.where(step != 0, np.arange(n, dtype=np.int32), np.int32(n))
    ends = np.minimum.accumulate(at[::-1])[::-1]
    return step[ends] > 0


def _runs(keys: np.ndarray):
    """(order, (key, start, stop)...) of equal keys, each in the order of the array."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    cuts = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
    starts = np.concatenate([[0], cuts])
    stops = np.concatenate([cuts, [len(keys)]])
    return order, zip(ordered[starts].tolist(), starts.tolist(), stops.tolist(), strict=True)


def _deal(found: np.ndarray, keys: np.ndarray, queues: list[list[np.ndarray]]) -> None:
    if len(found):
        order, runs = _runs(keys)
        found = found[order]
        for key, start, stop in runs:
            queues[key].append(found[start:stop])


_NONE = np.zeros(0, np.int32)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else _NONE


def _induce(text: np.ndarray, symbols: int, smaller: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """All suffixes in order, from leftmost-smaller suffixes in order."""
    seeds: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    _deal(ranked, text[ranked], seeds)
    # Left to right: the larger ones from what is already placed before them.
    larger: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    placed: list[np.ndarray] = [_NONE] * symbols
    for symbol in range(symbols):
        now, rounds = _joined(larger[symbol]), []
        while len(now):
            rounds.append(now)
            before = now[now > 0] - 1
            before = before[~smaller[before]]
            keys = text[before]
            same = keys == symbol
            if same.any():
                _deal(before[~same], keys[~same], larger)
                now = before[same]
            else:
                _deal(before, keys, larger)
                now = _NONE
        placed[symbol] = _joined(rounds)
        start = _joined(seeds[symbol])
        if len(start):
            before = start[start > 0] - 1
            _deal(before, text[before], larger)
    # Right to left: the smaller ones, each bucket filled from its end.
    lesser: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    result: list[np.ndarray] = []
    for symbol in range(symbols - 1, -1, -1):
        now, rounds = _joined(lesser[symbol]), []
        while len(now):
            rounds.append(now)
            before = now[now > 0] - 1
            before = before[smaller[before]]
            keys = text[before]
            same = keys == symbol
            if same.any():
                _deal(before[~same], keys[~same], lesser)
                now = before[same]
            else:
                _deal(before, keys, lesser)
                now = _NONE
        mine = _joined(rounds)
        larger_here = placed[symbol]
        if len(larger_here):
            turned = larger_here[::-1]
            before = turned[turned > 0] - 1
            before = before[smaller[before]]
            _deal(before, text[before], lesser)
        result.append(mine)
        result.append(larger_here[::-1])
    # The end mark is smaller than everything; nothing induces it, as it has no successor.
    result.append(np.array([len(text) - 1], np.int32))
    return np.concatenate(result)[::-1].astype(np.int32)


def _named(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the leftmost-smaller substrings in text order, equal for equal substrings."""
    n = len(text)
    ends = np.full(n + 1, n - 1, np.int64)
    ends[lms[:-1]] = lms[1:]
    length = ends[ordered] - ordered + 1
    differs = np.ones(len(ordered), bool)
    open_ = np.flatnonzero(length[1:] == length[:-1]) + 1
    differs[open_] = False
    at = 0
    while len(open_):
        a, b = ordered[open_] + at, ordered[open_ - 1] + at
        unequal = text[a] != text[b]
        differs[open_[unequal]] = True
        at += 1
        open_ = open_[~unequal & (length[open_] > at)]
    names = np.zeros(n, np.int32)
    names[ordered] = np.cumsum(differs) - 1
    return names[lms], int(differs.sum())


def _by_doubling(names: np.ndarray, depth: int) -> np.ndarray:
    """The order of suffixes of ``names`` by their first ``depth`` names, or all if fewer decide."""
    n = len(names)
    rank, reach = names.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while reach < depth:
        second = np.zeros(n, np.int64)
        second[:-reach] = rank[reach:] + 1
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        reach *= 2
        if fresh[-1] == n - 1:
            break
    return order.astype(np.int32)


def repeats(text: np.ndarray, starts: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Class of each start: equal for starts whose next ``length`` bytes are equal.

    Common prefixes are found in text order: each start is compared with the one before
    it in suffix order, both read forward, eight bytes at a time.
    """
    n = len(text)
    wanted = np.zeros(n, bool)
    wanted[starts] = True
    ordered = order[wanted[order]]
    before = np.full(n, -1, np.int64)
    before[ordered[1:]] = ordered[:-1]
    padded = np.concatenate([text.astype(np.uint8), np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view(np.uint64).ravel()
    at = starts[before[starts] >= 0]
    for offset in [*range(0, length - 7, 8), length - 8]:
        at = at[words[at + offset] == words[before[at] + offset]]
    same = np.zeros(n, bool)
    same[at] = True
    label = np.cumsum(~same[ordered]) - 1
    classes = np.empty(n, np.int64)
    classes[ordered] = label
    return classes[starts]
