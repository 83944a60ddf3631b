"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays.

Suffixes are classified as smaller or larger than their right neighbour. The leftmost
smaller ones (LMS) are ordered by their substrings: these are sorted by one induction,
named, and the string of names is sorted by recursion. A second induction orders all
suffixes from them. An induction visits the buckets of first symbols in order and moves
whole bucket parts at a time, so its work is linear with few array operations.
"""

from __future__ import annotations

import numpy as np

#: Names up to this number are one symbol of the next string; larger ones are written as two digits.
ALPHABET = 1024
#: Shorter strings of names are sorted by doubling.
SMALL = 1 << 20


def _smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one to their right; the sentinel counts as such."""
    step = np.sign(np.diff(text.astype(np.int64)))
    n = len(text)
    differs = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(differs[::-1])[::-1]
    return np.concatenate([np.concatenate([step, [1]])[following] > 0, [True]])


def _deal(buckets: list, text: np.ndarray, places: np.ndarray) -> None:
    if not len(places):
        return
    symbols = text[places]
    order = np.argsort(symbols, kind="stable")
    places, symbols = places[order], symbols[order]
    cuts = np.concatenate([[0], np.flatnonzero(symbols[1:] != symbols[:-1]) + 1, [len(symbols)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        buckets[symbols[a]].append(places[a:b])


def _scan(bucket: list, buckets: list, text, symbol, wanted) -> np.ndarray | None:
    """All entries of one bucket in the order of the scan; their left neighbours are dealt out."""
    if not bucket:
        return None
    done, front = [], np.concatenate(bucket)
    while len(front):
        done.append(front)
        left = front[front > 0] - 1
        left = left[wanted[left]]
        same = text[left] == symbol
        _deal(buckets, text, left[~same])
        front = left[same]
    return np.concatenate(done)


def _induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    starts, larger, ups, downs = ([[] for _ in range(symbols)] for _ in range(4))
    _deal(starts, text, lms)
    larger_type = ~smaller
    present = np.flatnonzero(np.bincount(text, minlength=symbols)).tolist()
    for c in present:
        scanned = _scan(ups[c], ups, text, c, larger_type)
        larger[c] = scanned
        for part in starts[c]:
            left = part[part > 0] - 1
            _deal(ups, text, left[larger_type[left]])
    out = []
    for c in reversed(present):
        scanned = _scan(downs[c], downs, text, c, smaller)
        if c == text[-1]:
            scanned = np.array([len(text) - 1])
        if scanned is not None:
            out.append(scanned)
        if larger[c] is not None:
            part = larger[c][::-1]
            out.append(part)
            left = part[part > 0] - 1
            _deal(downs, text, left[smaller[left]])
    return np.concatenate(out)[::-1]


def _names(text: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Name the LMS substrings, given in sorted order, by their rank; equal ones share a name."""
    length = np.zeros(len(text), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    differs = length[a] != length[b]
    rest, k = np.flatnonzero(~differs), 0
    while len(rest):
        differs[rest] = text[a[rest] + k] != text[b[rest] + k]
        k += 1
        rest = rest[~differs[rest] & (length[a[rest]] > k)]
    return np.concatenate([[0], np.cumsum(differs)])


def _by_doubling(names: np.ndarray) -> np.ndarray:
    rank, size = names.astype(np.int64), 1
    while True:
        after = np.full(len(rank), -1, np.int64)
        after[:-size] = rank[size:]
        key = rank * (len(rank) + 1) + after + 1
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty_like(new)
        rank[order] = new
        if new[-1] == len(new) - 1 or size >= len(rank):
            return order
        size *= 2


def _order_of_names(names: np.ndarray, before: int) -> np.ndarray:
    """Order of the suffixes of a string of names."""
    top = int(names.max()) + 1
    if len(names) <= SMALL:
        return _by_doubling(names)
    if top <= ALPHABET:
        return _suffix_array(np.concatenate([names + 1, [0]]), top + 1)[1:]
    base = int(np.ceil(np.sqrt(top)))
    digits = np.empty(2 * len(names) + 1, np.int64)
    digits[:-1:2], digits[1::2], digits[-1] = names // base + 1, names % base + 1, 0
    if len(digits) > 0.9 * before:  # digits that hardly shorten the string would recur too often
        return _by_doubling(names)
    order = _suffix_array(digits, base + 2)
    return order[(order % 2 == 0) & (order < 2 * len(names))] // 2


def _suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """``text`` ends with its only smallest symbol."""
    text = text.astype(np.uint16 if symbols <= 65536 else np.int64)
    smaller = _smaller(text)
    is_lms = smaller.copy()
    is_lms[0] = False
    is_lms[1:] &= ~smaller[:-1]
    lms = np.flatnonzero(is_lms)
    if len(lms) > 1:
        ordered = _induce(text, smaller, lms, symbols)
        ordered = ordered[is_lms[ordered]]
        named = _names(text, ordered, lms)
        if named[-1] < len(lms) - 1:
            by_place = np.empty(len(text), np.int64)
            by_place[ordered] = named
            ordered = lms[_order_of_names(by_place[lms], len(text))]
    else:
        ordered = lms
    return _induce(text, smaller, ordered, symbols)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places of ``data`` (bytes) in the order of their suffixes."""
    if not len(data):
        return np.zeros(0, np.int64)
    return _suffix_array(np.concatenate([data.astype(np.int64) + 1, [0]]), 257)[1:]


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place, how many bytes its suffix shares with the one before it in ``order``.

    Where both suffixes have the same byte on their left, the value is the left
    neighbour's less one; only the other places are compared, eight bytes at a time.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    reducible = (before > 0) & (place > 0)
    reducible[reducible] = data[place[reducible] - 1] == data[before[reducible] - 1]
    heads = np.flatnonzero(~reducible)
    padded = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
    words = np.zeros(n + 8, np.uint64)
    for k in range(8):
        words |= padded[k:k + n + 8] << np.uint64(8 * k)
    common = np.zeros(n, np.int64)
    rest = heads[before[heads] >= 0]
    while len(rest):
        a, b = rest + common[rest], before[rest] + common[rest]
        inside = np.maximum(a, b) + 8 <= n
        differing = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        lowest = differing & (~differing + np.uint64(1))
        equal = np.where(differing == 0, 8, np.log2(np.maximum(lowest, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
        common[rest] += np.minimum(equal, np.maximum(n - np.maximum(a, b), 0))
        rest = rest[(differing == 0) & inside]
    last_head = np.maximum.accumulate(np.where(reducible, 0, place))
    return np.where(reducible, common[last_head] - (place - last_head), common)
