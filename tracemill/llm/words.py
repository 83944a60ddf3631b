"""Hashes of words and word shingles, computed for many texts at once.

A word is a maximal run of ASCII letters and digits or characters beyond ASCII, in
lower case. Words and shingles are 64-bit hashes; two different ones fall together
with probability 2^-64.
"""

from __future__ import annotations

import numpy as np

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_FACTOR = 0x9E3779B97F4A7C15
#: Bytes hashed in one go; a longer text is cut between words.
SLICE = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The factor to the powers of 1 to ``n``, and to 0 to ``1 - n``, modulo 2^64."""
    back = np.full(n, pow(_FACTOR, -1, 1 << 64), np.uint64)
    back[:1] = 1
    return np.cumprod(np.full(n, _FACTOR, np.uint64)), np.cumprod(back)


_POWERS = _powers(SLICE + 4096)


def _slices(data: np.ndarray, in_word: np.ndarray):
    start = 0
    while start < len(data):
        end = min(len(data), start + SLICE)
        while end < len(data) and in_word[data[end]]:
            end += 1
        yield start, data[start:end]
        start = end


def word_hashes(texts: list[str], ascii_case: bool = False, in_word: np.ndarray = _IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of ``texts``, and where each text's words begin (one more entry for the end).

    ``ascii_case`` lower-cases A to Z only; ``in_word`` tells which bytes belong to words.
    """
    raw = [t.encode("utf-8", "replace").lower() if ascii_case else t.lower().encode("utf-8", "replace") for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8) if raw else np.zeros(0, np.uint8)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for offset, part in _slices(data, in_word):
        edge = np.diff(in_word[part].view(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            continue
        # a word's polynomial is the difference of two running sums, brought back to power 1 at its start
        up, back = _POWERS if len(part) <= len(_POWERS[0]) else _powers(len(part))
        running = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=running[1:])
        hashes.append(mix((running[ends] - running[starts]) * back[starts]))
        places.append(starts + offset)
    hashes, places = np.concatenate(hashes), np.concatenate(places)
    return hashes, np.searchsorted(places, bounds)


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place of one long run of words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, k, np.uint64)
    for j in range(k):
        acc = mix(acc * np.uint64(31) + hashes[j:j + n])
    return acc


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; one of fewer than ``k`` words has all of them as its only shingle."""
    hashes, at = word_hashes(texts)
    every = shingle_hashes(hashes, k)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        n = b - a
        out.append(np.unique(every[a:b - k + 1]) if n >= k else shingle_hashes(hashes[a:b], n) if n else hashes[a:a])
    return out


def batches(texts: list[str], limit: int = SLICE):
    """Ranges of ``texts`` with about ``limit`` characters each."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
