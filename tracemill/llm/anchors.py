"""Content-chosen anchors of byte strings.

Every window of ``width`` bytes chooses one of the ``GRAM``-byte strings inside it, the
one with the smallest hash, and the first of equal ones. Equal windows choose equal anchors at
equal places inside them wherever they stand, so windows that are alike always meet under the hash of their anchor.
"""

from __future__ import annotations

import numpy as np

from tracemill.llm.words import mix

#: Bytes of an anchor; a power of two.
GRAM = 16
_LOW = np.uint64(0xFFF)
_BYTES = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place (none for the last ``GRAM - 1``)."""
    h = np.take(_BYTES, data)
    factor, size = 0x9E3779B97F4A7C15, 1
    while size < GRAM:
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor, size = factor * factor % 2 ** 64, 2 * size
    return mix(h)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size, out = 1, values
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def leftmost_min(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value of every ``width`` in a row, but for its 12 lowest bits; of equal ones the first.

    Equal runs of values choose alike wherever they stand: runs in which the 12 lowest bits of the
    place start anew are compared by themselves.
    """
    place = np.arange(len(values), dtype=np.uint64)
    least = sliding_min((values & ~_LOW) | (place & _LOW), width)
    start = place[: len(least)]
    chosen = (start + ((least - start) & _LOW)).astype(np.int64)
    across = np.flatnonzero((start & _LOW) + np.uint64(width) > _LOW + np.uint64(1))
    for some in np.array_split(across, len(across) * width // (1 << 20) + 1):
        chosen[some] = some + (values[some[:, None] + np.arange(width)] & ~_LOW).argmin(axis=1)
    return chosen


def range_hash(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, longest: int) -> np.ndarray:
    """Hash of the bytes from ``start`` to ``end``, from the gram hashes that cover them, and of their number."""
    out = (end - start).astype(np.uint64)
    for step in range(0, longest, GRAM):
        out = mix(out * np.uint64(31) + hashes[np.clip(np.minimum(start + step, end - GRAM), 0, len(hashes) - 1)])
    return out


class Runs:
    """Runs of windows with the same anchor in strings that stand one after the other.

    The windows of a run begin at ``first`` to ``last``; ``owner`` is the number of the string,
    ``anchor`` the hash of the anchor and ``at`` its place. A window that begins more than
    ``half`` bytes before its anchor holds the bytes from there to the anchor's end; any other
    holds the ``half`` bytes and more behind the anchor. ``left`` and ``right`` are the hashes of
    these longer strings, which equal windows share just as well, for runs that have such windows.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, width: int):
        self.width, self.half = width, (width - GRAM) // 2
        self.hashes = gram_hashes(data) if len(data) >= width else np.zeros(0, np.uint64)
        self.at, self.first, self.last, self.owner = _runs_of(self.hashes, len(data), ends, width)
        self.anchor = self.hashes[self.at].view(np.int64)
        self.has_left = self.first < self.at - self.half
        self.has_right = self.last >= self.at - self.half
        self.left = self._hash(self.at - self.half - 1, self.at + GRAM)
        self.right = self._hash(self.at, self.at + width - self.half)

    def _hash(self, start, end):
        return range_hash(self.hashes, start, end, self.width).view(np.int64) if len(self.at) else self.at

    def keep(self, left: np.ndarray, right: np.ndarray):
        """The runs cut to their left or right windows, where only one side is wanted: ``anchor, first,
        last, owner`` and a hash of all bytes of the windows."""
        left, right = left & self.has_left, right & self.has_right
        first = np.where(left, self.first, np.maximum(self.first, self.at - self.half))
        last = np.where(right, self.last, np.minimum(self.last, self.at - self.half - 1))
        take = np.flatnonzero(left | right)
        first, last = first[take], last[take]
        content = range_hash(self.hashes, first, last + self.width, 2 * self.width) if len(take) else first
        return self.anchor[take], first, last, self.owner[take], content.view(np.int64)


def _runs_of(hashes: np.ndarray, size: int, ends: np.ndarray, width: int):
    """``at, first, last, owner`` of all runs."""
    none = np.zeros(0, np.int64)
    if size < width:
        return none, none, none, none
    chosen = leftmost_min(hashes, width - GRAM + 1)
    sizes = np.diff(ends, prepend=0)
    # windows that begin in the last bytes of a string reach beyond it; so those of two strings are never neighbours
    inside = np.ones(len(chosen), bool)
    for back in range(1, width):
        place = ends[sizes >= back] - back
        inside[place[place < len(chosen)]] = False
    new, old = inside.copy(), inside.copy()
    same = chosen[1:] == chosen[:-1]
    new[1:] &= ~(same & inside[:-1])
    old[:-1] &= ~(same & inside[1:])
    first, last = np.flatnonzero(new), np.flatnonzero(old)
    return chosen[first], first, last, np.searchsorted(ends, first, side="right")
