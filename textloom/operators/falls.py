"""Values that only fall, over chunks of rows: what a chunk does to such a value, whatever it is on entry.

A value falls at a row if it has at least the row's key, and becomes the row's value, which is below that key.
So it only ever falls at rows whose key is a new low. From each of these the next fall is found by bisection among
them, and where the last fall ends by doubling these steps. A summary lists, for all values that a chunk can be
entered with, where they leave it: one step for each set of values that leave alike. All chunks are summed
up at once, and only summaries meet in the order of the run.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def least_where(holds: Callable[[np.ndarray], np.ndarray], near: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The least double at which each condition holds, found by bisection next to `near`.

    `holds` is one condition per row, and stays true above that double, which lies within some roundings of `scale`.
    """
    low, high = near - 32 * np.finfo(float).eps * scale, near + 32 * np.finfo(float).eps * scale
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return high
        true = holds(middle)
        high = np.where(open_ & true, middle, high)
        low = np.where(open_ & ~true, middle, low)


class Falls:
    """The rows of a chunk at which a value can fall. Keys that are NaN are never reached."""

    def __init__(self, key: np.ndarray, value: np.ndarray) -> None:
        sound = np.flatnonzero(~np.isnan(key))
        low = np.minimum.accumulate(key[sound])
        new = np.ones(len(sound), bool)
        new[1:] = key[sound][1:] <= low[:-1]
        self.rows = sound[new]
        self.key, self.value = key[self.rows], value[self.rows]
        n = len(self.rows)
        self.next = np.maximum(self.find(self.value), np.arange(1, n + 1))

    def find(self, value: np.ndarray) -> np.ndarray:
        """The first of the rows at which a value falls."""
        return np.searchsorted(-self.key, -value, "left")

    def chain(self, value: float) -> np.ndarray:
        """The rows at which a value falls, one after the other."""
        at, out, following = int(self.find(np.float64(value))), [], self.next.tolist()
        while at < len(following):
            out.append(at)
            at = following[at]
        return self.rows[np.array(out, np.int64)]

    def summary(self, low: float, high: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For values of `low` to `high` on entry: falling keys, and the value and row of the last fall of
        whatever has that key at least, and not the one before."""
        n = len(self.rows)
        end = np.where(self.next < n, self.next, np.arange(n))
        while n and (end[end] != end).any():
            end = end[end]
        own = slice(int(self.find(np.float64(high))), min(int(self.find(np.float64(low))) + 1, n))
        key, end = self.key[own], end[own]
        last = np.append(end[1:] != end[:-1], True) if len(end) else np.zeros(0, bool)
        return key[last], self.value[end[last]], self.rows[end[last]]


def leave(key: np.ndarray, value: float) -> int | None:
    """The step of a summary that a value on entry takes; None if it does not fall."""
    at = int(np.searchsorted(-key, -value, "left"))
    return at if at < len(key) else None
