"""Arithmetic of one ordered stretch of readings for `hold_alerts`. Times are whole microseconds.

A reading at time t first ends an overdue hold (start + hold < t: alert), then a reset clears the hold, then a match
starts one if none is pending. A reading can be a reset and a match at once: equal times have been merged into one
reading with the same effect.
"""

from __future__ import annotations

from bisect import bisect_right
from typing import NamedTuple

import numpy as np


def walk(t, reset, match, hold: int, start: int | None = None, last: int | None = None):
    """(alerts, pending start, its last match) after readings sorted by time.

    `start` is the hold pending on entry and `last` the latest match in it. Alerts are (start + hold, last match).
    """
    alerts: list[tuple[int, int]] = []
    n = len(t)
    # Stretches of matches between resets: [lo, hi), closed by the reading at hi.
    resets = np.flatnonzero(reset)
    lows = np.concatenate(([0], resets + ~match[resets])).astype(np.int64)
    highs = np.concatenate((resets, [n])).astype(np.int64)
    first = t[np.minimum(lows, n - 1)]
    # Only a stretch that lasts longer than the hold can raise an alert; the first and the last one also carry state.
    lasting = (lows < highs) & (t[np.minimum(highs, n - 1)] > first + hold)
    lasting[0] = lasting[-1] = True
    for i in np.flatnonzero(lasting):
        lo, hi = int(lows[i]), int(highs[i])
        if i > 0:
            start = last = None
        if start is None:
            if lo == hi:
                continue
            start = int(t[lo])
        while True:
            nxt = lo + int(np.searchsorted(t[lo:hi], start + hold, side="right"))
            if nxt > lo:
                last = int(t[nxt - 1])
            if nxt == hi:
                break
            alerts.append((start + hold, last))
            start, lo = int(t[nxt]), nxt
        if hi < n:
            if t[hi] > start + hold:
                alerts.append((start + hold, last))
            start = last = None
    return alerts, start, last


class Stretch(NamedTuple):
    """What a stretch of readings of one key does to the hold pending when it begins.

    Without a pending hold it leaves `fresh` behind. With hold start s it leaves `fresh` too if it has a reset;
    else the first `entries` value above s + hold selects the start in `leaves`, and s stays if there is none.
    """

    first: int
    last: int
    reset: bool
    fresh: int | None
    entries: list[int]
    leaves: list[int]

    def after(self, start: int | None, hold: int) -> int | None:
        if start is None or self.reset:
            return self.fresh
        i = bisect_right(self.entries, start + hold)
        return self.leaves[i] if i < len(self.entries) else start


def summarize(t, reset, match, hold: int) -> Stretch:
    _, fresh, _ = walk(t, reset, match, hold)
    if reset.any():
        return Stretch(int(t[0]), int(t[-1]), True, fresh, [], [])
    u = np.unique(t)
    # Each reading points to the first one more than a hold later; follow the pointers to the last in the stretch.
    following = np.searchsorted(u, u + hold, side="right")
    end = np.where(following < len(u), following, np.arange(len(u)))
    while not np.array_equal(end, end[end]):
        end = end[end]
    reachable = min(int(np.searchsorted(u, u[0] + hold, side="right")) + 1, len(u))
    entries, leaves = u[:reachable], u[end[:reachable]]
    keep = np.append(leaves[1:] != leaves[:-1], True)
    return Stretch(int(t[0]), int(t[-1]), False, fresh, entries[keep].tolist(), leaves[keep].tolist())


def join(a: Stretch, b: Stretch, hold: int) -> Stretch:
    """Stretch a followed by stretch b."""
    fresh = b.after(a.fresh, hold)
    if a.reset or b.reset:
        return Stretch(a.first, b.last, True, fresh, [], [])
    entries, leaves = list(a.entries), [b.after(s, hold) for s in a.leaves]
    if entries[-1] <= a.first + hold:
        entries += b.entries
        leaves += b.leaves
    return Stretch(a.first, b.last, False, fresh, entries, leaves)
