"""Mixes of lengths that fill windows: a configuration program solved by weights.

A configuration is a multiset of lengths that fits a window. Wanted is a number for each
configuration such that every length is covered as often as it occurs, with the least
sum. Lengths carry weights that shrink as they are covered; a knapsack over the window
prices the best configuration under the current weights, and configurations worth nearly
as much are used as long as they stay so. The fractions are rounded to whole numbers
that never take more than is there, and what is left is packed best fit.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from dataclasses import dataclass

import numpy as np

#: A configuration worth this share of the best one is as good as it.
NEAR = 0.99
#: Share of a length that one step covers at most, and how much a step lowers a weight.
STEP = 0.5
RATE = 3.0
#: Power of a length that is its worth before anything is covered.
FAVOUR = 1.1
#: Knapsacks solved at most; the more, the closer to the optimum of the fractions.
ROUNDS = 10
#: Times that fractions of what is left are rounded again.
PASSES = 8
#: Configurations taken from one knapsack at most.
PER_ROUND = 400


@dataclass(frozen=True)
class Mix:
    """Windows of one content: how many, and how often each length lies in one."""

    copies: int
    lengths: tuple[tuple[int, int], ...]  # length, times


class Knapsack:
    """Best value of lengths that fit each room, any number of times."""

    def __init__(self, lengths: np.ndarray, window: int):
        self.lengths, self.window = lengths, window

    def solve(self, values: np.ndarray) -> None:
        self.values = values
        best = np.zeros(self.window + 1)
        taken = np.full(self.window + 1, -1, np.int64)
        lengths, limits = self.lengths, np.searchsorted(self.lengths, np.arange(self.window + 1), "right")
        for room in range(int(lengths[0]), self.window + 1):
            count = limits[room]
            worth = best[room - lengths[:count]]
            worth += values[:count]
            k = int(count - 1 - worth[::-1].argmax())  # of equal ones the longest
            if worth[k] > best[room - 1]:
                best[room], taken[room] = worth[k], k
            else:
                best[room] = best[room - 1]
        self.best, self.taken = best, taken

    def content(self, room: int) -> Counter:
        """Indices of the lengths of the best content of a room."""
        found: Counter = Counter()
        while room > 0:
            k = self.taken[room]
            if k < 0:
                room -= 1
            else:
                found[int(k)] += 1
                room -= int(self.lengths[k])
        return found


def fractions(lengths: np.ndarray, counts: np.ndarray, window: int) -> dict[tuple[tuple[int, int], ...], float]:
    """How much of each configuration to use: covers all counts, nearly least in sum."""
    knapsack = Knapsack(lengths, window)
    covered = np.zeros(len(lengths))
    # a length's weight for covering all of it; long ones, hard to place, are worth more than their room
    start = (lengths / window) ** FAVOUR * counts
    used: Counter = Counter()
    for _ in range(ROUNDS):
        weights = start * np.exp(-RATE * covered)
        values = weights / counts
        knapsack.solve(values)
        goal = NEAR * knapsack.best[window]
        # the best configuration that holds a length, for each length, the better ones first
        bound = values + knapsack.best[window - lengths]
        for k in np.lexsort((-lengths, -bound))[:PER_ROUND].tolist():
            if bound[k] < goal:
                break
            content = knapsack.content(window - int(lengths[k]))
            content[k] += 1
            kinds = np.fromiter(content.keys(), np.int64, len(content))
            times = np.fromiter(content.values(), np.float64, len(content))
            now = float((start[kinds] * np.exp(-RATE * covered[kinds]) / counts[kinds] * times).sum())
            if now < goal:
                continue
            step = STEP * float((counts[kinds] / times).min())
            used[tuple(sorted(zip(kinds.tolist(), times.astype(int).tolist(), strict=True)))] += step
            covered[kinds] += step * times / counts[kinds]
    least = covered.min()
    return {c: x / max(least, 1e-9) for c, x in used.items()} if least > 0 else dict(used)


def rounded(lengths: np.ndarray, left: np.ndarray, used: dict, window: int) -> list[Mix]:
    """Whole numbers of configurations, the most used first; takes them out of ``left``.

    What a fraction loses is carried to the next, so that their sum is kept.
    """
    found: list[Mix] = []
    wanted = left.copy()
    cover = np.zeros(len(lengths))
    for content, share in used.items():
        for k, n in content:
            cover[k] += share * n
    carried = 0.0
    for content, share in sorted(used.items(), key=lambda item: (-item[1], item[0])):
        # a length covered too often gives each configuration its part only
        part = min(1.0, *(wanted[k] / cover[k] for k, _ in content))
        carried += share * part
        copies = min(int(carried), *(int(left[k] // n) for k, n in content))
        carried -= max(copies, int(carried))
        if copies:
            for k, n in content:
                left[k] -= copies * n
            found.append(Mix(copies, tuple((int(lengths[k]), n) for k, n in content)))
    return found


def best_fit(counts: dict[int, int], window: int) -> list[Mix]:
    """Longest first, each length into the fullest windows that have room for it, equal windows together."""
    # windows of one content: room, number of the content, how many
    open_rooms: list[tuple[int, int]] = []
    contents: list[list] = []  # copies, {length: times}

    def put(room: int, copies: int, content: dict[int, int]) -> None:
        contents.append([copies, content])
        if room:
            insort(open_rooms, (room, len(contents) - 1))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(open_rooms, (length, -1))
            if at == len(open_rooms):
                each = min(window // length, left)
                copies = left // each
                put(window - each * length, copies, {length: each})
                left -= copies * each
                continue
            room, number = open_rooms.pop(at)
            copies, content = contents[number]
            each = min(room // length, left)
            changed = min(copies, left // each)
            if changed < copies:
                contents[number][0] -= changed
                insort(open_rooms, (room, number))
            else:
                contents[number][0] = 0
            put(room - each * length, changed, {**content, length: content.get(length, 0) + each})
            left -= changed * each
    return [Mix(copies, tuple(sorted(content.items()))) for copies, content in contents if copies]


def mixes(counts: dict[int, int], window: int) -> list[Mix]:
    """Windows for a histogram of lengths, every length exactly as often as it occurs."""
    full = [Mix(counts[window], ((window, 1),))] if counts.get(window) else []
    lengths = np.array(sorted(k for k, n in counts.items() if n and k < window), np.int64)
    if not len(lengths):
        return full
    left = np.array([counts[k] for k in lengths.tolist()], np.int64)
    found: list[Mix] = []
    for _ in range(PASSES):
        some = left > 0
        if not some.any():
            break
        rest = left[some]
        taken = rounded(lengths[some], rest, fractions(lengths[some], rest.astype(float), window), window)
        left[some] = rest
        found += taken
        if not taken:
            break
    return full + found + best_fit({int(lengths[k]): int(left[k]) for k in np.flatnonzero(left)}, window)
