"""Longest common extensions of two places in an array, by a difference cover.

Only suffixes that begin at places of a cover are sorted. For any two places a shift
smaller than the modulus brings both to places of the cover: the words passed over are
compared one by one, and the rest is the least common prefix between two neighbours in
the sorted order, which a table of minima tells.
"""

from __future__ import annotations

import numpy as np

#: Every difference modulo 13 occurs once in this set.
MODULUS = 13
COVER = (0, 1, 3, 9)


def _shifts() -> np.ndarray:
    """Least shift that brings two residues into the cover together."""
    return np.array([
        [next(d for d in range(MODULUS) if (a + d) % MODULUS in COVER and (b + d) % MODULUS in COVER) for b in range(MODULUS)]
        for a in range(MODULUS)
    ])


SHIFTS = _shifts()


class Extensions:
    """An array of numbers, not negative, and the common prefixes of its suffixes."""

    def __init__(self, numbers: np.ndarray):
        self.size = len(numbers)
        last = int(numbers.max(initial=0)) + 1
        # an end that is like no other number, and room to look at whole blocks behind it
        self.numbers = np.r_[numbers, last, np.full(MODULUS, last)].astype(np.int64)
        self.numbers[self.size + 1 :] = 0
        place = np.arange(self.size + 1)
        self.sampled = place[np.isin(place % MODULUS, COVER)]
        self.slot = np.full(self.size + 1, -1, np.int64)
        self.slot[self.sampled] = np.arange(len(self.sampled))
        self._sort()

    def _block_ranks(self) -> np.ndarray:
        """Ranks of the sampled blocks of as many numbers as the modulus."""
        bits = max(1, int(self.numbers.max()).bit_length())
        each = 63 // bits
        columns = []
        for start in range(0, MODULUS, each):
            packed = np.zeros(len(self.sampled), np.int64)
            for k in range(start, min(start + each, MODULUS)):
                packed = packed << bits | self.numbers[self.sampled + k]
            columns.append(packed)
        order = np.lexsort(columns[::-1])
        fresh = np.zeros(len(order), bool)
        for c in columns:
            fresh[1:] |= c[order[1:]] != c[order[:-1]]
        ranks = np.empty(len(order), np.int64)
        ranks[order] = np.cumsum(fresh)
        return ranks

    def _sort(self) -> None:
        """Order of the sampled suffixes by doubling, and their neighbours' common prefixes."""
        count = len(self.sampled)
        levels = [self._block_ranks()]
        step = len(COVER)  # slots a block further, with the same residue
        while levels[-1].max(initial=0) + 1 < count:
            ranks = levels[-1]
            behind = np.zeros(count, np.int64)
            behind[: max(0, count - step)] = ranks[step:] + 1
            keys = ranks * (count + 1) + behind
            order = np.argsort(keys, kind="stable")
            made = np.empty(count, np.int64)
            made[order] = np.cumsum(np.r_[False, keys[order[1:]] != keys[order[:-1]]])
            levels.append(made)
            step *= 2
        self.rank = levels.pop()
        order = np.empty(count, np.int64)
        order[self.rank] = np.arange(count)
        one, two = order[:-1].copy(), order[1:].copy()
        common = np.zeros(count - 1, np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][one] == levels[k][two]
            moved = len(COVER) << k
            one[same] += moved
            two[same] += moved
            common[same] += MODULUS << k
        one, two = self.sampled[one], self.sampled[two]
        alike = np.ones(count - 1, bool)
        for k in range(MODULUS):
            alike &= self.numbers[one + k] == self.numbers[two + k]
            common += alike
        rows = [common.astype(np.int32 if self.size < 2**31 else np.int64)]
        width = 1
        while 2 * width <= count - 1:
            rows.append(np.minimum(rows[-1][:-width], rows[-1][width:]))
            width *= 2
        self.least = np.zeros((len(rows), max(1, count - 1)), rows[0].dtype)
        for k, row in enumerate(rows):
            self.least[k, : len(row)] = row
        self.log = np.zeros(count + 1, np.int64)
        self.log[1:] = np.frexp(np.arange(1, count + 1))[1] - 1

    def between(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many numbers from each place in ``one`` equal those from the place in ``two``; no place beside itself."""
        shift = SHIFTS[one % MODULUS, two % MODULUS]
        found = np.zeros(len(one), np.int64)
        going = np.arange(len(one))
        for k in range(MODULUS):
            ready = shift[going] == k
            if ready.any():
                done = going[ready]
                a, b = self.rank[self.slot[one[done] + k]], self.rank[self.slot[two[done] + k]]
                low, high = np.minimum(a, b), np.maximum(a, b)
                row = self.log[high - low]
                found[done] = k + np.minimum(self.least[row, low], self.least[row, high - (1 << row)])
                going = going[~ready]
            if not len(going):
                break
            same = self.numbers[one[going] + k] == self.numbers[two[going] + k]
            found[going[~same]] = k
            going = going[same]
        return found
