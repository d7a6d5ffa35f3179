"""Counted values in order, kept as small nodes of a keyed state: ranks, medians and deviations without reading all values.

A node covers the values whose sortable bits begin with its name, a string of hexadecimal digits. It holds the values
themselves with their counts while there are ``LEAF`` of them at most, and the counts of its 16 children after that. An
insertion or a search touches one path of nodes, 17 at most, however many values there are.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections.abc import Callable

LEAF = 32
#: values (of a leaf), counts (of the values, or of the 16 children)
Node = tuple[list[float], list[int]]


def sortable(x: float) -> str:
    """16 hexadecimal digits that sort as the doubles do; both zeros are one."""
    (bits,) = struct.unpack(">Q", struct.pack(">d", x + 0.0))
    return f"{bits ^ 0xFFFFFFFFFFFFFFFF if bits >> 63 else bits | 1 << 63:016x}"


class OrderedCounts:
    """``read(name)`` gives a stored node or None; changed nodes stay here until ``changed`` hands them out."""

    def __init__(self, read: Callable[[str], Node | None]) -> None:
        self.read = read
        self.nodes: dict[str, Node | None] = {}
        self.dirty: set[str] = set()

    def _node(self, name: str) -> Node:
        if name not in self.nodes:
            self.nodes[name] = self.read(name)
        return self.nodes[name] or ([], [])

    def _put(self, name: str, values: list[float], counts: list[int]) -> None:
        self.nodes[name] = (values, counts)
        self.dirty.add(name)

    def changed(self) -> dict[str, Node]:
        out = {name: self.nodes[name] for name in sorted(self.dirty)}
        self.dirty.clear()
        return out

    def __len__(self) -> int:
        return sum(self._node("")[1])

    def add(self, x: float, count: int = 1) -> None:
        digits, name = sortable(x), ""
        while True:
            values, counts = self._node(name)
            if counts and not values:  # an inner node
                child = int(digits[len(name)], 16)
                self._put(name, [], [c + count * (i == child) for i, c in enumerate(counts)])
                name = digits[: len(name) + 1]
                continue
            at = bisect_left(values, x)
            if at < len(values) and values[at] == x:
                self._put(name, values, [*counts[:at], counts[at] + count, *counts[at + 1 :]])
                return
            values, counts = [*values[:at], x, *values[at:]], [*counts[:at], count, *counts[at:]]
            self._put(name, values, counts)
            if len(values) > LEAF:
                self._split(name, values, counts)
            return

    def _split(self, name: str, values: list[float], counts: list[int]) -> None:
        parts: list[Node] = [([], []) for _ in range(16)]
        for x, c in zip(values, counts, strict=True):
            part = parts[int(sortable(x)[len(name)], 16)]
            part[0].append(x)
            part[1].append(c)
        self._put(name, [], [sum(part[1]) for part in parts])
        for digit, part in enumerate(parts):
            if part[0]:
                child = f"{name}{digit:x}"
                self._put(child, *part)
                if len(part[0]) > LEAF:
                    self._split(child, *part)

    def at(self, rank: int) -> float:
        """The value of a rank, from 0."""
        name = ""
        while True:
            values, counts = self._node(name)
            for i, c in enumerate(counts):
                if rank < c:
                    break
                rank -= c
            else:
                raise IndexError("rank out of range")
            if values:
                return values[i]
            name += f"{i:x}"

    def below(self, x: float) -> int:
        """How many values are less than ``x``."""
        digits, name, total = sortable(x), "", 0
        while True:
            values, counts = self._node(name)
            if values or not counts:
                return total + sum(counts[: bisect_left(values, x)])
            child = int(digits[len(name)], 16)
            total += sum(counts[:child])
            if not counts[child]:
                return total
            name = digits[: len(name) + 1]

    def median(self) -> float:
        n = len(self)
        low = self.at((n - 1) // 2)
        return low if n % 2 else (low + self.at(n // 2)) / 2

    def _deviation(self, rank: int, centre: float, left: int, n: int) -> float:
        """The deviation of a rank among ``centre - value`` (values downwards from the centre) and ``value - centre``."""
        # of the rank + 1 least deviations, ``taken`` come from the left: the least number that leaves none smaller there
        low, high = max(0, rank + 1 - (n - left)), min(left, rank + 1)
        while low < high:
            taken = (low + high) // 2
            right = rank + 1 - taken
            if centre - self.at(left - 1 - taken) < self.at(left + right - 1) - centre:
                low = taken + 1
            else:
                high = taken
        right = rank + 1 - low
        ends = [centre - self.at(left - low)] if low else []
        ends += [self.at(left + right - 1) - centre] if right else []
        return max(ends)

    def deviation(self, centre: float) -> float:
        """Median of the distances from ``centre``."""
        n, left = len(self), self.below(centre)
        low = self._deviation((n - 1) // 2, centre, left, n)
        return low if n % 2 else (low + self._deviation(n // 2, centre, left, n)) / 2
