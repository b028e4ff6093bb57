"""Suffix arrays by grouping: linear, without renaming and recursion.

Suffixes are first grouped by symbol. Groups are then processed from the highest
down: the pointers from a group's suffixes to the nearest earlier suffix of a lower
group say which of those are followed by the group's prefix, and how often in a row;
they leave their group for a new one right above it. When all groups are done, a
group holds the suffixes with one longest Lyndon prefix, and one scan from the
smallest suffix up gives the order within every group.
"""

from __future__ import annotations


class _Group:
    __slots__ = ("members", "below", "above", "done", "free")

    def __init__(self, members: list[int], below: _Group | None = None):
        self.members = members
        self.below = below
        self.above: _Group | None = None
        self.done = False
        self.free = 0


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of all suffixes in lexicographic order; the end sorts before any symbol."""
    n = len(text)
    if n < 2:
        return list(range(n))
    by_symbol: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        by_symbol.setdefault(symbol, []).append(i)
    of: list[_Group] = [None] * n  # type: ignore[list-item]
    top = None
    for symbol in sorted(by_symbol):
        group = _Group(by_symbol[symbol], top)
        if top is not None:
            top.above = group
        top = group
        for i in group.members:
            of[i] = group

    # the lowest group is that of the end, position n; its context precedes everything
    previous = [-1] * n
    group = top
    lowest = None
    while group is not None:
        members = [i for i in group.members if of[i] is group]
        group.members = members
        group.done = True
        counts: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and of[j].done:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                counts[j] = counts.get(j, 0) + 1
        if counts:
            _move_up(counts, of)
        if members:
            lowest = group
        group = group.below

    start = 0
    group = lowest
    while group is not None:
        group.free = start
        start += len(group.members)
        group = group.above

    order = [-1] * n
    placed = [False] * n
    j = n - 1  # the suffixes right before the end come first
    at = 0
    while True:
        while j >= 0 and not placed[j]:
            own = of[j]
            order[own.free] = j
            own.free += 1
            placed[j] = True
            j = previous[j]
        if at == n:
            return order
        j = order[at] - 1
        at += 1


def _move_up(counts: dict[int, int], of: list[_Group]) -> None:
    """Suffixes that are followed equally often leave each group together, the most often first."""
    if len(counts) == 1:
        levels = [list(counts)]
    else:
        by_count: dict[int, list[int]] = {}
        for j, count in counts.items():
            by_count.setdefault(count, []).append(j)
        levels = [by_count[count] for count in sorted(by_count, reverse=True)]
    for level in levels:
        moved: dict[_Group, list[int]] = {}
        for j in level:
            moved.setdefault(of[j], []).append(j)
        for old, members in moved.items():
            new = _Group(members, old)
            new.above = old.above
            if old.above is not None:
                old.above.below = new
            old.above = new
            for j in members:
                of[j] = new


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """Length of the longest common prefix of each suffix in order with the one before it."""
    n = len(text)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    out = [0] * n
    length = 0
    for i in range(n):
        r = rank[i]
        if not r:
            length = 0
            continue
        j = order[r - 1]
        most = n - max(i, j)
        while length < most and text[i + length] == text[j + length]:
            length += 1
        out[r] = length
        if length:
            length -= 1
    return out
