"""Suffix arrays by the linear grouping construction, and the matches they show."""

from __future__ import annotations

from collections.abc import Sequence


def groups_by_lyndon_prefix(text: Sequence[int], symbols: int) -> tuple[list[list[int]], list[int], list[int]]:
    """Suffixes grouped by their longest Lyndon prefix: the groups in descending order, the group of each suffix, previous-smaller pointers.

    ``text`` holds ranks below ``symbols``; its last one is 0 and occurs nowhere else.
    Groups start as those of first symbols. They are taken in descending order;
    every suffix of a group finds the previous suffix of a lower group, whose prefix
    grows by the group's: it moves to a new group just above its own, higher the
    more suffixes of the group point to it.
    """
    members: list[list[int]] = [[] for _ in range(symbols)]
    for place, symbol in enumerate(text):
        members[symbol].append(place)
    group = list(text)
    below, above = list(range(-1, symbols - 1)), [*range(1, symbols), -1]
    # The last suffix is taken last, so done[-1] stands for "no suffix before" as well.
    previous, done = [-1] * len(text), bytearray(len(text))
    taken, now = [], symbols - 1
    while now >= 0:
        own = [s for s in members[now] if group[s] == now]
        parents: list[int] = []
        counts: list[int] = []
        for s in own:
            j = s - 1
            while done[j]:
                j = previous[j]
            previous[s] = j
            done[s] = 1
            if j >= 0:
                # Parents come in ascending order, those of one parent together.
                if parents and parents[-1] == j:
                    counts[-1] += 1
                else:
                    parents.append(j)
                    counts.append(1)
        if own:
            taken.append(own)
        for times in sorted(set(counts), reverse=True):
            fresh: dict[int, int] = {}
            for p, count in zip(parents, counts):
                if count != times:
                    continue
                old = group[p]
                new = fresh.get(old)
                if new is None:
                    new = fresh[old] = len(members)
                    members.append([])
                    over = above[old]
                    below.append(old)
                    above.append(over)
                    above[old] = new
                    below[over] = new
                group[p] = new
                members[new].append(p)
        now = below[now]
    return taken, group, previous


def suffix_array(text: Sequence[int], symbols: int) -> list[int]:
    """The places of all suffixes in their order; ``text`` as for :func:`groups_by_lyndon_prefix`.

    Groups get consecutive places. From the smallest suffix on, each one puts the
    suffixes whose Lyndon prefix ends where it begins at the next free place of
    their groups: the one before it and, along the pointers, those before that.
    """
    taken, group, previous = groups_by_lyndon_prefix(text, symbols)
    size = len(text)
    free, at = {}, 0
    for own in reversed(taken):
        free[group[own[0]]] = at
        at += len(own)
    order, placed = [size - 1] * size, bytearray(size)
    placed[size - 1] = 1
    for i in range(size):
        j = order[i] - 1
        while not placed[j]:
            placed[j] = 1
            g = group[j]
            order[free[g]] = j
            free[g] += 1
            j = previous[j]
    return order


def longest_matches(text: Sequence[int], order: list[int]) -> list[int]:
    """For every suffix, how many symbols it shares with the one of all others that it shares most with."""
    size = len(text)
    rank = [0] * size
    for i, s in enumerate(order):
        rank[s] = i
    common, shared = [0] * (size + 1), 0
    for s in range(size - 1):
        # The last suffix is the first in order, so every other one has one before it.
        t = order[rank[s] - 1]
        while text[s + shared] == text[t + shared]:
            shared += 1
        common[rank[s]] = shared
        if shared:
            shared -= 1
    return [max(common[r], common[r + 1]) for r in rank]
