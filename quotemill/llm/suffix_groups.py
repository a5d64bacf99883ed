"""Suffix array of an integer sequence by Lyndon-prefix groups, in time linear but for the first order and sorting group members.

First all suffixes with the same first symbol form a group; a group is known by where it
starts in the order. Groups are taken from the last to the first. For each member, the
previous-smaller pointer is the nearest position before it in a smaller group; the
positions pointed at leave their group for a new one right behind it, those hit most
often last. In the end a group holds the suffixes with the same longest Lyndon prefix.
Then each placed suffix places its left neighbour, and what that points at in turn, at
the front of their groups; nothing is renamed or sorted anew.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of `text` in ascending order. The last symbol must be the smallest and occur once."""
    n = len(text)
    if not n:
        return []
    symbols = np.array(text, np.int64)
    by_symbol = np.argsort(symbols, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], np.diff(symbols[by_symbol]) != 0)))
    sizes = np.diff(np.append(heads, n))
    places, starts, counts = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.int64)
    places[by_symbol], starts[by_symbol], counts[heads] = np.arange(n), np.repeat(heads, sizes), sizes
    order, place, start, size, before = by_symbol.tolist(), places.tolist(), starts.tolist(), counts.tolist(), [-1] * n

    def move(old: int, moved: list[int]) -> None:
        """Members of the group at `old` become a group right behind it."""
        if len(moved) == size[old]:
            return
        last = old + size[old] - 1
        first = last + 1 - len(moved)
        for x in moved:
            at, y = place[x], order[last]
            order[at], place[y] = y, at
            order[last], place[x] = x, last
            last -= 1
            start[x] = first
        size[old] -= len(moved)
        size[first] = len(moved)

    # position -1, before all, counts as one of the last symbol's group, which is below every other and never split
    end = n
    while end > 1:
        group = start[order[end - 1]]
        if group == end - 1:
            i = order[group]
            j = i - 1
            while start[j] >= group:
                j = before[j]
            before[i] = j
            if size[start[j]] > 1:
                move(start[j], [j])
            end = group
            continue
        hit, olds = [], set()
        for i in sorted(order[group:end]):
            j = i - 1
            while start[j] >= group:
                j = before[j]
            before[i] = j
            hit.append(j)
            olds.add(start[j])
        if len(olds) == 1 and len(set(hit)) == len(hit):
            old = olds.pop()
            if size[old] > len(hit):
                move(old, hit)
        else:
            hits: dict[int, int] = {}
            for j in hit:
                if j >= 0:
                    hits[j] = hits.get(j, 0) + 1
            moves: dict[tuple[int, int], list[int]] = {}
            for j, n_hits in hits.items():
                moves.setdefault((-n_hits, start[j]), []).append(j)
            for _, old in sorted(moves):
                move(old, moves[_, old])
        end = group

    out, free = [-1] * n, list(range(n))
    placed = [False] * n
    out[0] = n - 1
    placed[n - 1] = True  # also stands for what is before the first
    for k in range(n):
        i = out[k] - 1
        while not placed[i]:
            head = start[i]
            out[free[head]] = i
            free[head] += 1
            placed[i] = True
            i = before[i]
    return out
