"""Suffix arrays by linear grouping."""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """Start positions of the suffixes in order; the end of the text counts as smaller than any symbol.

    Suffixes are grouped by their Lyndon prefix. Groups start as those of one first symbol and are taken in descending order:
    each member points at the nearest earlier suffix of a lower group (its previous smaller one), and the suffixes so
    pointed at leave their group for a new one right above it, those with more pointers further up, since their Lyndon prefix
    goes on by that many copies of the group's. When the lowest group is done, groups are final. The order within
    them follows from one pass: whenever a suffix gets its place, the suffixes that end their Lyndon prefix at it are
    the next of their groups, and they are found along the pointers.
    """
    n = len(symbols)
    rank = {s: k + 1 for k, s in enumerate(sorted(set(symbols)))}  # group 0 is the end of the text
    group = [rank[s] for s in symbols]
    members: list[list[int]] = [[] for _ in range(len(rank) + 1)]
    for i, g in enumerate(group):
        members[g].append(i)
    below, above = list(range(-1, len(rank))), list(range(1, len(rank) + 2))
    above[-1] = -1
    done = [False] * len(members)
    smaller = [-1] * n
    g = len(rank)
    while g > 0:
        pointers: dict[int, int] = {}
        for i in sorted(i for i in members[g] if group[i] == g):
            j = i - 1
            while j >= 0 and (group[j] == g or done[group[j]]):
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                pointers[j] = pointers.get(j, 0) + 1
        done[g] = True
        by_count: dict[int, list[int]] = {}
        for j, count in pointers.items():
            by_count.setdefault(count, []).append(j)
        for count in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            for j in by_count[count]:
                old = group[j]
                if old not in moved:
                    new = moved[old] = len(members)
                    members.append([])
                    done.append(False)
                    below.append(old)
                    above.append(above[old])
                    if above[old] >= 0:
                        below[above[old]] = new
                    above[old] = new
                group[j] = moved[old]
                members[group[j]].append(j)
        g = below[g]

    size = [0] * len(members)
    for h in group:
        size[h] += 1
    free, at, h = [0] * len(members), 1, above[0]
    while h >= 0:
        free[h] = at
        at += size[h]
        h = above[h]
    order, placed = [n] + [0] * n, [False] * n
    for r in range(n + 1):
        j = order[r] - 1
        while j >= 0 and not placed[j]:
            order[free[group[j]]] = j
            free[group[j]] += 1
            placed[j] = True
            j = smaller[j]
    return order[1:]


def common(symbols: list[int], a: int, b: int) -> int:
    """Length of the common prefix of two suffixes."""
    n, k = len(symbols), 0
    while a + k < n and b + k < n and symbols[a + k] == symbols[b + k]:
        k += 1
    return k
