"""Suffix arrays by grouping, after Baier: no renaming, no recursion.

First the suffixes are put into groups by their first symbol. From the greatest group to
the least, each suffix gets a pointer to the nearest earlier one of a lower group; suffixes
that as many members of the group point to move, together, into a group of their own just
above their old one. In the end every group holds the suffixes of one longest Lyndon
prefix. Then the order inside the groups is emitted: along the array, the suffix before
each one just placed, and those its pointers lead to, take the next places of their groups.
"""

from __future__ import annotations

from collections import Counter, defaultdict


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes in order; the end of the sequence sorts first."""
    n = len(symbols) + 1
    # The sentinel makes the last suffix the least.
    text = [s + 1 for s in symbols] + [0]
    first = Counter(text)
    starts, at = {}, 0
    for symbol in sorted(first):
        starts[symbol] = at
        at += first[symbol]
    # A group is a stretch of ``order``, known by its start; ``group`` has it per suffix.
    group = [starts[s] for s in text]
    size = {starts[s]: c for s, c in first.items()}
    fill = dict(starts)
    order, place = [0] * n, [0] * n
    for i, symbol in enumerate(text):
        place[i] = fill[symbol]
        order[fill[symbol]] = i
        fill[symbol] += 1
    before = [-1] * n
    end = n
    while end > 0:
        start = group[order[end - 1]]
        pointed: dict[int, int] = defaultdict(int)
        for i in sorted(order[start:end]):
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            # One that is alone in its group stays.
            if j >= 0 and size[group[j]] > 1:
                pointed[j] += 1
        end = start
        if not pointed:
            continue
        moved: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for j, times in pointed.items():
            moved[times][group[j]].append(j)
        for times in sorted(moved, reverse=True):
            for old, members in moved[times].items():
                if len(members) == size[old]:
                    continue
                # To the end of the stretch, which shrinks: the next set goes below.
                size[old] -= len(members)
                new = old + size[old]
                moving = set(members)
                staying = iter([i for i in order[new : new + len(members)] if i not in moving])
                for j in members:
                    if place[j] < new:
                        other = next(staying)
                        place[j], place[other] = place[other], place[j]
                        order[place[j]], order[place[other]] = j, other
                for j in members:
                    group[j] = new
                size[new] = len(members)
    out, done, free = [n - 1] + [0] * (n - 1), [False] * n, {}
    done[n - 1] = True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not done[j]:
            at = free.get(group[j], group[j])
            free[group[j]] = at + 1
            out[at] = j
            done[j] = True
            j = before[j]
    return out[1:]
