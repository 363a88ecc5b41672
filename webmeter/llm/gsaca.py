"""Suffix array by linear grouping of Lyndon prefixes.

Phase 1 sorts the suffixes into groups by their Lyndon prefixes (the longest
Lyndon word that starts a suffix).  Groups start as equal first symbols and are
processed in descending order.  For each member the previous-smaller pointer
is the nearest position before it whose group is lower; a position that is
pointed at k times by a group has its prefix extended by the group's prefix k
times, so it moves to a new group right above its old one.

Phase 2 emits the order: going through the array from the least suffix, the
position before a suffix and those on its chain of pointers that are not placed
yet come next in their groups.  Nothing is renamed and nothing recurses.
"""

from __future__ import annotations


def suffix_array(text: bytes) -> list[int]:
    """Start positions of all suffixes in ascending order; a suffix that ends sooner comes first."""
    n = len(text)
    if not n:
        return []
    # groups: members, and the neighbours below in a linked list that grows upwards
    members: list[set[int]] = []
    below: list[int] = []
    above: list[int] = []
    by_symbol: dict[int, list[int]] = {}
    for i, s in enumerate(text):
        by_symbol.setdefault(s, []).append(i)
    group = [0] * n
    for s in sorted(by_symbol):
        g = len(members)
        members.append(set(by_symbol[s]))
        below.append(g - 1)
        above.append(g + 1)
        for i in by_symbol[s]:
            group[i] = g
    top = len(members) - 1
    above[top] = -1
    done = bytearray(n)
    before = [-1] * n
    g = top
    while g >= 0:
        own = members[g]
        if own:
            if len(own) == 1:
                (i,) = own
                done[i] = 1
                j = i - 1
                while j >= 0 and done[j]:
                    j = before[j]
                before[i] = j
                if j >= 0:
                    old = group[j]
                    if len(members[old]) > 1:
                        members[old].remove(j)
                        new = len(members)
                        members.append({j})
                        up = above[old]
                        below.append(old)
                        above.append(up)
                        above[old] = new
                        below[up] = new
                        group[j] = new
            else:
                own = sorted(own)
                for i in own:
                    done[i] = 1
                hits: dict[int, int] = {}
                for i in own:
                    j = i - 1
                    while j >= 0 and done[j]:
                        j = before[j]
                    before[i] = j
                    if j >= 0:
                        hits[j] = hits.get(j, 0) + 1
                if hits:
                    parts: dict[tuple[int, int], list[int]] = {}
                    for j, k in hits.items():
                        parts.setdefault((-k, group[j]), []).append(j)
                    for (_, old), moved in sorted(parts.items()):
                        if len(moved) == len(members[old]):
                            continue
                        members[old].difference_update(moved)
                        new = len(members)
                        members.append(set(moved))
                        up = above[old]
                        below.append(old)
                        above.append(up)
                        above[old] = new
                        below[up] = new
                        for j in moved:
                            group[j] = new
        g = below[g]
    # phase 2
    place = [0] * len(members)
    g, at = 0, 0
    while below[g] >= 0:
        g = below[g]
    while g >= 0:
        place[g] = at
        at += len(members[g])
        g = above[g]
    out = [-1] * n
    placed = bytearray(n)
    # the empty suffix stands before all: its predecessors first
    j = n - 1
    while j >= 0:
        p = place[group[j]]
        out[p] = j
        place[group[j]] = p + 1
        placed[j] = 1
        j = before[j]
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not placed[j]:
            p = place[group[j]]
            out[p] = j
            place[group[j]] = p + 1
            placed[j] = 1
            j = before[j]
    return out
