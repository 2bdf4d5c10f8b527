"""Suffix arrays by linear grouping, many small texts side by side.

The construction sorts suffixes in two phases and never renames or recurses.

Phase 1 groups the suffixes of a text by their longest Lyndon prefix.  Groups
start as the suffixes of one first symbol and are taken in descending order.
Each member points to its previous smaller suffix: the last one before it that
is in a lower group.  A pointer skips whole subtrees that were settled before,
so all chases together are linear.  Suffixes that n members of the group point
to leave their own group and become the group just above it, the more members
the higher, since n copies of the group's Lyndon word follow their own.

Phase 2 takes the groups in ascending order.  A suffix is its group's Lyndon
word followed by a smaller suffix that is placed already, or by one more copy
of the word; so a group is sorted by its number of copies and then by the
place of what follows them.

Every step handles one group of each text at once with array operations, so
the number of steps is the number of groups of the longest text.
"""

from __future__ import annotations

import numpy as np


def ranges(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after the other, and which range each belongs to."""
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + begin[owner], owner


def suffix_arrays(symbols: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Positions of all suffixes, text by text, each text's in ascending order.

    ``begins`` holds where each text begins.  A text ends with a symbol that is
    smaller than all others of it.
    """
    n = len(symbols)
    ends = np.append(begins[1:], n)
    text = np.repeat(np.arange(len(begins)), ends - begins)
    key = text * (int(symbols.max(initial=0)) + 1) + symbols
    order = np.argsort(key, kind="stable")
    place, group, stop = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    place[order] = np.arange(n)
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    group[order] = np.repeat(first, np.diff(np.append(first, n)))
    stop[first] = np.append(first[1:], n)
    length, parent = np.ones(n, np.int64), np.full(n, -1, np.int64)
    _group(order, place, group, stop, length, parent, begins, ends)
    return _emit(order, place, group, length, begins, ends)


def _group(order, place, group, stop, length, parent, begins, ends) -> None:
    """Phase 1, in place.  ``group`` of a suffix is where its group begins in ``order``,
    ``stop`` of that place is where the group ends, ``length`` is that of the Lyndon prefix."""
    lowest, high = begins, ends.copy()
    while len(high):
        low = group[order[high - 1]]
        at, owner = ranges(low, high - low)
        members = order[at]
        low_of, high_of, edge = low[owner], high[owner], lowest[owner]

        # previous smaller pointers; a member of the same group is followed in the next loop
        seen = members - 1
        open_ = np.flatnonzero(seen >= edge)
        seen[seen < edge] = -1
        while len(open_):
            g = group[seen[open_]]
            settled = g >= high_of[open_]
            open_ = open_[settled]
            seen[open_] = parent[seen[open_]]
            open_ = open_[seen[open_] >= 0]
        parent[members] = seen
        same = np.flatnonzero((seen >= 0) & (group[seen] >= low_of))
        while len(same):
            seen[same] = parent[seen[same]]
            parent[members[same]] = seen[same]
            same = same[seen[same] >= 0]
            same = same[group[seen[same]] >= low_of[same]]

        # suffixes pointed to leave for the groups just above their own
        pointed = seen >= 0
        above = np.sort(seen[pointed])
        if len(above):
            np.add.at(length, seen[pointed], length[members[pointed]])
            edges = np.flatnonzero(np.diff(above, prepend=-1))
            target, copies = above[edges], np.diff(np.append(edges, len(above)))
            by = np.lexsort((copies, group[target]))
            target, copies = target[by], copies[by]
            g = group[target]
            g_first = np.flatnonzero(np.diff(g, prepend=-1))
            g_count = np.diff(np.append(g_first, len(g)))
            g_stop = stop[g[g_first]]
            slots, _ = ranges(g_stop - g_count, g_count)
            zone = np.repeat(g_stop - g_count, g_count)
            left, held = place[target], order[slots]
            leaving = np.zeros(len(held), bool)
            at_target = np.searchsorted(above, held)
            leaving[at_target < len(above)] = above[at_target[at_target < len(above)]] == held[at_target < len(above)]
            free, moved = left[left < zone], held[~leaving]
            order[free] = moved
            place[moved] = free
            order[slots] = target
            place[target] = slots
            stop[g[g_first]] = g_stop - g_count
            new = np.flatnonzero((np.diff(g, prepend=-1) != 0) | (np.diff(copies, prepend=0) != 0))
            size = np.diff(np.append(new, len(g)))
            group[target] = np.repeat(slots[new], size)
            stop[slots[new]] = slots[new] + size

        more = low > lowest
        lowest, high = lowest[more], low[more]


def _emit(order, place, group, length, begins, ends) -> np.ndarray:
    """Phase 2: groups in ascending order; a group of one is in its place already."""
    first = np.flatnonzero(np.diff(group[order], prepend=-1))
    size = np.diff(np.append(first, len(order)))
    first, size = first[size > 1], size[size > 1]
    # the k-th group of every text is handled in step k
    owner = np.searchsorted(begins, first, "right")
    step = np.arange(len(first)) - np.searchsorted(owner, owner, "left")
    by = np.argsort(step, kind="stable")
    cuts = np.searchsorted(step[by], np.arange(int(step.max(initial=-1)) + 2))
    for a, b in zip(cuts[:-1], cuts[1:]):
        chosen = by[a:b]
        at, which = ranges(first[chosen], size[chosen])
        members = order[at]
        own = first[chosen][which]
        after, copies = members + length[members], np.zeros(len(members), np.int64)
        again = np.flatnonzero(group[after] == own)
        while len(again):
            copies[again] += 1
            after[again] += length[members[again]]
            again = again[group[after[again]] == own[again]]
        sorted_ = members[np.lexsort((place[after], copies, which))]
        order[at] = sorted_
        place[sorted_] = at
    return order
