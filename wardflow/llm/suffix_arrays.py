"""Suffix arrays of many short texts at once, by Lyndon groups.

The grouping construction has two linear phases and never renames symbols recursively.

1. Suffixes are grouped by their longest Lyndon prefix. Groups start as first symbols and are
   taken in descending order. Every member of the group that is due points to its previous
   smaller position: the nearest one to the left whose group is still to come. Such a
   position's Lyndon prefix goes on with its members' prefixes, so it moves to a new group
   above its old one; more members come above fewer.
2. A suffix consists of its Lyndon prefix and the suffix after it, which is smaller. Going
   through the array from the smallest suffix on, each suffix found puts those that it
   follows into the next free places of their groups.

All texts take a step at the same time, each with the group or place that is due, so numpy
works on many members at once however short the texts are.
"""

from __future__ import annotations

import numpy as np


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places of all suffixes, text by text, in ascending order within each text.

    Text t is ``symbols[bounds[t]:bounds[t + 1]]``, whole numbers below 512; an end of text sorts first.
    """
    lengths = np.diff(bounds)
    # One more place at the end of each text stands for its empty suffix.
    shift = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
    starts = bounds[:-1] + np.arange(len(lengths))
    places = np.arange(len(symbols), dtype=np.int64) + shift
    group, after = _lyndon_groups(symbols, places, shift, starts, lengths)
    found = _filled(group, after, places, starts, lengths)
    return found[places] - shift


def _lyndon_groups(symbols, places, shift, starts, lengths):
    """(group, place after the Lyndon prefix) of every place; a group is its first slot."""
    n = len(places) + len(lengths)
    ends = starts + lengths
    key = shift * 512 + symbols
    order = np.argsort(key, kind="stable")
    slots = np.full(n + 1, -1, np.int64)  # members, group by group within a text
    slots[places] = places[order]
    where = np.empty(n + 1, np.int64)  # the slot of each place
    where[slots[places]] = places
    sorted_key = key[order]
    first = np.append(True, sorted_key[1:] != sorted_key[:-1]) if len(key) else np.empty(0, bool)
    heads = places[first]
    group = np.empty(n + 1, np.int64)
    group[slots[places]] = heads[np.cumsum(first) - 1]
    size = np.zeros(n + 1, np.int64)
    size[heads] = np.diff(np.append(np.flatnonzero(first), len(key)))
    # Places whose group is still to come, as a list linked both ways; -1 before a text.
    left, right = np.arange(-1, n, dtype=np.int64), np.arange(1, n + 2, dtype=np.int64)
    left[starts] = -1
    after = np.empty(n + 1, np.int64)
    moved = np.zeros(n + 1, bool)
    due = ends.copy()
    active = np.flatnonzero(due > starts)
    while len(active):
        top = due[active]
        low = group[slots[top - 1]]
        count = top - low
        members = np.sort(slots[np.repeat(low, count) + _ranges(count)])
        due[active] = low
        active = active[low > starts[active]]
        follower = right[members]
        after[members] = follower
        # Members next to each other in the list share their previous smaller place.
        breaks = np.flatnonzero(follower[:-1] != members[1:])
        begin, end = np.append(0, breaks + 1), np.append(breaks, len(members) - 1)
        parent, beyond = left[members[begin]], follower[end]
        right[parent] = beyond  # parent -1 writes to the spare last element
        left[beyond] = parent
        has = parent >= 0
        parent, number = parent[has], (end - begin + 1)[has]
        if not len(parent):
            continue
        old = group[parent]
        # Nearly always both keys fit one number.
        by = np.argsort(old * (number.max() + 1) + number, kind="stable")
        parent, number, old = parent[by], number[by], old[by]
        new_old = np.append(True, old[1:] != old[:-1])
        new_class = new_old | np.append(True, number[1:] != number[:-1])
        of = np.cumsum(new_old) - 1
        first_of = np.flatnonzero(new_old)
        leaving = np.diff(np.append(first_of, len(old)))
        g = old[first_of]
        stay = size[g] - leaving
        target = (g + stay - first_of)[of] + np.arange(len(old))
        # Others in the slots above change places with those that leave the slots below.
        vacated = where[parent]
        vacated = vacated[vacated < (g + stay)[of]]
        if len(vacated):
            moved[parent] = True
            others = slots[target]
            others = others[~moved[others]]
            moved[parent] = False
            slots[vacated] = others
            where[others] = vacated
        slots[target] = parent
        where[parent] = target
        size[g] = stay
        heads = np.flatnonzero(new_class)
        size[target[heads]] = np.diff(np.append(heads, len(old)))
        group[parent] = target[heads][np.cumsum(new_class) - 1]
    return group, after


def _filled(group, after, places, starts, lengths):
    """Slots filled from the smallest suffix on."""
    n = len(places) + len(lengths)
    by = places[np.argsort(after[places], kind="stable")]
    count = np.bincount(after[places], minlength=n + 1)
    offset = np.cumsum(count) - count
    found = np.full(n + 1, -1, np.int64)
    free = np.arange(n + 1)
    at = starts + lengths  # the empty suffixes come first
    order = np.argsort(-lengths, kind="stable")
    at, base, lengths = at[order], starts[order], lengths[order]
    alive = len(lengths)
    for step in range(int(lengths.max(initial=0)) + 1):
        here = count[at]
        followed = by[np.repeat(offset[at], here) + _ranges(here)]
        slot = group[followed]
        found[free[slot]] = followed
        free[slot] += 1
        alive = int(np.searchsorted(-lengths[:alive], -step, side="left"))
        at = found[base[:alive] + step]
    return found


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. up to each count, one after the other."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)
