"""Cutting stock by column generation: which mixes of lengths fill bins, and how often.

Works on a histogram of lengths, never on the items, so its cost depends on the number of lengths only.
"""

from __future__ import annotations

import numpy as np

#: The linear program may end this far above its lower bound.
GAP = 0.001
MOST_COLUMNS = 3000

Pattern = dict[int, int]


def price(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value of a bin by unbounded knapsack dynamic programming; values[i] belongs to length i + 1."""
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    for w in range(1, capacity + 1):
        n = min(w, len(values))
        gains = values[:n] + best[w - 1 :: -1][:n]
        i = int(np.argmax(gains))
        best[w], last[w] = (gains[i], i + 1) if gains[i] > best[w - 1] + 1e-12 else (best[w - 1], 0)
    counts, w = np.zeros(len(values), np.int64), capacity
    while w > 0:
        if last[w]:
            counts[last[w] - 1] += 1
            w -= last[w]
        else:
            w -= 1
    return float(best[capacity]), counts


def fractional(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used, by the revised simplex method with columns made on demand."""
    lengths = np.flatnonzero(demand) + 1
    if not len(lengths):
        return []
    need = demand[lengths - 1].astype(float)
    per_bin = capacity // lengths
    columns = [np.where(lengths == u, n, 0) for u, n in zip(lengths, per_bin, strict=True)]
    inverse = np.diag(1.0 / per_bin)
    used = need / per_bin
    for _ in range(MOST_COLUMNS):
        duals = inverse.sum(0)
        values = np.zeros(capacity)
        values[lengths - 1] = np.maximum(duals, 0)
        best, counts = price(values, capacity)
        if best <= 1 + GAP:  # used.sum() / best is a lower bound of the optimum
            break
        column = counts[lengths - 1]
        direction = inverse @ column
        ok = direction > 1e-9
        ratio = np.where(ok, used / np.where(ok, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        used = np.maximum(used - ratio[out] * direction, 0)
        used[out] = ratio[out]
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
        columns[out] = column
    out = []
    for column, x in zip(columns, used, strict=True):
        counts = np.zeros(capacity, np.int64)
        counts[lengths - 1] = column
        out.append((counts, float(x)))
    return out


def best_fit(rest: np.ndarray, capacity: int) -> list[Pattern]:
    """Bins for the items that whole patterns leave over, longest first, each into the fullest bin that takes it."""
    room: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    for u in range(capacity, 0, -1):
        for _ in range(int(rest[u - 1])):
            free = next((r for r in range(u, capacity) if room[r]), capacity)
            bin_ = room[free].pop() if free < capacity else {}
            bin_[u] = bin_.get(u, 0) + 1
            room[free - u].append(bin_)
    return [b for bins in room for b in bins if b]


def plan(demand: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns with whole numbers of bins that hold demand[i] items of length i + 1; a bin holds capacity."""
    rest, out = demand.astype(np.int64).copy(), []
    for counts, x in sorted(fractional(demand, capacity), key=lambda p: -p[1]):
        at = np.flatnonzero(counts)
        times = min([int(x + 1e-6), *(int(rest[i] // counts[i]) for i in at)]) if len(at) else 0
        if times > 0:
            rest -= times * counts
            out.append(({int(i) + 1: int(counts[i]) for i in at}, times))
    return out + [(b, 1) for b in best_fit(rest, capacity)]
