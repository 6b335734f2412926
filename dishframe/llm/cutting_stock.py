"""The cutting-stock problem on a histogram of sizes, by column generation.

Sizes are whole numbers up to a capacity. Patterns (columns) say how many of each size one bin holds.
A linear program chooses how often each pattern is used; new patterns are priced by a knapsack
dynamic program on the program's dual values; the solution is rounded down and what is left over is
filled greedily with further patterns, so every item has a place. The input is a histogram, so the
work depends on the number of sizes, never on the number of items.
"""

from __future__ import annotations

import numpy as np


def _best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of greatest value within the capacity."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(sizes, room, side="right")
        best[room] = best[room - 1]
        if fits:
            total = values[:fits] + best[room - sizes[:fits]]
            k = int(total.argmax())
            if total[k] > best[room] + 1e-12:
                best[room], choice[room] = total[k], k
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(best[capacity]), pattern


def relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int, max_columns: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one a row) and their fractional uses: the linear program, started from one-size patterns."""
    m = len(sizes)
    patterns = np.diag((capacity // sizes).astype(float))
    inverse, uses = np.diag(1 / np.diag(patterns)), demand / np.diag(patterns)
    for _ in range(max_columns):
        duals = inverse.sum(axis=0)  # every pattern costs one bin
        value, pattern = _best_pattern(np.maximum(duals, 0), sizes, capacity)
        if value <= 1 + 1e-7:
            break
        step = inverse @ pattern
        able = step > 1e-9
        ratio = np.where(able, uses / np.where(able, step, 1), np.inf)
        out = int(ratio.argmin())
        uses = uses - ratio[out] * step
        uses[out] = ratio[out]
        np.maximum(uses, 0, out=uses)
        row = inverse[out] / step[out]
        inverse = inverse - np.outer(step, row)
        inverse[out] = row
        patterns[out] = pattern
    return patterns, uses


def solve(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern as size -> count, uses), together holding exactly the demand."""
    if not sizes:
        return []
    order = np.argsort(sizes)
    size, left = np.array(sizes)[order], np.array(demand, np.int64)[order]
    patterns, uses = relaxed(size, left.astype(float), capacity)
    out: list[tuple[dict[int, int], int]] = []

    def use(pattern: np.ndarray, times: int) -> None:
        nonlocal left
        held = {int(size[i]): int(pattern[i]) for i in np.flatnonzero(pattern)}
        out.append((held, times))
        left = left - times * pattern.astype(np.int64)

    for pattern, x in zip(patterns, uses):
        on = pattern > 0
        times = min(int(x + 1e-6), int((left[on] // pattern[on]).min())) if on.any() else 0
        if times > 0:
            use(pattern, times)
    while left.any():  # largest first, then whatever still fits
        pattern, room = np.zeros(len(size)), capacity
        for i in np.flatnonzero(left)[::-1]:
            pattern[i] = min(left[i], room // size[i])
            room -= int(pattern[i]) * int(size[i])
        on = pattern > 0
        use(pattern, max(1, int((left[on] // pattern[on]).min())))
    return out
