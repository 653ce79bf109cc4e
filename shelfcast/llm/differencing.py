"""Karmarkar-Karp differencing of sizes into any number of near-equal sums."""

from __future__ import annotations

import heapq

import numpy as np


def differenced(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each size, so that the sums of the windows are nearly equal.

    A partial partition has a sum for every window, in falling order, less its smallest. The
    two of the largest spread are merged time and again, the largest sum of one with the
    smallest of the other, until one is left. Ties go to the earlier one, so reruns agree.
    """
    count = len(sizes)
    order = np.argsort(-sizes, kind="stable")
    # Merges of single sizes fill one window each until all windows have one.
    first = order[:windows]
    sums, held = np.zeros(windows, np.int64), np.full(windows, -1)
    sums[: len(first)], held[: len(first)] = sizes[first], first
    sums -= sums[-1]
    heap, merged, nodes = [(-int(sums[0]), 0, sums, held)], [], count
    for serial, item in enumerate(order[windows:].tolist(), 1):
        sums, held = np.zeros(windows, np.int64), np.full(windows, -1)
        sums[0], held[0] = sizes[item], item
        heap.append((-int(sums[0]) if windows > 1 else 0, serial, sums, held))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, sums, held = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        sums, others = sums + other[::-1], others[::-1]
        # A window that both have holds all that was in either.
        both = np.flatnonzero((held >= 0) & (others >= 0))
        merged.append((held[both], others[both]))
        held = np.where(held < 0, others, held)
        held[both] = np.arange(nodes, nodes + len(both))
        nodes += len(both)
        order = np.argsort(-sums, kind="stable")
        sums, held = sums[order] - sums[order[-1]], held[order]
        heapq.heappush(heap, (-int(sums[0]), serial, sums, held))
        serial += 1
    window, held = np.full(nodes, -1), heap[0][3]
    window[held[held >= 0]] = np.flatnonzero(held >= 0)
    for ones, others in reversed(merged):
        # Windows of nodes made last are known first.
        nodes -= len(ones)
        window[ones] = window[others] = window[nodes : nodes + len(ones)]
    return window[:count]


def packed(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """The window of each size and the number of windows, none above the capacity.

    There are as many windows as the sum asks for, and one more whenever that exceeds the
    capacity; with a window for each size it cannot.
    """
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differenced(sizes, windows)
        if np.bincount(window, sizes, minlength=1).max() <= capacity:
            return window, windows
        windows += 1
