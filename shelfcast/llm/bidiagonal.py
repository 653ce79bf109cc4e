"""Singular values and right singular vectors of a small square matrix, by qd algorithms.

Householder reflections make the matrix bidiagonal. The differential qd transformation with
shifts finds the squares of the singular values without a subtraction but the shift's, so that
small ones are as accurate as large ones. Each vector comes from the twisted factorisation of
``B'B - value``: one factored from the top, one from the bottom, joined where their last pivot
is smallest.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
# What a neighbour's square may have of a value for the value to stand alone.
NEGLIGIBLE = (100 * EPS) ** 2
# Values nearer to each other than this share of them form a cluster.
CLUSTER = 1e-3
SEED = 17


def bidiagonalised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(diagonal, above, right)`` with ``matrix = left @ B @ right.T`` and B upper bidiagonal."""
    a = np.array(matrix, float)
    size = len(a)
    right = np.eye(size)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        length = v @ v
        return v, 2 / length if length > 0 else 0.0

    for k in range(size):
        v, scale = reflector(a[k:, k])
        a[k:, k:] -= scale * np.outer(v, v @ a[k:, k:])
        if k < size - 1:
            v, scale = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= scale * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= scale * np.outer(right[:, k + 1 :] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def _newton(q: list, e: list) -> float:
    """A bound below the least value: one over the trace of the inverse."""
    row = 1 / q[0]
    total = row
    for k in range(1, len(q)):
        row = (1 + e[k - 1] * row) / q[k]
        total += row
    return 1 / total


def _transformed(q: list, e: list, shift: float) -> tuple[list, list, float] | None:
    """One differential qd step, and its least ``d``; None if the shift was too large."""
    d = q[0] - shift
    least, new_q, new_e = d, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        one = d + e[k]
        ratio = q[k + 1] / one if one > 0 else 0.0
        new_q.append(one)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    return [*new_q, d], new_e, least


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squares of the singular values, rising, of squares of a diagonal and of those above it."""
    found = []
    stack = [(list(map(float, q)), list(map(float, e)), 0.0)]
    while stack:
        q, e, shifted = stack.pop()
        guess = 0.0
        while q:
            cut = [k for k in range(len(e)) if e[k] <= NEGLIGIBLE * (shifted + min(q[k], q[k + 1]))]
            if cut:
                k = cut[-1]
                stack.append((q[: k + 1], e[:k], shifted))
                q, e, guess = q[k + 1 :], e[k + 1 :], 0.0
                continue
            if len(q) == 1:
                found.append(shifted + q[0])
                break
            if min(q) <= 0:
                # A value of zero comes to the end without a shift.
                safe = bold = 0.0
            else:
                safe = _newton(q, e) * (1 - 8 * EPS)
                bold = max(safe, 0.5 * (safe + guess))
            step = _transformed(q, e, bold)
            if step is None:
                bold = safe
                step = _transformed(q, e, bold)
            while step is None:
                # Rounding alone can make the bound too large.
                bold /= 2
                step = _transformed(q, e, bold)
            q, e, guess = step
            shifted += bold
    return np.sort(np.array(found))


def _twisted(q: np.ndarray, a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The vector of ``value`` of a block of ``B'B`` without zeros above the diagonal."""
    size = len(q)
    if size == 1:
        return np.ones(1)
    tiny = EPS * EPS * max(value, 1e-300)
    low = b / a[:-1]
    top, stationary = np.zeros(size - 1), np.zeros(size)
    s = -value
    for i in range(size - 1):
        stationary[i] = s
        pivot = q[i] + s
        pivot = pivot if abs(pivot) > tiny else tiny
        top[i] = low[i] * q[i] / pivot
        s = top[i] * low[i] * s - value
    stationary[-1] = s
    bottom, progressive = np.zeros(size - 1), np.zeros(size)
    p = q[-1] - value
    for i in range(size - 2, -1, -1):
        progressive[i + 1] = p
        pivot = low[i] * low[i] * q[i] + p
        pivot = pivot if abs(pivot) > tiny else tiny
        ratio = q[i] / pivot
        bottom[i] = low[i] * ratio
        p = p * ratio - value
    progressive[0] = p
    twist = int(np.argmin(np.abs(stationary + progressive + value)))
    z = np.zeros(size)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -top[i] * z[i + 1]
    for i in range(twist, size - 1):
        z[i + 1] = -bottom[i] * z[i]
    return z / np.linalg.norm(z)


def _orthogonal(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            z = z - (other @ z) * other
    return z


def _again(gram: np.ndarray, value: float, others: list[np.ndarray], random) -> np.ndarray:
    """A vector of a value that others have too: inverse iteration away from their vectors."""
    # Just beside the value, so that the matrix can be solved with.
    near = gram - value * (1 + 64 * EPS) * np.eye(len(gram))
    z = random.normal(size=len(gram))
    for _ in range(4):
        z = _orthogonal(z, others)
        z = np.linalg.solve(near, z / np.linalg.norm(z))
        z /= np.linalg.norm(z)
    z = _orthogonal(z, others)
    return z / np.linalg.norm(z)


def largest_right_vectors(matrix: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """``(squares, vectors)``: the largest squared singular values, falling, and unit columns."""
    diagonal, above, right = bidiagonalised(matrix)
    size = len(diagonal)
    scale = float(max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0)))
    if scale == 0:
        return np.zeros(min(many, size)), np.eye(size)[:, :many]
    # Rounding of the reflections hides anything smaller.
    a = np.where(np.abs(diagonal) < EPS * EPS * scale, EPS * EPS * scale, diagonal) / scale
    b = np.where(np.abs(above) < EPS * EPS * scale, 0.0, above) / scale
    q, e = a * a, b * b
    ends = [*(np.flatnonzero(e == 0) + 1), size]
    values, start = [], 0
    for end in ends:
        values += [(float(v), start, int(end)) for v in dqds(q[start:end], e[start : end - 1])]
        start = int(end)
    values.sort(key=lambda one: -one[0])
    chosen, gram, random = [], None, np.random.default_rng(SEED)
    for at, (value, start, end) in enumerate(values[:many]):
        z = np.zeros(size)
        z[start:end] = _twisted(q[start:end], a[start:end], b[start : end - 1], value)
        cluster = []
        for before in range(at - 1, -1, -1):
            if values[before][0] - value > CLUSTER * value:
                break
            cluster.append(chosen[before])
        if cluster:
            left = _orthogonal(z, cluster)
            if np.linalg.norm(left) < 0.5:
                if gram is None:
                    whole = np.diag(a) + np.diag(b, 1)
                    gram = whole.T @ whole
                left = _again(gram, value, cluster, random)
            z = left / np.linalg.norm(left)
        chosen.append(z)
    squares = np.array([value for value, _, _ in values[:many]]) * scale * scale
    return squares, right @ np.array(chosen).T
