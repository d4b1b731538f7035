"""Agglomerative linkage of a matrix, one merge after the other: what the Spark version is tested against."""

from __future__ import annotations

import numpy as np


def merge_all(matrix: np.ndarray, method: str = "ward") -> np.ndarray:
    """Rows (left, right, height, size) of agglomerative merges; new clusters are numbered on. Ties go to the smallest numbers."""
    n = len(matrix)
    d = np.full((2 * n - 1, 2 * n - 1), np.inf)
    d[:n, :n] = matrix
    d[np.diag_indices(2 * n - 1)] = np.inf
    size = np.ones(2 * n - 1)
    alive, out = list(range(n)), []
    for new in range(n, 2 * n - 1):
        part = d[np.ix_(alive, alive)]
        i, j = divmod(int(part.argmin()), len(alive))
        a, b = sorted((alive[i], alive[j]))
        height = d[a, b]
        size[new] = size[a] + size[b]
        rest = [k for k in alive if k not in (a, b)]
        if method == "single":
            row = np.minimum(d[a, rest], d[b, rest])
        elif method == "complete":
            row = np.maximum(d[a, rest], d[b, rest])
        elif method == "average":
            row = (size[a] * d[a, rest] + size[b] * d[b, rest]) / size[new]
        elif method == "ward":
            s = size[rest]
            row = np.sqrt(((size[a] + s) * d[a, rest] ** 2 + (size[b] + s) * d[b, rest] ** 2 - s * height**2) / (size[new] + s))
        else:
            raise ValueError(method)
        d[new, rest] = d[rest, new] = row
        alive = [*rest, new]
        out.append((a, b, height, size[new]))
    return np.array(out).reshape(-1, 4)


def cut_tree(merges: np.ndarray, k: int) -> np.ndarray:
    """Cluster numbers from 1, in order of first members, after all but the last k - 1 merges."""
    n = len(merges) + 1
    label = list(range(2 * n - 1))
    for i, (a, b, *_rest) in enumerate(merges[: max(n - k, 0)]):
        label[int(a)] = label[int(b)] = n + i

    def top(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    tops = [top(i) for i in range(n)]
    number = {t: i + 1 for i, t in enumerate(dict.fromkeys(tops))}
    return np.array([number[t] for t in tops])


def leaf_order(merges: np.ndarray) -> list[int]:
    n = len(merges) + 1
    order, stack = [], [2 * n - 2]
    while stack:
        i = stack.pop()
        if i < n:
            order.append(i)
        else:
            stack += [int(merges[i - n, 1]), int(merges[i - n, 0])]
    return order


def cophenetic(merges: np.ndarray) -> np.ndarray:
    """Heights at which pairs meet."""
    n = len(merges) + 1
    members = {i: [i] for i in range(n)}
    out = np.zeros((n, n))
    for i, (a, b, h, _size) in enumerate(merges):
        x, y = members.pop(int(a)), members.pop(int(b))
        out[np.ix_(x, y)] = h
        out[np.ix_(y, x)] = h
        members[n + i] = x + y
    return out


def agglomerative_coefficient(merges: np.ndarray) -> float:
    """Mean over items of 1 less its first merge's height over the last one's."""
    n = len(merges) + 1
    first = {int(m): row[2] for row in merges[::-1] for m in row[:2] if m < n}
    return float(np.mean([1 - h / merges[-1, 2] for h in first.values()]))
