"""Two-cluster speaker separation and window votes in numpy, one file at a time."""

from __future__ import annotations

import numpy as np


def unit(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, size, out=np.zeros_like(vectors), where=size > 0)


def two_clusters(vectors: np.ndarray) -> np.ndarray:
    """Labels 0 and 1 by average linkage on cosine distance; the first row is 0."""
    n = len(vectors)
    if n < 2:
        return np.zeros(n, int)
    u = unit(np.asarray(vectors, float))
    far = 1 - u @ u.T
    np.fill_diagonal(far, np.inf)
    size, alive, member = np.ones(n), np.ones(n, bool), np.arange(n)
    for _ in range(n - 2):
        i, j = sorted(np.unravel_index(np.argmin(far), far.shape))
        far[i] = (far[i] * size[i] + far[j] * size[j]) / (size[i] + size[j])
        far[:, i] = far[i]
        far[i, i] = np.inf
        far[j], far[:, j] = np.inf, np.inf
        size[i] += size[j]
        alive[j] = False
        member[member == j] = i
    return (member != member[0]).astype(int)


def silhouette(vectors: np.ndarray, labels: np.ndarray) -> float | None:
    """Mean over rows of (other - own) / larger mean distance; none with one cluster."""
    if len(set(labels.tolist())) < 2:
        return None
    u = unit(np.asarray(vectors, float))
    far, out = 1 - u @ u.T, []
    for i, label in enumerate(labels):
        own, other = labels == label, labels != label
        if own.sum() == 1:
            out.append(0.0)
            continue
        a, b = far[i, own].sum() / (own.sum() - 1), far[i, other].mean()
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def two_means(values: np.ndarray, least_gap: float = 0.08) -> np.ndarray | None:
    """Exact split of numbers into two by least squares, by prefix sums over the sorted numbers; none under ``least_gap`` between the means."""
    n = len(values)
    if n < 2:
        return None
    order = np.argsort(values, kind="stable")
    x = np.asarray(values, float)[order]
    s, q, k = np.cumsum(x), np.cumsum(x * x), np.arange(1, n)
    left = q[:-1] - s[:-1] ** 2 / k
    right = q[-1] - q[:-1] - (s[-1] - s[:-1]) ** 2 / (n - k)
    cut = int(np.argmin(left + right)) + 1
    if x[cut:].mean() - x[:cut].mean() < least_gap:
        return None
    labels = np.zeros(n, int)
    labels[order[cut:]] = 1
    return labels
