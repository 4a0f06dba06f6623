"""Brute-force references used by the tests (small inputs only)."""

import numpy as np


def dbscan_sequential(X, eps, min_samples):
    """Sequential DBSCAN in row order: clusters numbered by their first core point,
    a border point takes the first cluster that reaches it (O(n²) memory)."""
    n = len(X)
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    nb = d2 <= eps * eps
    core = nb.sum(1) >= min_samples
    labels = np.full(n, -1)
    c = 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if labels[j] == -1:
                labels[j] = c
                if core[j]:
                    stack.extend(np.nonzero(nb[j] & (labels == -1))[0].tolist())
        c += 1
    return labels, core
