"""Plain versions on one block, which tests hold the operators against."""

import numpy as np


def linkage(matrix: np.ndarray, method: str = "ward", distances: bool = False) -> list[tuple[int, int, float, int]]:
    """Agglomeration of a block of vectors, or of a square of ``distances``, by Lance-Williams updates: (left, right, distance, size), ids from n up for merges."""
    n = len(matrix)
    d = matrix.astype(float) if distances else np.sqrt(np.maximum(((matrix[:, None] - matrix[None]) ** 2).sum(-1), 0))
    np.fill_diagonal(d, np.inf)
    size, name, out = np.ones(n), list(range(n)), []
    live = list(range(n))
    for k in range(n - 1):
        block = d[np.ix_(live, live)]
        i, j = divmod(int(block.argmin()), len(live))
        i, j = sorted((live[i], live[j]))
        out.append((min(name[i], name[j]), max(name[i], name[j]), float(d[i, j]), int(size[i] + size[j])))
        others = [x for x in live if x not in (i, j)]
        di, dj, dij = d[i, others], d[j, others], d[i, j]
        if method == "single":
            new = np.minimum(di, dj)
        elif method == "complete":
            new = np.maximum(di, dj)
        elif method == "average":
            new = (size[i] * di + size[j] * dj) / (size[i] + size[j])
        else:
            total = size[i] + size[j] + size[others]
            new = np.sqrt(((size[i] + size[others]) * di**2 + (size[j] + size[others]) * dj**2 - size[others] * dij**2) / total)
        d[i, others] = d[others, i] = new
        size[i] += size[j]
        name[i] = n + k
        live.remove(j)
    return out


def cut(merges: list[tuple[int, int, float, int]], n: int, threshold: float | None = None, k: int | None = None) -> np.ndarray:
    """Labels of a dendrogram at a distance or a number of clusters, numbered by first member."""
    parent = list(range(n + len(merges)))
    use = len(merges) if k is None else max(0, n - k)
    for step, (a, b, dist, _) in enumerate(merges[:use]):
        if threshold is not None and dist > threshold:
            break
        parent[a] = parent[b] = n + step

    def top(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    tops = [top(i) for i in range(n)]
    order = {t: i for i, t in enumerate(dict.fromkeys(tops))}
    return np.array([order[t] for t in tops])


def factorise(v, w, h, rounds):
    """Multiplicative updates of non-negative factors of a matrix shifted to be positive."""
    x = v - min(0.0, float(v.min())) + 0.01
    for _ in range(rounds):
        h = h * (w.T @ x) / (w.T @ w @ h + 1e-12)
        w = w * (x @ h.T) / (w @ h @ h.T + 1e-12)
    return w, h
