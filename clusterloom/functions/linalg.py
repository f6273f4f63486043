"""NumPy helpers that run inside tasks on one Arrow batch or packed block at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from clusterloom.functions.sparse import MAGIC, Csr, unpacked

#: Type of a sparse feature column.
SPARSE = "struct<size: int, positions: array<int>, values: array<double>>"


def rows_of(column) -> np.ndarray | Csr:
    """(n, d) view of an Arrow list<double> column, or of one of sparse vectors. Null vectors and vectors of different lengths are refused."""
    if pa.types.is_struct(column.type):
        if column.null_count:
            raise ValueError("a feature vector is null")
        size, positions, values = column.flatten()
        widths = size.to_numpy(zero_copy_only=False)
        if len(widths) and (widths != widths[0]).any():
            raise ValueError(f"feature vectors have different lengths: {int(widths.min())} and {int(widths.max())}")
        lengths = positions.value_lengths().to_numpy(zero_copy_only=False)
        flat = (v.flatten().to_numpy(zero_copy_only=False) for v in (positions, values))
        return Csr(np.concatenate(([0], np.cumsum(lengths))), *flat, int(widths[0]) if len(widths) else 0)
    if len(column):
        if column.null_count:
            raise ValueError("a feature vector is null")
        widths = column.value_lengths().to_numpy(zero_copy_only=False)
        if (widths != widths[0]).any():
            raise ValueError(f"feature vectors have different lengths: {int(widths.min())} and {int(widths.max())}")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def vector(v) -> np.ndarray:
    """A collected feature vector, sparse or not, as an array."""
    if not hasattr(v, "positions"):
        return np.array(v, dtype=float)
    out = np.zeros(v.size)
    out[v.positions] = v["values"]
    return out


def sq_norms(x) -> np.ndarray:
    return x.sq_norms() if isinstance(x, Csr) else np.einsum("ij,ij->i", x, x)


def unpack(buffer, n: int) -> np.ndarray | Csr:
    """(n, d) matrix of a packed block."""
    if bytes(memoryview(buffer)[: len(MAGIC)]) == MAGIC:
        return unpacked(buffer)
    return np.frombuffer(buffer, dtype=np.float64).reshape(n, -1)


def sq_dists(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, (n, k).

    A matrix product does the bulk; entries where cancellation matters are recomputed
    from differences, so coinciding points give exactly zero. Stored centre by centre (columns are contiguous), since
    there are few centres and all work on the result is by row.
    """
    out = np.add(sq_norms(x)[None, :], sq_norms(c)[:, None])
    small = out * 1e-9
    prod = np.ascontiguousarray((x @ c.T).T) if isinstance(x, Csr) else c @ x.T
    prod *= 2.0
    out -= prod
    near = out <= small
    out = out.T
    if near.any():
        rows, cols = np.nonzero(near.T)
        for s in range(0, len(rows), 65536):
            r, k = rows[s : s + 65536], cols[s : s + 65536]
            if isinstance(x, Csr):
                for j in np.unique(k):
                    out[r[k == j], j] = x[r[k == j]].dists(c[j : j + 1], "euclidean")[:, 0]
                continue
            diff = x[r] - c[k]
            out[r, k] = np.einsum("ij,ij->i", diff, diff)
    return out


def direct_dists(x: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Distances from plain differences: squared L2 for euclidean, L1 for manhattan, 1 - cos."""
    if metric == "cosine":
        nx, nc = np.sqrt(sq_norms(x)), np.sqrt(sq_norms(c))
        nx[nx == 0], nc[nc == 0] = 1.0, 1.0  # a zero vector is at distance 1 from everything
        return 1.0 - (x @ c.T) / (nx[:, None] * nc[None, :])
    if isinstance(x, Csr):
        return x.dists(c, metric)
    out = np.empty((len(c), len(x))).T
    for j in range(len(c)):
        diff = x - c[j]
        out[:, j] = np.abs(diff).sum(axis=1) if metric == "manhattan" else np.einsum("ij,ij->i", diff, diff)
    return out


def two_least(d: np.ndarray):
    """(index of the least entry of each row, lowest on ties; the entry; the second least), column by column."""
    best, low, second = np.zeros(len(d), np.int64), d[:, 0].copy(), np.full(len(d), np.inf)
    for j in range(1, d.shape[1]):
        col = d[:, j]
        less = col < low
        second = np.minimum(second, np.maximum(col, low))
        np.copyto(best, j, where=less)
        low = np.minimum(low, col)
    return best, low, second


def nearest(x: np.ndarray, c: np.ndarray, metric: str):
    """(index of the nearest centre, its distance); exact ties go to the lowest index."""
    if metric != "euclidean":
        return two_least(direct_dists(x, c, metric))[:2]
    best, low, second = two_least(sq_dists(x, c))
    if len(c) > 1:
        # Near-ties are decided on differences, not on the expanded form.
        scale = sq_norms(x) + sq_norms(c).max() + 1.0
        close = np.nonzero(second - low <= 1e-9 * scale)[0]
        if len(close):
            e = direct_dists(x[close], c, metric)
            best[close] = e.argmin(axis=1)
            low[close] = e[np.arange(len(close)), best[close]]
    return best, np.maximum(low, 0.0)


def own_dists(x, centres: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Euclidean distance of every row to its own centre."""
    if not isinstance(x, Csr):
        return np.sqrt(((x - centres[j]) ** 2).sum(axis=1))
    out = np.empty(len(x))
    for c in np.unique(j):
        out[j == c] = np.sqrt(x[j == c].dists(centres[c : c + 1], "euclidean")[:, 0])
    return out


def group_sums(x: np.ndarray, labels: np.ndarray, k: int, weights=None, out: np.ndarray | None = None) -> np.ndarray:
    """(k, 1 + d): weight and weighted feature sums of each group, in ``out`` if given. Sparse rows are summed group by group."""
    hot = np.zeros((k, len(x)))
    hot[labels, np.arange(len(x))] = 1.0 if weights is None else weights
    out = np.empty((k, 1 + x.shape[1])) if out is None else out
    out[:, 0] = hot.sum(axis=1)
    if isinstance(x, Csr):
        for j in range(k):
            out[j, 1:] = (hot[j : j + 1] @ x)[0]
    else:
        out[:, 1:] = hot @ x
    return out


def kernel(x: np.ndarray, y: np.ndarray, name: str, gamma: float) -> np.ndarray:
    """Kernel values of every row of x with every row of y."""
    prod = x @ y.T
    if name == "linear":
        return prod
    prod *= -2.0
    prod += np.einsum("ij,ij->i", x, x)[:, None]
    prod += np.einsum("ij,ij->i", y, y)[None, :]
    np.maximum(prod, 0.0, out=prod)
    prod *= -gamma
    return np.exp(prod, out=prod)


def power(a: np.ndarray, p: float) -> np.ndarray:
    """a ** p for non-negative a; multiples of one half avoid the general power."""
    if p in (1.0, 2.0, 1.5, 2.5):
        whole = a if p < 2.0 else a * a
        return whole if p in (1.0, 2.0) else whole * np.sqrt(a)
    return a**p


def memberships(x: np.ndarray, centres: np.ndarray, m: float, alpha: float) -> np.ndarray:
    """Fuzzy memberships of each row in each centre, with optional suppression of the losers."""
    d2 = sq_dists(x, centres)
    on_centre = d2 == 0.0
    u = power(np.maximum(d2, 1e-20), 1.0 / (m - 1.0))
    np.divide(1.0, u, out=u)
    u /= u.sum(axis=1, keepdims=True)
    if on_centre.any():
        exact = on_centre.any(axis=1)
        u[exact] = on_centre[exact]
    if alpha < 1.0:
        win = two_least(-u)[0]
        u *= alpha
        for j in range(u.shape[1]):
            u[:, j] += (win == j) * (1.0 - alpha)
    return u


def log_joint(x: np.ndarray, log_weights, means, precisions) -> np.ndarray:
    """log(weight * density) per row and Gaussian component."""
    out, by_feature = np.empty((len(means), len(x))), np.ascontiguousarray(x.T)
    for j, (mu, p) in enumerate(zip(means, precisions)):
        z = p.T @ (by_feature - mu[:, None])
        z *= z
        out[j] = -0.5 * (z.sum(axis=0) + x.shape[1] * np.log(2 * np.pi)) + np.log(np.diag(p)).sum() + log_weights[j]
    return out.T


def label_rows(x: np.ndarray, kind: str, args: tuple) -> np.ndarray:
    """Cluster of every row under a model given by its parameters."""
    if kind == "nearest":
        return nearest(x, *args)[0]
    if kind == "fuzzy":
        return memberships(x, *args).argmax(axis=1)
    return log_joint(x, *args).argmax(axis=1)
