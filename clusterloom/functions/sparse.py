"""Rows of mostly zeros in NumPy: what the block passes need of a matrix, without its zeros."""

from __future__ import annotations

import numpy as np

#: First bytes of a packed sparse block; no dense block of doubles in use begins with them.
MAGIC = b"clusterloom-csr1"
CELLS = 1 << 22  # numbers worked on at once
DENSE_CELLS = 1 << 26  # a matrix of more cells is not written out


class Csr:
    """``offsets`` (n + 1), ``positions`` and ``values`` of the non-zero entries, row by row."""

    __array_ufunc__ = None  # NumPy operators leave the work to the methods here

    def __init__(self, offsets, positions, values, width: int):
        self.offsets, self.positions, self.values = np.asarray(offsets, np.int64), np.asarray(positions, np.int64), np.asarray(values, np.float64)
        self.shape = len(self.offsets) - 1, int(width)

    @classmethod
    def of(cls, x: np.ndarray) -> Csr:
        rows, cols = np.nonzero(x)
        return cls(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(x))))), cols, x[rows, cols], x.shape[1])

    def __len__(self) -> int:
        return self.shape[0]

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def __getitem__(self, rows):
        if isinstance(rows, (int, np.integer)):
            return self[np.array([rows])].dense()[0]
        if isinstance(rows, slice):
            a, b, step = rows.indices(len(self))
            if step == 1:
                lo, hi = self.offsets[a], self.offsets[max(a, b)]
                return Csr(self.offsets[a : max(a, b) + 1] - lo, self.positions[lo:hi], self.values[lo:hi], self.shape[1])
            rows = np.arange(a, b, step)
        rows = np.asarray(rows)
        rows = np.flatnonzero(rows) if rows.dtype == bool else rows
        size = self.lengths[rows]
        offsets = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(offsets[-1]) + np.repeat(self.offsets[rows] - offsets[:-1], size)
        return Csr(offsets, self.positions[at], self.values[at], self.shape[1])

    def row_index(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.lengths)

    def dense(self) -> np.ndarray:
        if self.shape[0] * self.shape[1] > DENSE_CELLS:
            raise ValueError(f"{self.shape[0]} rows of {self.shape[1]} features are too many numbers for an operator without a sparse form")
        out = np.zeros(self.shape)
        out[self.row_index(), self.positions] = self.values
        return out

    def __array__(self, dtype=None, copy=None):
        return self.dense().astype(dtype or float, copy=False)

    def __sub__(self, other):
        return self.dense() - other

    def by_row(self, v: np.ndarray) -> np.ndarray:
        """Sums over the entries of each row; ``v`` has a value, or a vector, per entry."""
        out = np.zeros((len(self), *v.shape[1:]))
        some = self.lengths > 0
        if some.any():
            out[some] = np.add.reduceat(v, self.offsets[:-1][some], axis=0)
        return out

    def sum(self, axis: int) -> np.ndarray:
        return np.bincount(self.positions, weights=self.values, minlength=self.shape[1]) if axis == 0 else self.by_row(self.values)

    def sq_norms(self) -> np.ndarray:
        return self.by_row(self.values**2)

    def __matmul__(self, m: np.ndarray) -> np.ndarray:
        out = np.empty((len(self), m.shape[1]))
        step = max(1, CELLS // max(1, len(self.values)))
        for j in range(0, m.shape[1], step):
            out[:, j : j + step] = self.by_row(self.values[:, None] * m[self.positions, j : j + step])
        return out

    def __rmatmul__(self, m: np.ndarray) -> np.ndarray:
        rows = self.row_index()
        return np.array([np.bincount(self.positions, weights=self.values * w[rows], minlength=self.shape[1]) for w in m]).reshape(len(m), self.shape[1])

    def dists(self, c: np.ndarray, metric: str) -> np.ndarray:
        """Squared Euclidean or Manhattan distances from differences: entries first, then what a centre has elsewhere (exactly 0 where that is nothing)."""
        out = np.empty((len(self), len(c)))
        cost = np.abs if metric == "manhattan" else np.square
        for j, centre in enumerate(c):
            own = centre[self.positions]
            whole, inside = cost(centre).sum(), self.by_row(cost(own))
            elsewhere = np.where(self.by_row((own != 0).astype(float)) == np.count_nonzero(centre), 0.0, np.maximum(whole - inside, 0.0))
            out[:, j] = self.by_row(cost(self.values - own)) + elsewhere
        return out

    def tobytes(self) -> bytes:
        head = np.array([*self.shape, len(self.values)], np.int64)
        return MAGIC + head.tobytes() + self.offsets.tobytes() + self.values.tobytes() + self.positions.astype(np.int32).tobytes()


def unpacked(buffer) -> Csr:
    n, width, size = np.frombuffer(buffer, np.int64, 3, len(MAGIC))
    at = len(MAGIC) + 24
    offsets = np.frombuffer(buffer, np.int64, n + 1, at)
    values = np.frombuffer(buffer, np.float64, size, at + 8 * (n + 1))
    return Csr(offsets, np.frombuffer(buffer, np.int32, size, at + 8 * (n + 1 + size)), values, width)
