"""Kernel K-Means with linear or RBF kernel.

The kernel matrix is never stored. Each distinct row keeps s[c], its kernel sum over the members of
every cluster; when labels change, only the kernel columns of the rows that changed are
evaluated to correct those sums, which is exact and shrinks quickly. Changed rows are sent to all
tasks while their checked size allows it and meet the table block by block otherwise. All k of a
sweep share every kernel value.

With the linear kernel the sum over a cluster is the inner product with the sum of its rows, so that rows need
only the feature sums by which clusters change: one aggregate a round, no row is sent anywhere.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.functions import columns as C
from clusterloom.functions import linalg
from clusterloom.operators.blocks import BROADCAST_BYTES, DRIVER_BYTES, Blocks
from clusterloom.operators.pairs import block_pairs
from clusterloom.session import cut_lineage

KERNELS = ("linear", "rbf")
CUT_EVERY = 5  # label rounds between checkpoints
FEW = 2048  # so many changed rows or fewer: the totals follow from them
KERNEL_TILE = 1024  # kernel values are evaluated tile by tile: 8 MiB, which stay in the processor's cache
PARTITION_BYTES = 32 << 20


@dataclass
class KernelModel:
    k: int
    kernel: str
    gamma: float
    start_ids: list
    labels: DataFrame  # (id, cluster) for every input row
    inertia: float
    iterations: int
    shared: DataFrame  # (id, labels): one cluster per k of the sweep
    slot: int  # position of this k in ``labels``


class _Layout:
    """Positions of the clusters of all models in one flat vector."""

    def __init__(self, ks: list[int]):
        self.ks = ks
        self.at = np.concatenate([[0], np.cumsum(ks)]).astype(int)
        self.width = int(self.at[-1])

    def deltas(self, old: np.ndarray, new: np.ndarray, w: np.ndarray) -> np.ndarray:
        """(n, width) weight added to the new and taken from the old cluster of every model."""
        out = np.zeros((len(w), self.width))
        rows = np.arange(len(w))
        for m, a in enumerate(self.at[:-1]):
            np.add.at(out, (rows, a + new[:, m]), w)
            had = old[:, m] >= 0
            np.add.at(out, (rows[had], a + old[had, m]), -w[had])
        return out


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Equal rows become one weighted row under their smallest id."""
    return rows.groupBy("features").agg(F.min("id").alias("id"), F.count("*").cast("double").alias("w")).select("id", "features", "w")


def fit_kernel_kmeans(
    df: DataFrame | Blocks, ks: list[int], kernel: str = "rbf", gamma: float | None = None, max_iters: int = 300,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> dict[int, KernelModel]:
    """Fit every k. The start is deterministic, so there is no seed."""
    if kernel not in KERNELS:
        raise ValueError(f"kernel must be one of {KERNELS}, got {kernel!r}")
    rows = df.rows if isinstance(df, Blocks) else df.select("id", F.col("features").cast("array<double>").alias("features"))
    distinct = distinct_rows(rows).persist(StorageLevel.MEMORY_AND_DISK)
    blocks = Blocks(distinct)
    spread = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(blocks.bytes() / PARTITION_BYTES))
    placed = distinct.repartition(spread, "id").persist(StorageLevel.MEMORY_AND_DISK)
    total = distinct.agg(F.sum("w")).first()[0]
    gamma = 1.0 / blocks.d if gamma is None else float(gamma)
    chosen = start_points(placed, blocks, max(ks), kernel, gamma, total, broadcast_bytes)
    lay = _Layout(list(ks))
    centres = np.array([b.features for b in chosen])
    kzz = np.diag(linalg.kernel(centres, centres, kernel, gamma)).copy()

    def first_labels(x, kxx):
        dist = kxx[:, None] + kzz[None, :] - 2.0 * linalg.kernel(x, centres, kernel, gamma)
        return np.stack([dist[:, :k].argmin(axis=1) for k in lay.ks], axis=1)

    state = _blank(placed, lay)
    small = kernel != "linear" and blocks.n * _row_bytes(blocks.d, lay) <= broadcast_bytes
    start = lambda x, kxx, lab, s: first_labels(x, kxx)
    state = _corrected(state, start, lay, kernel, gamma, _changes(state, start, kernel) if small else None)
    held, rounds, totals = [], np.zeros(len(ks), int), None
    for it in range(1, max_iters + 1):
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(state)
        if totals is None:
            totals = _totals(state, lay, spread)
        relabel = _relabeller(lay, *totals)
        changes = None
        if small:
            changes = _changes(state, relabel, kernel)
            moved = changes.per_model()
        else:
            moved, rows_moved = _moved(state, relabel, lay, kernel, spread)
            if kernel != "linear" and rows_moved * _row_bytes(blocks.d, lay) <= broadcast_bytes:
                changes = _changes(state, relabel, kernel)
        rounds[: len(moved)][moved > 0] = it
        if not moved.any() or it == max_iters:
            break
        state = _corrected(state, relabel, lay, kernel, gamma, changes)
        # few changes: the totals follow from them; otherwise, and now and then, count afresh
        few = changes is not None and len(changes.w) <= FEW and it % CUT_EVERY
        totals = changes.follow(totals, lay, kernel, gamma) if few else None
        if it % CUT_EVERY == 0:
            state = cut_lineage(state)
            for h in held:
                h.unpersist()
            held = []
    final, inertia = _finish(state, relabel, lay, kernel)
    final = cut_lineage(final)
    blocks.unpersist()
    distinct.unpersist()
    placed.unpersist()
    for h in held:
        h.unpersist()
    by_row = rows.join(final, "features").select(rows["id"], "labels")
    return {
        k: KernelModel(k, kernel, gamma, [b.id for b in chosen[:k]], by_row.select("id", F.col("labels")[i].alias("cluster")), float(inertia[i]), int(min(rounds[i] + 1, max_iters)), by_row, i)
        for i, k in enumerate(lay.ks)
    }


def self_kernel(kernel: str) -> F.Column:
    return F.lit(1.0) if kernel == "rbf" else C.dot(F.col("features"), F.col("features"))


def _diag(x: np.ndarray, kernel: str) -> np.ndarray:
    return np.ones(len(x)) if kernel == "rbf" else np.einsum("ij,ij->i", x, x)


def _blank(distinct: DataFrame, lay: _Layout) -> DataFrame:
    return distinct.select(
        "id", "features", "w",
        F.array_repeat(F.lit(-1), len(lay.ks)).alias("lab"), F.array_repeat(F.lit(0.0), lay.width).alias("s"),
    )


def kernel_row_sums(distinct: DataFrame, blocks: Blocks, kernel: str, gamma: float, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id, features, w, s): s[0] is the weighted kernel sum of a row over the whole table."""
    lay = _Layout([1])
    everyone = lambda x, kxx, lab, s: np.zeros((len(x), 1), int)
    state = _blank(distinct, lay)
    small = kernel != "linear" and blocks.n * _row_bytes(blocks.d, lay) <= broadcast_bytes
    return _corrected(state, everyone, lay, kernel, gamma, _changes(state, everyone, kernel) if small else None)


def _row_bytes(d: int, lay: _Layout) -> int:
    """Size of one changed row as it is sent to the tasks."""
    return 8 * (d + 2 + lay.width)


def com_distance(distinct: DataFrame, blocks: Blocks, kernel: str, gamma: float, total: float, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id, features, com): squared distance to the centre of mass up to a constant."""
    sums = kernel_row_sums(distinct, blocks, kernel, gamma, broadcast_bytes)
    return sums.select("id", "features", (self_kernel(kernel) - F.lit(2.0) * F.col("s")[0] / F.lit(float(total))).alias("com"))


def start_points(distinct: DataFrame, blocks: Blocks, k: int, kernel: str, gamma: float, total: float, broadcast_bytes: int = BROADCAST_BYTES):
    """The row farthest from the centre of mass, then MaxMin in feature space, one new point measured a step. A prefix serves a smaller k."""
    from clusterloom.operators.blocks import Best

    first = com_distance(distinct, blocks, kernel, gamma, total, broadcast_bytes).orderBy(F.desc("com"), "id").limit(1).first()
    chosen = [Best(first["com"], first["id"], np.array(first["features"]))]
    run = blocks.running(1)
    while len(chosen) < k:
        z = chosen[-1].features[None, :]
        kzz = float(linalg.kernel(z, z, kernel, gamma)[0, 0])

        def score(x, ids, m, z=z, kzz=kzz):
            d = (_diag(x, kernel) + kzz - 2.0 * linalg.kernel(x, z, kernel, gamma)[:, 0])[None, :]
            return d if m is None else np.minimum(m, d)

        chosen.append(run.step(score)[0])
    run.close()
    return chosen


def _batches(table):
    """(x, w, lab, s, id, features) of each non-empty Arrow batch of the state."""
    for b in table:
        if b.num_rows:
            yield (
                linalg.rows_of(b.column("features")), b.column("w").to_numpy(), linalg.rows_of(b.column("lab")),
                linalg.rows_of(b.column("s")), b,
            )


def _summed(partials: DataFrame, width: int, parts: int) -> np.ndarray:
    """Column sums by the first column; partials of many partitions are reduced on executors first."""
    key, *values = partials.columns
    if parts * width * len(partials.columns) * 8 > DRIVER_BYTES:
        partials = partials.groupBy(key).agg(*[F.sum(v).alias(v) for v in values])
    table = partials.toArrow()
    out = np.zeros((len(values), width))
    for row, v in zip(out, values):
        np.add.at(row, table.column(key).to_numpy(), table.column(v).to_numpy())
    return out


def _totals(state: DataFrame, lay: _Layout, parts: int):
    """Per cluster: weight, and kernel sum over its member pairs."""

    def partial(table):
        size, inner = np.zeros(lay.width), np.zeros(lay.width)
        for _, w, lab, s, _ in _batches(table):
            rows = np.arange(len(w))
            for m, a in enumerate(lay.at[:-1]):
                c = a + lab[:, m]
                size += np.bincount(c, weights=w, minlength=lay.width)
                inner += np.bincount(c, weights=w * s[rows, c], minlength=lay.width)
        yield pa.RecordBatch.from_pydict({"c": pa.array(range(lay.width), pa.int32()), "size": size, "inner": inner})

    return _summed(state.mapInArrow(partial, "c int, size double, inner double"), lay.width, parts)


def _relabeller(lay: _Layout, size: np.ndarray, inner: np.ndarray):
    """(x, kxx, lab, s) -> new labels; an empty cluster is infinitely far."""

    def relabel(x, kxx, lab, s, with_cost=False):
        with np.errstate(divide="ignore", invalid="ignore"):
            dist = kxx[:, None] - 2.0 * s / size + inner / size**2
        dist[:, size == 0] = np.inf
        parts = [dist[:, a:b] for a, b in zip(lay.at[:-1], lay.at[1:])]
        new = np.stack([p.argmin(axis=1) for p in parts], axis=1)
        return (new, np.stack([p.min(axis=1) for p in parts], axis=1)) if with_cost else new

    return relabel


def _moved(state: DataFrame, relabel, lay: _Layout, kernel: str, parts: int) -> tuple[np.ndarray, int]:
    """Rows that change label per model, and rows that change in any model."""
    m = len(lay.ks)

    def count(table):
        n = np.zeros(m + 1, np.int64)
        for x, _, lab, s, _ in _batches(table):
            diff = relabel(x, _diag(x, kernel), lab, s) != lab
            n[:m] += diff.sum(axis=0)
            n[m] += diff.any(axis=1).sum()
        yield pa.RecordBatch.from_pydict({"m": pa.array(range(m + 1), pa.int32()), "n": n})

    out = _summed(state.mapInArrow(count, "m int, n bigint"), m + 1, parts)[0]
    return out[:m], int(out[m])


def _relabelled(state: DataFrame, new_labels, kernel: str) -> DataFrame:
    """The state with one more column: the labels it moves to."""
    id_type = state.schema["id"].dataType.simpleString()

    def emit(table):
        for x, _, lab, s, b in _batches(table):
            new = np.asarray(new_labels(x, _diag(x, kernel), lab, s), dtype=np.int32)
            offsets = pa.array(np.arange(len(new) + 1, dtype=np.int32) * new.shape[1])
            arrays = [b.column(c) for c in ("id", "features", "w", "lab", "s")] + [pa.ListArray.from_arrays(offsets, pa.array(new.ravel()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "features", "w", "lab", "s", "new"])

    return state.mapInArrow(emit, f"id {id_type}, features array<double>, w double, lab array<int>, s array<double>, new array<int>")


@dataclass
class _Changes:
    """Rows that change label, with their kernel sums before the change."""

    x: np.ndarray
    old: np.ndarray
    new: np.ndarray
    w: np.ndarray
    s: np.ndarray

    def per_model(self) -> np.ndarray:
        return (self.old != self.new).sum(axis=0) if len(self.w) else np.zeros(1, int)

    def follow(self, totals, lay: _Layout, kernel: str, gamma: float) -> np.ndarray:
        """Cluster weights and member-pair sums after the change."""
        delta = lay.deltas(self.old, self.new, self.w)
        among = linalg.kernel(self.x, self.x, kernel, gamma) @ delta
        return np.array([totals[0] + delta.sum(axis=0), totals[1] + (delta * (2.0 * self.s + among)).sum(axis=0)])


def _changes(state: DataFrame, new_labels, kernel: str) -> _Changes:
    """The changing rows on the driver; callers check their size first."""
    moved = _relabelled(state, new_labels, kernel).where("lab != new").select("features", "w", "lab", "new", "s").toArrow().combine_chunks()
    x, old, new, s = (linalg.rows_of(moved.column(c).combine_chunks()) for c in ("features", "lab", "new", "s"))
    return _Changes(x, old, new, moved.column("w").to_numpy(), s)


def _corrected(state, new_labels, lay, kernel, gamma, changes: _Changes | None) -> DataFrame:
    """State after the move to ``new_labels``: kernel sums corrected by the rows that changed.

    ``changes`` None: too many changed rows to send around, they meet the table block by block.
    """
    if kernel == "linear":
        return _corrected_by_sums(state, new_labels, lay)
    if changes is None:
        return _corrected_by_blocks(_relabelled(state, new_labels, kernel), lay, kernel, gamma)
    payload = state.sparkSession.sparkContext.broadcast((changes.x, lay.deltas(changes.old, changes.new, changes.w)))
    id_type = state.schema["id"].dataType.simpleString()

    def emit(table):
        members, delta = payload.value
        for x, w, lab, s, b in _batches(table):
            new = np.asarray(new_labels(x, _diag(x, kernel), lab, s), dtype=np.int32)
            fresh = s + _kernel_sums(x, members, delta, kernel, gamma)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("features"), b.column("w"), _lists(new), _lists(fresh)], names=["id", "features", "w", "lab", "s"])

    return state.mapInArrow(emit, f"id {id_type}, features array<double>, w double, lab array<int>, s array<double>")


def _corrected_by_sums(state: DataFrame, new_labels, lay: _Layout) -> DataFrame:
    """The same for the linear kernel, from the features that each cluster gains (width x d numbers)."""
    id_type = state.schema["id"].dataType.simpleString()

    def gains(table):
        total = None
        for x, w, lab, s, _ in _batches(table):
            new = np.asarray(new_labels(x, _diag(x, "linear"), lab, s), dtype=np.int32)
            hit = (new != lab).any(axis=1)
            gained = lay.deltas(lab[hit], new[hit], w[hit]).T @ x[hit]
            total = gained if total is None else total + gained
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(lay.width), pa.int32()), _lists(total)], names=["c", "v"])

    parts = state.mapInArrow(gains, "c int, v array<double>")
    table = parts.groupBy("c").agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("v")))).alias("v")).orderBy("c").toArrow().combine_chunks()
    payload = state.sparkSession.sparkContext.broadcast(linalg.rows_of(table.column("v").combine_chunks()).T.copy() if table.num_rows else None)

    def emit(table):
        for x, w, lab, s, b in _batches(table):
            new = np.asarray(new_labels(x, _diag(x, "linear"), lab, s), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("features"), b.column("w"), _lists(new), _lists(s + x @ payload.value)], names=["id", "features", "w", "lab", "s"])

    return state.mapInArrow(emit, f"id {id_type}, features array<double>, w double, lab array<int>, s array<double>")


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(np.ascontiguousarray(m).ravel()))


def _kernel_sums(x: np.ndarray, y: np.ndarray, delta: np.ndarray, kernel: str, gamma: float) -> np.ndarray:
    """Kernel matrix of x and y times ``delta``, tile by tile."""
    out = np.zeros((len(x), delta.shape[1]))
    for a in range(0, len(x), KERNEL_TILE):
        for c in range(0, len(y), KERNEL_TILE):
            out[a : a + KERNEL_TILE] += linalg.kernel(x[a : a + KERNEL_TILE], y[c : c + KERNEL_TILE], kernel, gamma) @ delta[c : c + KERNEL_TILE]
    return out


def _mutual_sums(x: np.ndarray, y: np.ndarray, dx: np.ndarray, dy: np.ndarray, kernel: str, gamma: float, same: bool):
    """What x gains by the changes of y, and y by those of x: each kernel value is evaluated once. The first ``len(dx)`` rows of x and ``len(dy)`` of
    y change; ``same``: y is x."""
    gain_x = np.zeros((len(x), dx.shape[1]))
    gain_y = gain_x if same else np.zeros((len(y), dx.shape[1]))
    for a in range(0, len(x), KERNEL_TILE):
        for c in range(a if same else 0, len(y), KERNEL_TILE):
            by_x, by_y = dx[a : a + KERNEL_TILE], dy[c : c + KERNEL_TILE]
            if not len(by_x) and not len(by_y):
                break  # nor does any later row of y change
            values = linalg.kernel(x[a : a + KERNEL_TILE], y[c : c + KERNEL_TILE], kernel, gamma)
            if len(by_y):
                gain_x[a : a + KERNEL_TILE] += values[:, : len(by_y)] @ by_y
            if len(by_x) and not (same and a == c):
                gain_y[c : c + KERNEL_TILE] += values[: len(by_x)].T @ by_x
    return gain_x, gain_y


def _corrected_by_blocks(ahead: DataFrame, lay: _Layout, kernel: str, gamma: float) -> DataFrame:
    """The same without sending the changed rows to every task."""
    id_type = ahead.schema["id"].dataType.simpleString()

    def changed_first(side):
        """(ids, features, weights moved by the rows that change), those rows first."""
        hit = (side["lab"] != side["new"]).any(axis=1)
        moves = lay.deltas(side["lab"][hit], side["new"][hit], side["w"][hit])
        if hit.all() or not hit.any():
            return side["id"], side["features"], moves
        order = np.argsort(~hit, kind="stable")
        return side["id"].take(pa.array(order)), side["features"][order], moves

    def meet(left, right, same):
        ids, x, moves = changed_first(left)
        others, y, their = (ids, x, moves) if same else changed_first(right)
        if not len(moves) and not len(their):
            return []
        gains = _mutual_sums(x, y, moves, their, kernel, gamma, same)
        found = [(ids, gains[0], their)] if same else [(ids, gains[0], their), (others, gains[1], moves)]
        return [pa.RecordBatch.from_arrays([i, _lists(g)], names=["id", "v"]) for i, g, by in found if len(by)]

    slim = ahead.select("id", "features", "w", "lab", "new")
    gained = block_pairs(slim, meet, f"id {id_type}, v array<double>")
    gained = gained.groupBy("id").agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("v")))).alias("v"))
    joined = ahead.join(gained, "id", "left")
    s = F.when(F.col("v").isNull(), F.col("s")).otherwise(F.zip_with("s", "v", lambda a, b: a + b))
    return joined.select("id", "features", "w", F.col("new").alias("lab"), s.alias("s"))


def _finish(state: DataFrame, relabel, lay: _Layout, kernel: str):
    """(features, labels) after the last assignment, and the inertia of each model."""

    def emit(table):
        for x, w, lab, s, b in _batches(table):
            new, cost = relabel(x, _diag(x, kernel), lab, s, with_cost=True)
            yield pa.RecordBatch.from_arrays([b.column("features"), _lists(new.astype(np.int32)), _lists(cost * w[:, None])], names=["features", "labels", "cost"])

    done = state.mapInArrow(emit, "features array<double>, labels array<int>, cost array<double>")
    inertia = np.zeros(len(lay.ks))
    for r in done.select(F.posexplode("cost").alias("m", "c")).groupBy("m").agg(F.sum("c")).collect():
        inertia[r[0]] = r[1]
    return done.select("features", "labels"), inertia


class KernelKMeans:
    """Single-model front. ``tol`` and ``random_state`` are accepted and have no effect."""

    def __init__(self, n_clusters: int, max_iters: int = 300, tol: float = 1e-4, kernel: str = "rbf", gamma: float | None = None, random_state=None):
        if kernel not in KERNELS:
            raise ValueError(f"kernel must be one of {KERNELS}, got {kernel!r}")
        self.n_clusters, self.max_iters, self.kernel, self.gamma = n_clusters, max_iters, kernel, gamma

    def fit(self, df: DataFrame) -> KernelModel:
        return fit_kernel_kmeans(df, [self.n_clusters], self.kernel, self.gamma, self.max_iters)[self.n_clusters]

    def fit_predict(self, df: DataFrame) -> DataFrame:
        return self.fit(df).labels
