"""K-Means with Euclidean or Manhattan distance.

Many models (any mix of k, metric, seed and start) are fitted together: every iteration is one
scan that serves all models that have not converged, and only centre-sized sums reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.functions import columns as C
from clusterloom.functions import linalg
from clusterloom.operators.blocks import Blocks, vectors

METRICS = ("euclidean", "manhattan")
STAT_NUMBERS = 1 << 22  # sums of at most this many numbers are kept per scan


@dataclass
class KMeansSpec:
    """One model to fit. ``init`` is 'random' (seeded hash order) or a (k, d) array of centres."""

    k: int
    metric: str = "euclidean"
    seed: int = 0
    init: object = "random"
    max_iters: int = 300
    tol: float = 1e-4

    def __post_init__(self):
        if self.metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}, got {self.metric!r}")


@dataclass
class KMeansModel:
    spec: KMeansSpec
    centres: np.ndarray | None = None
    inertia: float | None = None
    iterations: int = 0
    sizes: np.ndarray | None = None
    history: list = field(default_factory=list)

    def transform(self, df: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
        """Add the nearest centre of every row. A projection, so it also runs on streams."""
        if self.centres is None:
            raise ValueError("model is not fitted; call fit first")
        return df.withColumn(cluster, assign(vectors(df, features), self.centres, self.spec.metric))

    def parameters(self) -> tuple[str, tuple]:
        return "nearest", (self.centres, self.spec.metric)

    def centre_table(self, spark) -> DataFrame:
        rows = [(j, [float(v) for v in c]) for j, c in enumerate(self.centres)]
        return spark.createDataFrame(rows, "cluster int, centroid array<double>")


def assign(features, centres: np.ndarray, metric: str = "euclidean"):
    """Column: index of the nearest centre (lowest on ties); ``features`` is an array of doubles or a sparse vector."""

    @F.arrow_udf("int")
    def nearest_index(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.int32())
        return pa.array(linalg.nearest(linalg.rows_of(x), centres, metric)[0], pa.int32())

    return nearest_index(features)


def assign_all(features, models: list):
    """Column: array with the cluster of the row under every model, in one pass over the features."""
    specs = [m.parameters() for m in models]

    @F.arrow_udf("array<int>")
    def clusters(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.list_(pa.int32()))
        rows = linalg.rows_of(x)
        labels = np.stack([linalg.label_rows(rows, *s) for s in specs], axis=1).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(specs)), pa.array(labels.ravel()))

    return clusters(features)


def assign_expression(features, centres: np.ndarray, metric: str = "euclidean"):
    """The same as :func:`assign` from built-in functions only; for narrow data and few centres."""
    dist = C.sq_euclidean if metric == "euclidean" else C.manhattan
    return C.argmin_index(F.array(*[dist(features, C.literal_vector(c)) for c in centres]))


def random_rows(df: DataFrame, k: int, seed, id_col: str = "id", features: str = "features"):
    """The first k rows in seeded hash order: [(id, features)]. A bounded top-k, not a sort."""
    picked = (
        df.select(F.col(id_col).alias("id"), F.col(features).alias("f"), C.hash_order(id_col, seed).alias("h"))
        .orderBy("h", "id").limit(k).collect()
    )
    if len(picked) < k:
        raise ValueError(f"{k} clusters asked from {len(picked)} rows")
    return [(r["id"], linalg.vector(r["f"])) for r in picked]


class KMeans:
    """Single-model front: ``KMeans(k).fit(df)`` or ``fit_predict(df)``."""

    def __init__(self, n_clusters: int, max_iters: int = 300, tol: float = 1e-4, metric: str = "euclidean", random_state=0, init="random"):
        self.spec = KMeansSpec(n_clusters, metric, random_state or 0, init, max_iters, tol)

    def fit(self, data: DataFrame | Blocks) -> KMeansModel:
        return fit_many(data, [self.spec])[0]

    def fit_predict(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def fit_many(data: DataFrame | Blocks, specs: list[KMeansSpec]) -> list[KMeansModel]:
    """Fit every spec; all running models share one scan per iteration."""
    blocks = data if isinstance(data, Blocks) else Blocks(data)
    own = blocks is not data
    try:
        models = [KMeansModel(s) for s in specs]
        starts = {}
        for seed in {s.seed for s in specs if isinstance(s.init, str)}:
            k_max = max(s.k for s in specs if s.seed == seed and isinstance(s.init, str))
            starts[seed] = np.array([f for _, f in random_rows(blocks.rows, k_max, seed)])
        for m in models:
            m.centres = starts[m.spec.seed][: m.spec.k].copy() if isinstance(m.spec.init, str) else np.array(m.spec.init, float)
        for chunk in _chunks(models, blocks.d):
            _lloyd(blocks, chunk)
        return models
    finally:
        if own:
            blocks.unpersist()


def _chunks(models, d):
    """Groups of models whose sums stay within the per-scan size."""
    group, numbers = [], 0
    for m in models:
        need = m.spec.k * (d + 2)
        if group and numbers + need > STAT_NUMBERS:
            yield group
            group, numbers = [], 0
        group.append(m)
        numbers += need
    if group:
        yield group


def step_sums(blocks: Blocks, centres: list[np.ndarray], metrics: list[str]) -> list[np.ndarray]:
    """One scan: per model a (k, 2 + d) table of count, feature sums and distance sum."""
    d = blocks.d
    size = sum(len(c) * (d + 2) for c in centres)

    def stats(x):
        out, at = np.empty(size), 0
        for c, metric in zip(centres, metrics):
            label, dist = linalg.nearest(x, c, metric)
            t = out[at : at + len(c) * (d + 2)].reshape(len(c), d + 2)
            linalg.group_sums(x, label, len(c), out=t[:, :-1])
            t[:, -1] = np.bincount(label, weights=dist, minlength=len(c))
            at += t.size
        return out

    flat = blocks.sums(stats, size)
    tables, at = [], 0
    for c in centres:
        size = len(c) * (d + 2)
        tables.append(flat[at : at + size].reshape(len(c), d + 2))
        at += size
    return tables


def _lloyd(blocks: Blocks, models: list[KMeansModel]) -> None:
    running = [m for m in models if m.spec.max_iters > 0]
    settled = [m for m in models if m.spec.max_iters <= 0]
    while running or settled:
        active = running + settled
        tables = step_sums(blocks, [m.centres for m in active], [m.spec.metric for m in active])
        for m, t in zip(active, tables):
            m.history.append(float(t[:, -1].sum()))
            if m in settled:
                m.inertia, m.sizes = float(t[:, -1].sum()), t[:, 0].copy()
        done, settled, still = settled, [], []
        for m, t in zip(running, tables):
            fresh = m.centres.copy()
            filled = t[:, 0] > 0
            fresh[filled] = t[filled, 1:-1] / t[filled, :1]
            for j in np.nonzero(~filled)[0]:
                # an emptied cluster restarts from a seeded row
                fresh[j] = random_rows(blocks.rows, 1, f"{m.spec.seed}:{m.iterations}:{j}")[0][1]
            moved = float(((fresh - m.centres) ** 2).sum())
            m.centres, m.iterations = fresh, m.iterations + 1
            (settled if moved < m.spec.tol or m.iterations >= m.spec.max_iters else still).append(m)
        running = still
        del done
