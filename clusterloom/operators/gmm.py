"""Gaussian mixtures with full covariances, fitted by EM.

A scan evaluates the posteriors in log space and returns the sufficient statistics
(weight, mean and scatter sums per component); parameters are component-sized and live on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.functions import columns as C
from clusterloom.functions import linalg
from clusterloom.operators.blocks import Blocks
from clusterloom.operators.kmeans import KMeansSpec, fit_many
from clusterloom.operators.prep import nan_to_zero

INITS = ("kmeans", "random", "k-means++")
STAT_NUMBERS = 1 << 23
NARROW = 16
EPS = 10 * np.finfo(float).eps  # fixed value: added to every component weight


@dataclass
class MixtureSpec:
    k: int
    init_params: str = "kmeans"
    seed: int = 42
    reg_covar: float = 1e-4
    max_iters: int = 100
    tol: float = 1e-3

    def __post_init__(self):
        if self.init_params not in INITS:
            raise ValueError(f"init_params must be one of {INITS}")


@dataclass
class MixtureModel:
    spec: MixtureSpec
    n: int
    weights: np.ndarray | None = None
    means: np.ndarray | None = None
    covariances: np.ndarray | None = None
    avg_log_likelihood: float = -np.inf
    iterations: int = 0
    converged: bool = False
    error: str | None = None

    @property
    def n_parameters(self) -> int:
        k, d = self.means.shape
        return k * d * (d + 1) // 2 + k * d + k - 1

    @property
    def bic(self) -> float:
        """Of the final parameters over the fitted rows."""
        return -2.0 * self.avg_log_likelihood * self.n + self.n_parameters * np.log(self.n)

    def log_density(self, x: np.ndarray) -> np.ndarray:
        return linalg.log_joint(x, *self._solved())

    def parameters(self) -> tuple[str, tuple]:
        return "gaussian", self._solved()

    def _solved(self):
        return np.log(self.weights), self.means, factors(self.covariances)

    def transform(self, df: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
        """Add the component with the largest posterior."""
        if self.means is None:
            raise ValueError("model is not fitted; call fit first")
        parts = self._solved()

        @F.arrow_udf("int")
        def component(x: pa.Array) -> pa.Array:
            return pa.array(linalg.log_joint(linalg.rows_of(x), *parts).argmax(axis=1) if len(x) else [], pa.int32())

        return df.withColumn(cluster, component(F.col(features).cast("array<double>")))


def factors(cov: np.ndarray) -> list[np.ndarray]:
    """Per component the inverse Cholesky factor, transposed."""
    eye = np.eye(cov.shape[1])
    return [np.linalg.solve(np.linalg.cholesky(c), eye).T for c in cov]


def log_total(joint: np.ndarray) -> np.ndarray:
    top = joint.max(axis=1, keepdims=True)
    rest = joint - top
    return (top + np.log(np.exp(rest, out=rest).sum(axis=1, keepdims=True)))[:, 0]


def _moments(x, r, shift):
    """Flat (k, 1 + d + d*d) weight, mean and scatter sums of shifted rows."""
    c = x - shift
    k, d = r.shape[1], x.shape[1]
    out = np.empty((k, 1 + d + d * d))
    out[:, 0] = r.sum(axis=0)
    out[:, 1 : 1 + d] = r.T @ c
    if d <= NARROW:
        # all components in one product with the row-wise outer products
        by_feature = np.ascontiguousarray(c.T)
        out[:, 1 + d :] = r.T @ (by_feature[:, None, :] * by_feature[None, :, :]).reshape(d * d, len(c)).T
    else:
        for j in range(k):
            out[j, 1 + d :] = ((c * r[:, j : j + 1]).T @ c).ravel()
    return out.ravel()


def _maximise(m: MixtureModel, flat: np.ndarray, shift: np.ndarray) -> None:
    d = len(shift)
    s = flat.reshape(m.spec.k, 1 + d + d * d)
    nk = s[:, 0] + EPS
    mu = s[:, 1 : 1 + d] / nk[:, None]
    cov = s[:, 1 + d :].reshape(-1, d, d) / nk[:, None, None] - mu[:, :, None] * mu[:, None, :]
    cov[:, range(d), range(d)] += m.spec.reg_covar
    m.weights, m.means, m.covariances = nk / nk.sum(), mu + shift, cov


def spread_rows(blocks: Blocks, sizes: dict) -> dict[object, np.ndarray]:
    """For each seed as many rows as ``sizes`` says, drawn one after another with probability proportional to the squared distance to the chosen ones.

    Weighted draws use exponential keys: the smallest -log(u) / weight wins, u seeded per row. One scan a step serves all seeds, and a prefix of
    a seed's rows is what fewer rows would have been.
    """
    first = blocks.rows.agg(*[F.min_by("features", F.struct(C.hash_order("id", s), "id")).alias(f"f{i}") for i, s in enumerate(sizes)]).first()
    chosen = {s: [linalg.vector(first[f"f{i}"])] for i, s in enumerate(sizes)}
    while active := [s for s, k in sizes.items() if len(chosen[s]) < k]:
        centres = [np.array(chosen[s]) for s in active]
        keyed = blocks.rows.select("id", "features", F.array(*[C.hash_uniform("id", len(chosen[s]), s) for s in active]).alias("u"))

        def race(batches):
            for b in batches:
                x, u = linalg.rows_of(b.column("features")), linalg.rows_of(b.column("u"))
                if not len(x):
                    continue
                ids, out = b.column("id"), []
                for i, c in enumerate(centres):
                    w = linalg.direct_dists(x, c, "euclidean").min(axis=1)
                    with np.errstate(divide="ignore"):
                        cost = np.where(w > 0, -np.log(np.maximum(u[:, i], 2.0**-49)) / w, np.inf)
                    tied = np.flatnonzero(cost == cost.min())
                    names = ids.take(pa.array(tied)).to_pylist()
                    j = min(range(len(tied)), key=names.__getitem__)
                    out.append((i, float(cost.min()), names[j], x[int(tied[j])].tolist()))
                types = (pa.int32(), pa.float64(), ids.type, pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(v, ty) for v, ty in zip(zip(*out), types)], names=["slot", "cost", "id", "features"])

        ddl = f"slot int, cost double, id {blocks.id_type}, features array<double>"
        won = keyed.mapInArrow(race, ddl).groupBy("slot").agg(F.min_by("features", F.struct("cost", "id")).alias("f"))
        for r in won.collect():
            chosen[active[r["slot"]]].append(np.array(r["f"]))
    return {s: np.array(rows) for s, rows in chosen.items()}


def _random_starts(blocks: Blocks, specs: list[MixtureSpec], shift) -> list[np.ndarray]:
    """Moments under seeded random responsibilities, all specs in one scan."""
    most: dict = {}
    for s in specs:
        most[s.seed] = max(most.get(s.seed, 0), s.k)
    at, end = {}, 0
    for seed, k in most.items():
        at[seed], end = end, end + k
    hashed = blocks.rows.select("features", F.array(*[C.hash_uniform("id", j, seed) for seed, k in most.items() for j in range(k)]).alias("u"))
    spans = [(at[s.seed], s.k) for s in specs]
    width = 1 + blocks.d + blocks.d**2
    size = sum(k for _, k in spans)

    def emit(batches):
        total = np.zeros(size * width)
        for b in batches:
            x, u = linalg.rows_of(b.column("features")), linalg.rows_of(b.column("u"))
            if len(x):
                total += np.concatenate([_moments(x, u[:, a : a + k] / u[:, a : a + k].sum(axis=1, keepdims=True), shift) for a, k in spans])
        yield pa.RecordBatch.from_pydict({"slot": pa.array(range(size), pa.int32()), "v": pa.array(total.reshape(size, width).tolist(), pa.list_(pa.float64()))})

    out = np.zeros((size, width))
    parts = hashed.mapInArrow(emit, "slot int, v array<double>")
    for r in parts.select("slot", F.posexplode("v").alias("p", "v")).groupBy("slot", "p").agg(F.sum("v").alias("v")).collect():
        out[r["slot"], r["p"]] = r["v"]
    cuts = np.cumsum([0] + [k for _, k in spans])
    return [out[a:b].ravel() for a, b in zip(cuts[:-1], cuts[1:])]


def fit_mixture(data: DataFrame | Blocks, specs: list[MixtureSpec]) -> list[MixtureModel]:
    """Fit every spec. A spec whose covariance degenerates, or that asks more components than there are rows, ends with ``error`` set;
    the others go on."""
    blocks = data if isinstance(data, Blocks) else Blocks(data)
    shift = blocks.sums(lambda x: x.sum(axis=0), blocks.d) / blocks.n
    if not np.isfinite(shift).all():  # missing values count as 0
        blocks = Blocks(blocks.rows.withColumn("features", nan_to_zero(F.col("features"))))
        shift = blocks.sums(lambda x: x.sum(axis=0), blocks.d) / blocks.n
    models = [MixtureModel(s, blocks.n) for s in specs]
    for m in models:
        if m.spec.k > blocks.n:
            m.error = f"{m.spec.k} components asked from {blocks.n} rows"
    _start(blocks, [m for m in models if m.error is None], shift)
    for group in _in_chunks([m for m in models if m.error is None], blocks.d):
        _em(blocks, group, shift)
    return models


def _start(blocks: Blocks, models: list[MixtureModel], shift) -> None:
    """First moments of all models; the number of scans does not grow with the number of models."""
    by = {kind: [m for m in models if m.spec.init_params == kind] for kind in INITS}
    for chunk in _in_chunks(by["kmeans"], blocks.d):
        centres = [f.centres for f in fit_many(blocks, [KMeansSpec(m.spec.k, seed=m.spec.seed) for m in chunk])]

        def hard(x):
            parts = []
            for c in centres:
                r = np.zeros((len(x), len(c)))
                r[np.arange(len(x)), linalg.nearest(x, c, "euclidean")[0]] = 1.0
                parts.append(_moments(x, r, shift))
            return np.concatenate(parts)

        width = 1 + blocks.d + blocks.d**2
        flat, at = blocks.sums(hard, sum(m.spec.k for m in chunk) * width), 0
        for m in chunk:
            _maximise(m, flat[at : at + m.spec.k * width], shift)
            at += m.spec.k * width
    for chunk in _in_chunks(by["random"], blocks.d):
        for m, flat in zip(chunk, _random_starts(blocks, [m.spec for m in chunk], shift)):
            _maximise(m, flat, shift)
    if by["k-means++"]:
        most: dict = {}
        for m in by["k-means++"]:
            most[m.spec.seed] = max(most.get(m.spec.seed, 0), m.spec.k)
        drawn = spread_rows(blocks, most)
        for m in by["k-means++"]:
            # each drawn row alone is the member of its component
            _maximise(m, _moments(drawn[m.spec.seed][: m.spec.k], np.eye(m.spec.k), shift), shift)


def _in_chunks(models: list[MixtureModel], d: int):
    """Groups of models whose moments stay within STAT_NUMBERS."""
    width, group, numbers = 1 + d + d**2, [], 0
    for m in models:
        if group and numbers + m.spec.k * width > STAT_NUMBERS:
            yield group
            group, numbers = [], 0
        group.append(m)
        numbers += m.spec.k * width
    if group:
        yield group


def _em(blocks: Blocks, models: list[MixtureModel], shift) -> None:
    width = 1 + blocks.d + blocks.d**2
    running, final = list(models), []
    while running or final:
        jobs, active = [], []
        for m in running + final:
            try:
                jobs.append(m._solved())
                active.append(m)
            except np.linalg.LinAlgError as e:
                m.error = str(e)
        running, last = [m for m in running if m.error is None], [m for m in final if m.error is None]
        if not active:
            return

        def stats(x):
            parts, score = [], []
            for job in jobs:
                joint = linalg.log_joint(x, *job)
                total = log_total(joint)
                parts.append(np.exp(joint - total[:, None]))
                score.append(total.sum())
            return np.concatenate([_moments(x, np.hstack(parts), shift), score])

        flat = blocks.sums(stats, sum(m.spec.k * width + 1 for m in active))
        at, still, final = 0, [], []
        for m, score in zip(active, flat[-len(active) :] / blocks.n):
            size = m.spec.k * width
            part = flat[at : at + size]
            at += size
            gain, m.avg_log_likelihood = score - m.avg_log_likelihood, float(score)
            if m in last:
                continue  # likelihood of the final parameters
            _maximise(m, part, shift)
            m.iterations += 1
            m.converged = abs(gain) < m.spec.tol
            (final if m.converged or m.iterations >= m.spec.max_iters else still).append(m)
        running = still
