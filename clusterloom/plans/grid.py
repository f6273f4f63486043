"""Experiment grids and their execution."""

from __future__ import annotations

import json
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from clusterloom.operators.prep import nan_to_zero
from clusterloom.operators import evaluate
from clusterloom.operators.agglomerative import merge_tree
from clusterloom.operators.blocks import Blocks, vectors
from clusterloom.operators.fekm import fit_fekm
from clusterloom.operators.fuzzy import FuzzySpec, fit_fuzzy
from clusterloom.operators.gmm import MixtureSpec, fit_mixture
from clusterloom.operators.kernel_kmeans import fit_kernel_kmeans
from clusterloom.operators.kmeans import KMeansSpec, assign_all, fit_many
from clusterloom.operators.pca import fit_pca
from clusterloom.sources.results import RESULT_SCHEMA, conform, schema

# fixed values: the published parameter grid
K_VALUES = tuple(range(2, 11))
RUNS = 10
AGG_LINKAGES = ("complete", "average", "single")
AGG_METRICS = ("euclidean", "manhattan", "cosine")
MIXTURE_INITS = ("kmeans", "random", "k-means++")
FUZZIFIERS = (1.5, 2.0, 2.5)
ALPHAS = (1.0, 0.75, 0.5)
PCA_SIZES = (2, 3, 5)

TASK_SCHEMA = schema(
    "session string, algorithm string, n_clusters int, metric string, linkage string, kernel string, init_params string, "
    "param_m double, param_alpha double, reg_covar double, gamma double, run_id int, pca_dim int"
)
TASK_COLUMNS = TASK_SCHEMA.names


def fuzzy_name(alpha: float) -> str:
    return "FCM_Standard" if alpha == 1.0 else f"FCM_Suppressed_{alpha}"


def parameter_grid(ks=K_VALUES, runs: int = RUNS) -> list[tuple]:
    """All parameter combinations for one dataset; deterministic algorithms get one run. ``reg_covar`` and ``gamma`` are null: the defaults."""
    out = []

    def add(session, algorithm, k, metric=None, linkage=None, kernel=None, init=None, m=None, alpha=None, run=None, pca=None):
        out.append((session, algorithm, k, metric, linkage, kernel, init, m, alpha, None, None, run, pca))

    for k in ks:
        for linkage in AGG_LINKAGES:
            for metric in AGG_METRICS:
                add("S1", "Agglomerative", k, metric, linkage)
        for init in MIXTURE_INITS:
            for run in range(runs):
                add("S1", "GaussianMixture", k, init=init, run=run)
        for metric in ("euclidean", "manhattan"):
            for run in range(runs):
                add("S2", "KMeans_Standard", k, metric, run=run)
            add("S2", "KMeans_FEKM", k, metric, run=0)
        add("S2", "Kernel_KMeans", k, kernel="rbf", run=0)
        for m in FUZZIFIERS:
            for alpha in ALPHAS:
                for run in range(runs):
                    add("S2", fuzzy_name(alpha), k, "euclidean", m=m, alpha=alpha, run=run)
        for p in PCA_SIZES:
            add("S3", "KMeans_FEKM", k, "euclidean", run=0, pca=p)
            add("S3", "Kernel_KMeans", k, kernel="rbf", run=0, pca=p)
    return out


def grid(datasets: DataFrame, ks=K_VALUES, runs: int = RUNS) -> DataFrame:
    """One row per task: every dataset row (``dataset``[, ``n_features``]) with every combination.

    PCA tasks that would not reduce the width are left out where it is known.
    """
    tasks = parameter_grid(ks, runs)
    packed = F.from_json(F.lit(json.dumps([dict(zip(TASK_COLUMNS, t)) for t in tasks])), ArrayType(TASK_SCHEMA))
    out = datasets.select("*", F.explode(packed).alias("t")).select(*datasets.columns, "t.*")
    if "n_features" in datasets.columns:
        out = out.where(F.col("pca_dim").isNull() | (F.col("pca_dim") < F.col("n_features")))
    return out


def pending(tasks: DataFrame, results: DataFrame) -> DataFrame:
    """Tasks without a result row yet: what a restarted run still has to do."""
    keys = ["session", "dataset", "algorithm", "n_clusters", "metric", "linkage", "kernel", "init_params", "param_m", "param_alpha", "reg_covar", "gamma", "run_id", "preprocessing"]
    named = tasks.withColumn("preprocessing", preprocessing_name(F.col("pca_dim")))
    t, r = named.alias("t"), results.select(*keys).distinct().alias("r")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return t.join(r, cond, "left_anti").drop("preprocessing")


def preprocessing_name(pca_dim):
    return F.when(pca_dim.isNull(), F.lit("Original")).otherwise(F.concat(F.lit("PCA_"), pca_dim.cast("string"), F.lit("D")))


def run_tasks(name: str, df: DataFrame, tasks: list[dict], on_batch=None) -> DataFrame:
    """Run all tasks of one dataset ``df(id, features, label)``: one result row each.

    Tasks of one family and space are fitted together, so pair passes, merge trees and scans are
    shared; ``runtime`` is the family's time divided by its models. A failing task yields a
    row with ``error`` and null scores. ``on_batch(rows)`` sees each finished family.
    """
    spark = df.sparkSession
    base = df.select("id", F.col("features").cast("array<double>").alias("features"), "label").persist(StorageLevel.MEMORY_AND_DISK)
    blocks = Blocks(base)
    width, pca, out = blocks.d, None, []
    for p in sorted({t.get("pca_dim") for t in tasks}, key=lambda v: v or 0):
        if p is not None and p >= width:
            continue
        if p is None:
            space, packed = base, blocks
        else:
            pca = pca or fit_pca(blocks)
            space = pca.transform(base, p).persist(StorageLevel.MEMORY_AND_DISK)
            packed = Blocks(space)
        mine = [t for t in tasks if t.get("pca_dim") == p]
        for family, fit in FAMILIES.items():
            batch = [t for t in mine if family_of(t["algorithm"]) == family]
            if not batch:
                continue
            rows = _fitted_rows(name, fit, space, packed, batch, p, width)
            out += rows
            if on_batch:
                on_batch(spark.createDataFrame([tuple(r.get(f.name) for f in RESULT_SCHEMA.fields) for r in rows], RESULT_SCHEMA))
        if p is not None:
            packed.unpersist()
            space.unpersist()
    blocks.unpersist()
    base.unpersist()
    return spark.createDataFrame([tuple(r.get(f.name) for f in RESULT_SCHEMA.fields) for r in out], RESULT_SCHEMA)


def _fitted_rows(name, fit, space, packed, batch, p, width) -> list[dict]:
    """Result rows of tasks fitted together. If that fails, each task is fitted alone, so only the faulty ones carry an error."""
    start = time.perf_counter()
    try:
        clustered, order, values = fit(space, packed, batch)
        seconds = (time.perf_counter() - start) / len(batch)
        scores = evaluate.suite_many(clustered, len(order)) if order else []
    except Exception as e:  # a faulty task must not stop the sweep
        if len(batch) == 1:
            return [result_row(name, batch[0], p, width, error=str(e))]
        return [r for t in batch for r in _fitted_rows(name, fit, space, packed, [t], p, width)]
    rows = []
    for i, t in enumerate(batch):
        extra = {"runtime": seconds, "runtime_sec": seconds if t["session"] == "S1" else None, **values[i]}
        rows.append(result_row(name, t, p, width, **extra, **(scores[order.index(i)] if i in order else {})))
    return rows


def family_of(algorithm: str) -> str:
    return "FCM" if algorithm.startswith("FCM") else algorithm


def result_row(name, task, p, width, **values) -> dict:
    row = {k: task.get(k) for k in TASK_COLUMNS if k != "pca_dim"}
    row.update(dataset=name, preprocessing="Original" if p is None else f"PCA_{p}D", n_features_orig=width, n_features_reduced=p)
    if task["algorithm"] == "GaussianMixture":
        row["n_components"] = task["n_clusters"]
    row.update(values)
    return row


# A family returns (frame with an array column of clusters, task numbers in array order, extra values per task).


def _by_models(space, models, values):
    good = [i for i, m in enumerate(models) if not getattr(m, "error", None)]
    if not good:
        return None, [], values
    return space.withColumn("clusters", assign_all(vectors(space), [models[i] for i in good])), good, values


def _agglomerative(space, packed, tasks):
    """One tree per (metric, linkage) and one join per tree."""
    out, parts, order = space, [], []
    for i, key in enumerate(sorted({(t["metric"], t["linkage"]) for t in tasks})):
        mine = [j for j, t in enumerate(tasks) if (t["metric"], t["linkage"]) == key]
        labels = merge_tree(space, *key).labels_many([tasks[j]["n_clusters"] for j in mine])
        out = out.join(labels.withColumnRenamed("clusters", f"t{i}"), "id")
        parts.append(f"t{i}")
        order += mine
    return out.withColumn("clusters", F.concat(*parts)), order, [{}] * len(tasks)


def _mixture(space, packed, tasks):
    space = space.withColumn("features", nan_to_zero(F.col("features")))
    models = fit_mixture(packed, [MixtureSpec(t["n_clusters"], t["init_params"], seed=t["run_id"], reg_covar=1e-4 if t.get("reg_covar") is None else t["reg_covar"]) for t in tasks])
    return _by_models(space, models, [{"error": m.error} if m.error else {"bic": float(m.bic), "avg_log_likelihood": m.avg_log_likelihood} for m in models])


def _kmeans(space, packed, tasks):
    models = fit_many(packed, [KMeansSpec(t["n_clusters"], t["metric"], seed=t["run_id"]) for t in tasks])
    return _by_models(space, models, [{"inertia": m.inertia} for m in models])


def _fekm(space, packed, tasks):
    fits = fit_fekm(packed, sorted({t["n_clusters"] for t in tasks}), sorted({t["metric"] for t in tasks}))
    models = [fits[t["n_clusters"], t["metric"]] for t in tasks]
    return _by_models(space, models, [{"inertia": m.inertia} for m in models])


def _kernel(space, packed, tasks):
    """One fit and one join per kernel and gamma."""
    out, parts, order, values = space, [], [], [{}] * len(tasks)
    for i, (kernel, gamma) in enumerate(sorted({(t["kernel"], t.get("gamma")) for t in tasks}, key=str)):
        mine = [j for j, t in enumerate(tasks) if (t["kernel"], t.get("gamma")) == (kernel, gamma)]
        fits = fit_kernel_kmeans(space, sorted({tasks[j]["n_clusters"] for j in mine}), kernel, gamma=gamma)
        models = [fits[tasks[j]["n_clusters"]] for j in mine]
        labels = models[0].shared.select("id", F.array(*[F.col("labels")[m.slot] for m in models]).alias(f"k{i}"))
        out = out.join(labels, "id")
        parts.append(f"k{i}")
        order += mine
        for j, m in zip(mine, models):
            values[j] = {"inertia": m.inertia}
    return out.withColumn("clusters", F.concat(*parts)), order, values


def _fuzzy(space, packed, tasks):
    models = fit_fuzzy(packed, [FuzzySpec(t["n_clusters"], t["param_m"], t["param_alpha"], seed=t["run_id"]) for t in tasks])
    return _by_models(space, models, [{}] * len(tasks))


FAMILIES = {
    "Agglomerative": _agglomerative, "GaussianMixture": _mixture, "KMeans_Standard": _kmeans,
    "KMeans_FEKM": _fekm, "Kernel_KMeans": _kernel, "FCM": _fuzzy,
}


def run_grid(datasets: dict[str, DataFrame], tasks: DataFrame, on_batch=None) -> DataFrame:
    """Run a grid over named datasets; ``tasks`` is the (small) task table of :func:`grid`."""
    frames = []
    for name, df in datasets.items():
        mine = [r.asDict() for r in tasks.where(F.col("dataset") == name).collect()]
        if mine:
            frames.append(run_tasks(name, df, mine, on_batch))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return conform(out)
