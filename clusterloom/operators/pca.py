"""Principal components from one scatter-matrix pass; projection and reconstruction stay per row."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.functions import linalg
from clusterloom.operators.blocks import Blocks


@dataclass
class PCAModel:
    """All eigenpairs are kept, so one fit serves every number of components."""

    mean: np.ndarray
    covariance: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray  # (d, d), one column per component, descending eigenvalue

    def loadings(self, p: int) -> np.ndarray:
        return self.components[:, :p]

    def explained_variance_ratio(self, p: int) -> np.ndarray:
        total = self.eigenvalues.sum()
        return self.eigenvalues[:p] / total if total > 0 else np.zeros(p)

    def transform(self, df: DataFrame, p: int, features: str = "features", out: str = "features") -> DataFrame:
        w, mu = self.loadings(p), self.mean

        @F.arrow_udf("array<double>")
        def project(x: pa.Array) -> pa.Array:
            return _lists((linalg.rows_of(x) - mu) @ w) if len(x) else pa.array([], pa.list_(pa.float64()))

        return df.withColumn(out, project(F.col(features).cast("array<double>")))

    def inverse_transform(self, df: DataFrame, p: int, features: str = "features", out: str = "features") -> DataFrame:
        w, mu = self.loadings(p), self.mean

        @F.arrow_udf("array<double>")
        def restore(z: pa.Array) -> pa.Array:
            return _lists(linalg.rows_of(z) @ w.T + mu) if len(z) else pa.array([], pa.list_(pa.float64()))

        return df.withColumn(out, restore(F.col(features).cast("array<double>")))

    def component_table(self, spark, p: int) -> DataFrame:
        rows = [(c, f, float(self.components[f, c])) for c in range(p) for f in range(len(self.mean))]
        return spark.createDataFrame(rows, "component int, feature int, loading double")


def _lists(m: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(m).ravel()))


def mean_covariance(data: DataFrame | Blocks) -> tuple[np.ndarray, np.ndarray]:
    """Mean vector and sample covariance (divisor N - 1), centred before squaring."""
    blocks = data if isinstance(data, Blocks) else Blocks(data)
    mean = blocks.sums(lambda x: x.sum(axis=0), blocks.d) / blocks.n

    def scatter(x):
        c = x - mean
        return (c.T @ c).ravel()

    return mean, blocks.sums(scatter, blocks.d**2).reshape(blocks.d, blocks.d) / (blocks.n - 1)


def fit_pca(data: DataFrame | Blocks) -> PCAModel:
    """Eigenvectors are signed so that the largest loading is positive."""
    mean, cov = mean_covariance(data)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1]
    values, vectors = values[order], vectors[:, order]
    lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
    return PCAModel(mean, cov, values, vectors * np.where(lead < 0, -1.0, 1.0))


def reconstruction(df: DataFrame, model: PCAModel, p: int) -> DataFrame:
    """(id, x0, x1, r0, r1): first two features of each row before and after a p-component round trip."""
    both = model.inverse_transform(model.transform(df, p, out="_z"), p, features="_z", out="_r")
    pick = [F.col("features")[i].cast("double").alias(f"x{i}") for i in range(2)] + [F.col("_r")[i].alias(f"r{i}") for i in range(2)]
    return both.select("id", *pick)


def reconstruction_error(data: DataFrame | Blocks, model: PCAModel, p: int) -> np.ndarray:
    """Mean squared reconstruction error per feature."""
    blocks = data if isinstance(data, Blocks) else Blocks(data)
    w, mu = model.loadings(p), model.mean

    def err(x):
        c = x - mu
        return ((c - (c @ w) @ w.T) ** 2).sum(axis=0)

    return blocks.sums(err, blocks.d) / blocks.n
