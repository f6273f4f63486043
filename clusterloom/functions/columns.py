"""Row-level expressions: vector distances, kernels and seeded hashing.

Everything here is a ``Column`` built from Spark functions, so it runs in the JVM and works
in any projection, filter or aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_MARKERS = ("?", ".", "")  # fixed values: whole-value markers read as missing


def vector(col: Column | str) -> Column:
    """Cast an array column to ARRAY<DOUBLE>."""
    return (F.col(col) if isinstance(col, str) else col).cast("array<double>")


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def sq_euclidean(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(sq_euclidean(a, b))


def manhattan(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def dot(a: Column, b: Column) -> Column:
    """Inner product, which is also the linear kernel."""
    return _total(F.zip_with(a, b, lambda x, y: x * y))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def rbf_kernel(a: Column, b: Column, gamma: float | None = None) -> Column:
    """exp(-gamma * squared distance); gamma defaults to one over the width."""
    g = F.lit(1.0) / F.size(a) if gamma is None else F.lit(float(gamma))
    sq = F.greatest(F.lit(0.0), dot(a, a) + dot(b, b) - F.lit(2.0) * dot(a, b))
    return F.exp(-g * sq)


def kernel_distance(kxx: Column, kzz: Column, kxz: Column) -> Column:
    """Squared distance of two points in feature space."""
    return kxx + kzz - F.lit(2.0) * kxz


def hash_order(id_col: Column | str, seed) -> Column:
    """Seeded pseudo-random sort key; ordering by (this, id) shuffles rows reproducibly."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


def hash_uniform(id_col: Column | str, slot, seed) -> Column:
    """Seeded uniform in [0, 1) for a (row, slot): first 48 bits of an md5."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(c.cast("string"), F.lit(f":{slot}:{seed}")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def argmax_index(arr: Column) -> Column:
    """Zero-based index of the first maximum."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def argmin_index(arr: Column) -> Column:
    """Zero-based index of the first minimum."""
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")
