"""Comparison tables over a results table: plain grouped plans that Catalyst prunes and pushes down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterloom.sources.results import unite

# fixed values: columns of the comparison table, the first four always present
TABLE_COLUMNS = (
    "dataset", "algorithm", "n_clusters", "purity", "ari", "davies_bouldin", "f_measure", "runtime",
    "metric", "linkage", "param_m", "param_alpha", "preprocessing",
)


def compile_results(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; rows without ``preprocessing`` are 'Original'."""
    out = unite(frames)
    if "preprocessing" not in out.columns:
        return out.withColumn("preprocessing", F.lit("Original"))
    return out.withColumn("preprocessing", F.coalesce("preprocessing", F.lit("Original")))


def to_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast the named columns that exist to double; unreadable values become null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if c in df.columns})


def algorithm_contains(text: str, ignore_case: bool = False) -> Column:
    a = F.coalesce(F.col("algorithm"), F.lit(""))
    return F.lower(a).contains(text.lower()) if ignore_case else a.contains(text)


def k_of(df: DataFrame) -> Column:
    """Cluster number of a row whatever its algorithm calls it."""
    have = [F.col(c) for c in ("n_clusters", "n_components") if c in df.columns]
    return F.coalesce(*have)


def run_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("dataset", "algorithm", "preprocessing").agg(F.count("*").alias("runs"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def best_configurations(df: DataFrame, row_key: list[str]) -> DataFrame:
    """The row with the highest purity per (dataset, algorithm), first by ``row_key`` on ties.

    A grouped extremum with partial aggregation, so a dominant algorithm is no hot window.
    """
    cols = [c for c in TABLE_COLUMNS if c in df.columns]
    scored = df.where(F.col("purity").isNotNull())
    order = F.struct(-F.col("purity"), *row_key)
    return scored.groupBy("dataset", "algorithm").agg(F.min_by(F.struct(*[c for c in cols if c not in ("dataset", "algorithm")]), order).alias("r")).select("dataset", "algorithm", "r.*").select(*cols)


def sorted_table(best: DataFrame) -> DataFrame:
    return best.orderBy(F.asc("dataset"), F.desc("purity"))


def curve(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, standard deviation and count of ``value`` per key."""
    v = F.col(value)
    return df.groupBy(*keys).agg(F.avg(v).alias(f"mean_{value}"), F.stddev_samp(v).alias(f"std_{value}"), F.count(v).alias("n"))


def elbow(df: DataFrame) -> DataFrame:
    return curve(df.where(F.col("algorithm") == "KMeans_Standard"), ["dataset", "n_clusters"], "inertia")


def bic_curve(df: DataFrame) -> DataFrame:
    gmm = df.where(F.col("algorithm") == "GaussianMixture")
    return curve(gmm.withColumn("k", k_of(df)), ["dataset", "k"], "bic")


def linkage_effect(df: DataFrame) -> DataFrame:
    return curve(df.where(F.col("algorithm") == "Agglomerative"), ["dataset", "linkage"], "purity")


def metric_effect(df: DataFrame) -> DataFrame:
    return curve(df.where(F.col("algorithm") == "Agglomerative"), ["dataset", "metric"], "purity")


def alpha_effect(df: DataFrame) -> DataFrame:
    return curve(df.where(algorithm_contains("FCM")), ["dataset", "n_clusters", "param_alpha"], "purity")


def fuzzifier_effect(df: DataFrame) -> DataFrame:
    return curve(df.where(algorithm_contains("FCM")), ["dataset", "param_m", "param_alpha"], "purity")


def projected_points(df: DataFrame, k: int | None = None) -> DataFrame:
    """(id, z0, z1, label, cluster_original, cluster_reduced): 2-D projection with two clusterings.

    k defaults to the number of classes.
    """
    from clusterloom.operators.blocks import Blocks
    from clusterloom.operators.fekm import fit_fekm
    from clusterloom.operators.pca import fit_pca

    k = k or df.select(F.count_distinct("label")).first()[0]
    blocks = Blocks(df)
    pca = fit_pca(blocks)
    flat = pca.transform(df, 2, out="z")
    low = Blocks(flat.select("id", F.col("z").alias("features")))
    full = fit_fekm(blocks, [k])[k, "euclidean"]
    reduced = fit_fekm(low, [k])[k, "euclidean"]
    blocks.unpersist()
    low.unpersist()
    both = reduced.transform(full.transform(flat, cluster="cluster_original"), features="z", cluster="cluster_reduced")
    return both.select("id", F.col("z")[0].alias("z0"), F.col("z")[1].alias("z1"), "label", "cluster_original", "cluster_reduced")

