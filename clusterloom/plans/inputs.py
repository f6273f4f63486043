"""The given tables as inputs of the catalogue: feature frames, gapped tables, a results view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterloom.functions import columns as C

LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def embeddings(spark, sf_dir) -> DataFrame:
    t = table(spark, sf_dir, "embeddings")
    return t.select(F.col("vec_id").alias("id"), C.vector("embedding").alias("features"), "label")


def _unit(df: DataFrame, columns) -> list:
    row = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return [(F.col(c) - F.lit(row[f"lo_{c}"])) / F.lit(row[f"hi_{c}"] - row[f"lo_{c}"]) for c in columns]


def lineitem(spark, sf_dir, measures=LINE_MEASURES, *extra) -> DataFrame:
    """(id, features[, extra]): min-max scaled measures; the four keys together identify a line."""
    t = table(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return t.select(key.alias("id"), F.array(*_unit(t, measures)).alias("features"), *extra)


def events(spark, sf_dir) -> DataFrame:
    t = table(spark, sf_dir, "events")
    return t.select(F.col("event_id").alias("id"), F.array(F.col("value") / F.lit(100.0)).alias("features"), "event_type")


def gapped_part(spark, sf_dir) -> DataFrame:
    """part with markers, nulls and a constant column put in by key arithmetic; class = p_type."""
    t = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return t.select(
        k.alias("id"),
        F.when(k % 7 != 0, F.col("p_retailprice")).alias("p_retailprice"),
        F.when(k % 11 == 0, F.lit("?")).when(k % 13 == 0, F.lit("junk")).otherwise(F.col("p_size").cast("string")).alias("p_size"),
        F.lit(5).alias("five"),
        F.when(k % 5 == 0, F.lit(".")).when(k % 17 == 0, F.lit("")).otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(k % 19 != 0, F.col("p_type")).alias("p_type"),
    )


def runs(spark, sf_dir) -> DataFrame:
    """Order lines read as rows of a results table: flags name the dataset, keys the parameters."""
    t = table(spark, sf_dir, "lineitem")
    names = ["KMeans_Standard", "KMeans_FEKM", "Kernel_KMeans", "FCM_Standard", "FCM_Suppressed_0.5", "GaussianMixture", "Agglomerative"]
    algorithm = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("l_linenumber") % 7 + 1).cast("int"))
    k = (F.col("l_partkey") % 9 + 2).cast("int")
    mixture, linked, fuzzy = algorithm == "GaussianMixture", algorithm == "Agglomerative", algorithm.startswith("FCM")
    third = (F.col("l_suppkey") % 3 + 1).cast("int")
    pick = lambda *v: F.element_at(F.array(*[F.lit(x) for x in v]), third)
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return t.select(
        key.alias("run_key"), F.col("l_returnflag").alias("dataset"), algorithm.alias("algorithm"),
        F.when(~mixture, k).alias("n_clusters"), F.when(mixture, k).alias("n_components"),
        F.when(linked, pick("euclidean", "manhattan", "cosine")).alias("metric"),
        F.when(linked, F.element_at(F.array(F.lit("complete"), F.lit("average"), F.lit("single")), (F.col("l_partkey") % 3 + 1).cast("int"))).alias("linkage"),
        F.when(fuzzy, pick(1.5, 2.0, 2.5)).alias("param_m"),
        F.when(fuzzy, F.when(algorithm == "FCM_Standard", 1.0).otherwise(0.5)).alias("param_alpha"),
        F.when(F.col("l_linestatus") == "F", F.lit("PCA_2D")).alias("preprocessing"),
        (F.col("l_quantity") / F.lit(64.0)).alias("purity"),
        F.col("l_extendedprice").alias("inertia"), (F.col("l_extendedprice") * F.lit(2.0)).alias("bic"),
    )
