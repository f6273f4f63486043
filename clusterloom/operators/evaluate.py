"""Clustering scores: contingency, purity, F-measure, adjusted Rand, Davies-Bouldin.

Label-based scores derive from one ``groupBy(label, cluster).count()`` whose partial aggregation
absorbs skew; everything after it works on the (classes x clusters) table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clusterloom.functions import linalg
from clusterloom.operators.blocks import is_sparse, vectors
from clusterloom.operators.selection import row_numbers

_SUITE = "ari double, purity double, davies_bouldin double, f_measure double"
CENTRES_ON_DRIVER = 2000  # up to this many centroids are compared as one small matrix


def contingency(df: DataFrame, label: str = "label", cluster: str = "cluster", keys: tuple = ()) -> DataFrame:
    """(label, cluster, n), optionally per ``keys``."""
    return df.groupBy(*keys, F.col(label).alias("label"), F.col(cluster).alias("cluster")).agg(F.count("*").alias("n"))


def with_totals(table: DataFrame, keys: tuple = ()) -> DataFrame:
    """Add class totals, cluster totals and the grand total to a contingency table."""
    return (
        table.withColumn("n_label", F.sum("n").over(Window.partitionBy(*keys, "label")))
        .withColumn("n_cluster", F.sum("n").over(Window.partitionBy(*keys, "cluster")))
    )


def normalized_confusion(table: DataFrame, dense: bool = True) -> DataFrame:
    """(label, cluster, n, share): row-normalised confusion. ``dense`` has every class with every cluster, absent cells 0.

    Clusters are numbered, and classes with those numbers find the names and the counts by joins, so that no list of clusters is built.
    """
    totals = table.groupBy("label").agg(F.sum("n").alias("total"))
    if not dense:
        rows = totals.withColumnRenamed("label", "_l")
        return table.join(rows, F.col("label").eqNullSafe(F.col("_l"))).select("label", "cluster", "n", (F.col("n") / F.col("total")).alias("share"))
    names = row_numbers(table.select("cluster").distinct(), ["cluster"], "j")
    k = names.count()
    grid = totals.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(k - 1)).cast("array<bigint>"))) if k else totals.withColumn("j", F.lit(0).cast("bigint"))
    cells = table.select(F.col("label").alias("_l"), F.col("cluster").alias("_c"), "n")
    every = grid.join(names, "j").join(cells, F.col("label").eqNullSafe(F.col("_l")) & F.col("cluster").eqNullSafe(F.col("_c")), "left")
    n = F.coalesce("n", F.lit(0))
    return every.select("label", "cluster", n.alias("n"), (n / F.col("total")).alias("share"))


def purity(table: DataFrame, keys: tuple = ()) -> DataFrame:
    """Share of rows in the largest class of their cluster."""
    best = table.groupBy(*keys, "cluster").agg(F.max("n").alias("top"), F.sum("n").alias("size"))
    return best.groupBy(*keys).agg((F.sum("top") / F.sum("size")).alias("purity"))


def f_measure(table: DataFrame, keys: tuple = ()) -> DataFrame:
    """Class-weighted best F1 of each class over the clusters."""
    f1 = with_totals(table, keys).withColumn("f1", F.lit(2.0) * F.col("n") / (F.col("n_label") + F.col("n_cluster")))
    best = f1.groupBy(*keys, "label").agg(F.max("f1").alias("f1"), F.max("n_label").alias("size"))
    return best.groupBy(*keys).agg((F.sum(F.col("f1") * F.col("size")) / F.sum("size")).alias("f_measure"))


def adjusted_rand(table: DataFrame, keys: tuple = ()) -> DataFrame:
    """Adjusted Rand index from pair counts.

    Squared class totals sum to sum(n * n_label) over cells, so one aggregate gives all terms.
    """
    n = F.col("n").cast("double")
    s = with_totals(table, keys).groupBy(*keys).agg(
        F.sum(n).alias("N"), F.sum(n * n).alias("cells"),
        F.sum(n * F.col("n_label")).alias("rows"), F.sum(n * F.col("n_cluster")).alias("cols"),
    )
    return s.select(*keys, _rand())


def _rand():
    """Adjusted Rand from N and the squared sums of cells, rows and cols."""
    both = (F.col("cells") - F.col("N")) / 2
    row = (F.col("rows") - F.col("N")) / 2
    col = (F.col("cols") - F.col("N")) / 2
    pairs = F.col("N") * (F.col("N") - 1) / 2
    chance = F.when(pairs > 0, row * col / pairs).otherwise(F.lit(0.0))
    # identical partitions (also all-in-one or all-apart on both sides) score 1
    same = (both == row) & (both == col)
    return F.when(same, F.lit(1.0)).otherwise((both - chance) / ((row + col) / 2 - chance)).alias("ari")


def label_suite(table: DataFrame, keys: tuple = ()) -> DataFrame:
    """ari, purity and f_measure from one contingency table in one aggregate over its cells."""
    cells = with_totals(table, keys).withColumn("f1", F.lit(2.0) * F.col("n") / (F.col("n_label") + F.col("n_cluster")))
    top = F.row_number().over(Window.partitionBy(*keys, "cluster").orderBy(F.desc("n"))) == 1
    best = F.row_number().over(Window.partitionBy(*keys, "label").orderBy(F.desc("f1"))) == 1
    cells = cells.withColumn("top", top).withColumn("best", best)
    n = F.col("n").cast("double")
    s = cells.groupBy(*keys).agg(
        F.sum(n).alias("N"), F.sum(n * n).alias("cells"), F.sum(n * F.col("n_label")).alias("rows"), F.sum(n * F.col("n_cluster")).alias("cols"),
        F.sum(F.when(F.col("top"), n)).alias("pure"), F.sum(F.when(F.col("best"), F.col("f1") * F.col("n_label"))).alias("f"),
    )
    return s.select(*keys, _rand(), (F.col("pure") / F.col("N")).alias("purity"), (F.col("f") / F.col("N")).alias("f_measure"))


def davies_bouldin(df: DataFrame, features: str = "features", cluster: str = "cluster", centroids: DataFrame | None = None) -> DataFrame:
    """One row: mean over clusters of the worst (spread_i + spread_j) / centroid distance.

    Null when there are fewer than two clusters or as many clusters as rows. ``centroids``
    (cluster, c, n) saves a scan where they are known.
    """
    spark = df.sparkSession
    rows = df.select(F.col(cluster).alias("cluster"), vectors(df, features).alias("f"))
    if centroids is None:
        centroids = _sparse_centroids(rows) if is_sparse(df, features) else rows.groupBy("cluster").agg(
            vector_to_array(Summarizer.mean(array_to_vector(F.col("f")))).alias("c"), F.count("*").alias("n")
        )
    head = centroids.limit(CENTRES_ON_DRIVER + 1).collect()
    if len(head) > CENTRES_ON_DRIVER:
        return _davies_bouldin_wide(rows, centroids)
    n = sum(r["n"] for r in head)
    if not 2 <= len(head) < n:
        return spark.createDataFrame([(None,)], "davies_bouldin double")
    head.sort(key=lambda r: r["cluster"])
    centres = np.array([r["c"] for r in head])
    position = F.create_map(*[v for j, r in enumerate(head) for v in (F.lit(r["cluster"]), F.lit(j))])

    def spreads(batches):
        total = np.zeros(len(centres))
        for b in batches:
            x, j = linalg.rows_of(b.column("f")), b.column("j").to_numpy(zero_copy_only=False)
            if len(j):
                total += np.bincount(j, weights=linalg.own_dists(x, centres, j), minlength=len(total))
        yield pa.RecordBatch.from_pydict({"j": pa.array(range(len(total)), pa.int32()), "s": total})

    sums = rows.select("f", position[F.col("cluster")].alias("j")).mapInArrow(spreads, "j int, s double")
    spread = np.zeros(len(head))
    for r in sums.groupBy("j").agg(F.sum("s").alias("s")).collect():
        spread[r["j"]] = r["s"] / head[r["j"]]["n"]
    return spark.createDataFrame([(davies_bouldin_value(centres, spread),)], "davies_bouldin double")


def _sparse_centroids(rows: DataFrame) -> DataFrame:
    """(cluster, c, n) of rows (cluster, f) with sparse vectors: entries are summed by cluster and position."""
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.max("f.size").alias("d"))
    entries = rows.select("cluster", F.explode(F.arrays_zip("f.positions", "f.values")).alias("e"))
    sums = entries.groupBy("cluster", F.col("e.positions").alias("p")).agg(F.sum("e.values").alias("v"))
    lists = sums.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("p", "v"))).alias("m")).withColumnRenamed("cluster", "_c")
    met = sizes.join(lists, F.col("cluster").eqNullSafe(F.col("_c")), "left")
    mean = F.transform(F.sequence(F.lit(0), F.col("d") - 1), lambda j: F.coalesce(F.element_at("m", j), F.lit(0.0)) / F.col("n"))
    return met.select("cluster", mean.alias("c"), "n")


def davies_bouldin_value(centres: np.ndarray, spread: np.ndarray) -> float:
    gap = np.sqrt(linalg.direct_dists(centres, centres, "euclidean"))
    if not spread.any() or not gap.any():
        return 0.0
    gap[gap == 0] = np.inf
    return float(((spread[:, None] + spread[None, :]) / gap).max(axis=1).mean())


def _davies_bouldin_wide(rows: DataFrame, centroids: DataFrame) -> DataFrame:
    """Many clusters: spreads by join, worst partner by a block-pair pass over the centroids."""
    from clusterloom.operators.pairs import TILE_ROWS, block_pairs

    near = rows.join(centroids, "cluster").select(
        "cluster", "c", F.sqrt(F.aggregate(F.zip_with("f", "c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)).alias("dist")
    )
    table = near.groupBy("cluster").agg(F.avg("dist").alias("s"), F.any_value("c").alias("c"), F.count("*").alias("n"))
    size = table.agg(F.count("*").alias("k"), F.sum("n").alias("n")).first()
    if not 2 <= size["k"] < size["n"]:
        return rows.sparkSession.createDataFrame([(None,)], "davies_bouldin double")

    def worst(left, right, same):
        out = []
        for one, other in ((left, right),) if same else ((left, right), (right, left)):
            ratio = np.zeros(len(one["s"]))
            for a in range(0, len(one["s"]), TILE_ROWS):
                for b in range(0, len(other["s"]), TILE_ROWS):
                    gap = np.sqrt(linalg.direct_dists(one["features"][a : a + TILE_ROWS], other["features"][b : b + TILE_ROWS], "euclidean"))
                    gap[gap == 0] = np.inf
                    tile = (one["s"][a : a + TILE_ROWS, None] + other["s"][None, b : b + TILE_ROWS]) / gap
                    ratio[a : a + TILE_ROWS] = np.maximum(ratio[a : a + TILE_ROWS], tile.max(axis=1))
            out.append(pa.RecordBatch.from_pydict({"id": one["id"], "r": ratio}))
        return out

    id_type = table.schema["cluster"].dataType.simpleString()
    ratios = block_pairs(table.select(F.col("cluster").alias("id"), F.col("c").alias("features"), "s"), worst, f"id {id_type}, r double")
    return ratios.groupBy("id").agg(F.max("r").alias("r")).agg(F.avg("r").alias("davies_bouldin"))


def metric_suite(df: DataFrame, features: str = "features", label: str = "label", cluster: str = "cluster") -> DataFrame:
    """One row with ari, purity, davies_bouldin and f_measure, from two scans.

    The first scan counts (label, cluster) cells and sums their features, which yields the contingency
    table and the centroids; the second measures the spreads.
    """
    if is_sparse(df, features):
        scores = label_suite(contingency(df, label, cluster)).first()
        dbi = davies_bouldin(df, features, cluster).first()[0]
        return df.sparkSession.createDataFrame([(scores["ari"], scores["purity"], dbi, scores["f_measure"])], _SUITE)
    v = array_to_vector(F.col(features).cast("array<double>"))
    cells = df.groupBy(F.col(label).alias("label"), F.col(cluster).alias("cluster")).agg(
        F.count("*").alias("n"), Summarizer.mean(v).alias("m")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    centroids = cells.groupBy("cluster").agg(
        vector_to_array(Summarizer.mean(F.col("m"), F.col("n").cast("double"))).alias("c"), F.sum("n").alias("n")
    )
    scores = label_suite(cells.select("label", "cluster", "n")).first()
    dbi = davies_bouldin(df, features, cluster, centroids).first()[0]
    cells.unpersist()
    return df.sparkSession.createDataFrame([(scores["ari"], scores["purity"], dbi, scores["f_measure"])], _SUITE)


def suite_many(df: DataFrame, models: int, features: str = "features", label: str = "label", clusters: str = "clusters") -> list[dict]:
    """The metric suite of many clusterings at once: ``clusters`` holds one cluster number (from 0) per model.

    All models share the contingency job and two feature scans, whatever their number.
    """
    long = df.select(F.col(label).alias("label"), F.posexplode(clusters).alias("model", "cluster"))
    table = contingency(long, keys=("model",))
    scores = {r["model"]: r.asDict() for r in label_suite(table, ("model",)).collect()}
    widest = {r["model"]: r["k"] for r in table.groupBy("model").agg((F.max("cluster") + 1).alias("k")).collect()}
    at = np.concatenate([[0], np.cumsum([widest.get(m, 0) for m in range(models)])]).astype(int)
    slim = df.select(F.col(features).cast("array<double>").alias("f"), F.col(clusters).alias("c"))

    def totals(fn, width):
        def partial(batches):
            out = np.zeros((at[-1], width))
            for b in batches:
                x, c = linalg.rows_of(b.column("f")), linalg.rows_of(b.column("c"))
                if len(x):
                    for m in range(models):
                        out[at[m] : at[m + 1]] += fn(x, c[:, m], m)
            rows = pa.array(out.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict({"slot": pa.array(range(len(out)), pa.int32()), "v": rows})

        parts = slim.mapInArrow(partial, "slot int, v array<double>")
        summed = parts.groupBy("slot").agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("v")))).alias("v"))
        out = np.zeros((at[-1], width))
        for r in summed.collect():
            out[r["slot"]] = r["v"]
        return out

    d = slim.select(F.size("f").alias("d")).first()["d"]
    sums = totals(lambda x, c, m: linalg.group_sums(x, c, at[m + 1] - at[m]), 1 + d)
    size = sums[:, 0]
    centres = np.divide(sums[:, 1:], size[:, None], out=np.zeros_like(sums[:, 1:]), where=size[:, None] > 0)

    def gaps(x, c, m):
        dist = np.sqrt(((x - centres[at[m] + c]) ** 2).sum(axis=1))
        return np.bincount(c, weights=dist, minlength=at[m + 1] - at[m])[:, None]

    spread = np.divide(totals(gaps, 1)[:, 0], size, out=np.zeros_like(size), where=size > 0)
    out = []
    for m in range(models):
        used = np.nonzero(size[at[m] : at[m + 1]] > 0)[0] + at[m]
        dbi = davies_bouldin_value(centres[used], spread[used]) if 2 <= len(used) < size[used].sum() else None
        s = scores[m]
        out.append({"ari": s["ari"], "purity": s["purity"], "davies_bouldin": dbi, "f_measure": s["f_measure"]})
    return out
