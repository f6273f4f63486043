import tempfile

import numpy as np
from pyspark.sql import functions as F

from clusterloom.plans import catalogue
from clusterloom.plans import grid as G
from clusterloom.plans import reports as R
from clusterloom.sources import arff, results


def test_grid_counts():
    tasks = G.parameter_grid()
    assert len(tasks) == 1422
    by = {}
    for t in tasks:
        by[t[0], t[1]] = by.get((t[0], t[1]), 0) + 1
    assert by["S1", "Agglomerative"] == 81 and by["S1", "GaussianMixture"] == 270 and by["S2", "KMeans_Standard"] == 180
    assert by["S2", "KMeans_FEKM"] == 18 and by["S2", "Kernel_KMeans"] == 9 and by["S3", "Kernel_KMeans"] == 27


def test_grid_run_takes_the_whole_grid(spark, monkeypatch, tmp_path):
    """Every task of the published grid reaches the run, and rows tell which task they are of."""
    spark.createDataFrame([(k, [float(k + j) for j in range(8)], k % 2) for k in range(12)], "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    ran = {}

    def run_grid(datasets, tasks):
        ran.update({n: (df.count(), [tuple(t[c] for c in G.TASK_COLUMNS) for t in tasks.collect()]) for n, df in datasets.items()})
        return spark.createDataFrame([], G.RESULT_SCHEMA)

    monkeypatch.setattr(catalogue.grids, "run_grid", run_grid)
    out = catalogue.grid_run(spark, str(tmp_path))
    n, tasks = ran["embeddings"]
    assert n == 12 and set(tasks) == set(G.parameter_grid()) and len(tasks) == 1422
    assert {"linkage", "kernel", "param_m", "param_alpha", "run_id"} <= set(out.columns)


def test_grid_leaves_out_pointless_pca(spark):
    sets = spark.createDataFrame([("wide", 10), ("flat", 3)], "dataset string, n_features int")
    g = G.grid(sets, ks=(2,), runs=1)
    assert {r[0] for r in g.where("dataset = 'flat'").select("pca_dim").distinct().collect()} == {None, 2}
    assert {r[0] for r in g.where("dataset = 'wide'").select("pca_dim").distinct().collect()} == {None, 2, 3, 5}


def test_run_and_resume(spark, frame, blobs):
    x, y = blobs
    df = frame(x, label=[int(v) for v in y])
    tasks = G.grid(spark.createDataFrame([("blobs", 3)], "dataset string, n_features int"), ks=(3,), runs=1)
    slim = tasks.where("init_params IS NULL OR init_params = 'kmeans'").where("metric IS NULL OR metric = 'euclidean'").where("param_m IS NULL OR param_m = 2.0")
    seen = []
    out = G.run_grid({"blobs": df}, slim, on_batch=seen.append).cache()
    n = slim.count()
    assert out.count() == n and out.where("error IS NOT NULL").count() == 0 and sum(b.count() for b in seen) == n
    best = out.where("algorithm IN ('KMeans_FEKM', 'Kernel_KMeans', 'GaussianMixture', 'Agglomerative') AND preprocessing = 'Original'")
    assert best.agg(F.min("purity")).first()[0] > 0.99
    assert out.where("algorithm = 'GaussianMixture'").first()["n_components"] == 3
    assert G.pending(slim, out).count() == 0
    assert G.pending(slim, out.where("algorithm <> 'Kernel_KMeans'")).count() == 2


def test_failed_family_leaves_error_rows(spark, frame):
    df = frame([[0.0], [1.0]], label=[0, 1])
    tasks = [dict(zip(G.TASK_COLUMNS, t)) for t in G.parameter_grid((5,), 1) if t[1] == "KMeans_Standard"]
    out = G.run_tasks("tiny", df, tasks).collect()
    assert len(out) == 2 and all(r["error"] and r["purity"] is None for r in out)


def test_reports(spark):
    rows = [("d", "KMeans_Standard", 2, 0.5, 10.0), ("d", "KMeans_Standard", 2, 0.7, 20.0), ("d", "KMeans_Standard", 3, 0.7, 5.0), ("d", None, 3, 0.9, 5.0)]
    t = spark.createDataFrame(rows, "dataset string, algorithm string, n_clusters int, purity double, inertia double").withColumn("key", F.monotonically_increasing_id())
    best = R.best_configurations(t.where("algorithm IS NOT NULL"), ["key"]).collect()
    assert [(r["n_clusters"], r["purity"]) for r in best] == [(2, 0.7)]
    assert {(r["n_clusters"], r["mean_inertia"], r["n"]) for r in R.elbow(t).collect()} == {(2, 15.0, 2), (3, 5.0, 1)}
    assert t.where(R.algorithm_contains("kmeans", True)).count() == 3 and t.where(R.algorithm_contains("kmeans")).count() == 0
    both = R.compile_results([t, t.withColumn("preprocessing", F.lit("PCA_2D")).drop("inertia")])
    assert {(r["preprocessing"], r["runs"]) for r in R.run_counts(both).where("algorithm IS NOT NULL").collect()} == {("Original", 3), ("PCA_2D", 3)}
    assert R.compile_results([t]).select("preprocessing").distinct().collect()[0][0] == "Original"


def test_arff(spark):
    folder = tempfile.mkdtemp(prefix="arff-")
    with open(f"{folder}/a.arff", "w") as f:
        f.write("% note\n@RELATION r\n@attribute 'size' numeric\n@attribute kind {a,b}\n@ATTRIBUTE cls string\n\n@data\n1.5,a,x\n% skipped\n?,b,'y z'\n2,?,x\n")
    t = arff.read_arff(spark, f"{folder}/a.arff")
    assert t.columns == ["id", "size", "kind", "cls"]
    assert [tuple(r)[1:] for r in t.orderBy("id").collect()] == [(1.5, "a", "x"), (None, "b", "y z"), (2.0, "?", "x")]


def test_results_files(spark):
    folder = tempfile.mkdtemp(prefix="results-")
    a = spark.createDataFrame([("d1", "A", 2, 0.5)], "dataset string, algorithm string, n_clusters int, purity double")
    b = spark.createDataFrame([("d2", "G", "10.0", "bad")], "dataset string, algorithm string, n_components string, purity string")
    assert results.write_results(a, f"{folder}/one/run") and results.write_results(b, f"{folder}/two")
    assert not results.write_results(a.where("1 = 0"), f"{folder}/none")
    got = {r["dataset"]: r for r in results.scan_results(spark, [f"{folder}/one", f"{folder}/two", f"{folder}/absent"], "part*").collect()}
    assert got["d1"]["n_clusters"] == 2 and got["d2"]["n_components"] == 10 and got["d2"]["purity"] is None
    assert results.scan_results(spark, [f"{folder}/absent"]) is None
    results.write_results(a.withColumn("run_ts", F.lit(1)), f"{folder}/tab", fmt="parquet")
    results.write_results(a.withColumn("run_ts", F.lit(2)), f"{folder}/tab", fmt="parquet")
    assert results.read_results(spark, f"{folder}/tab", newest_by="run_ts").count() == 1


def test_projected_points(frame, blobs):
    x, y = blobs
    out = R.projected_points(frame(x, label=[int(v) for v in y])).collect()
    assert len(out) == len(x) and {r["cluster_original"] for r in out} == {0, 1, 2}
    assert len({(r["label"], r["cluster_original"]) for r in out}) == 3 and np.isfinite([r["z0"] for r in out]).all()
