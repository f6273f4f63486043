"""Inputs beyond former limits, and faults that must stay with the rows or tasks that have them."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from clusterloom.functions import linalg
from clusterloom.operators import evaluate, fekm, fuzzy, gmm, kernel_kmeans, matching, pairs
from clusterloom.operators.blocks import Blocks
from clusterloom.operators.gmm import MixtureSpec, fit_mixture
from clusterloom.plans import grid
from clusterloom.sources import arff, results


def test_vectors_of_different_lengths_are_refused():
    with pytest.raises(ValueError, match="different lengths"):
        linalg.rows_of(pa.array([[1.0, 2.0, 3.0], [4.0]]))
    with pytest.raises(ValueError, match="null"):
        linalg.rows_of(pa.array([[1.0, 2.0], None]))


def test_assignment_against_all_permutations():
    rnd = random.Random(2)
    for _ in range(200):
        n, m = rnd.randint(1, 4), rnd.randint(4, 5)
        gain = [[rnd.randint(0, 6) for _ in range(m)] for _ in range(n)]
        pick = matching.first_best(np.array(gain))
        assert len(set(pick)) == n
        assert sum(gain[i][c] for i, c in enumerate(pick)) == max(sum(gain[i][c] for i, c in enumerate(p)) for p in itertools.permutations(range(m), n))


def test_more_than_sixteen_classes(spark):
    table = spark.createDataFrame([(k, (k + 3) % 20, 5) for k in range(20)] + [(k, k, 1) for k in range(20)], "label int, cluster int, n bigint")
    assert {r.cluster: r.matched for r in matching.match_clusters(table).collect()} == {(k + 3) % 20: k for k in range(20)}


def test_kernels_are_fitted_apart_and_faults_stay_alone(spark, frame):
    x = np.random.default_rng(1).normal(size=(30, 2))
    df = frame(x, label=["a" if v > 0 else "b" for v in x[:, 0]])
    task = dict.fromkeys(grid.TASK_COLUMNS) | {"session": "S2", "dataset": "d", "algorithm": "Kernel_KMeans", "n_clusters": 2, "run_id": 0}
    rows = grid.run_tasks("d", df, [task | {"kernel": "rbf"}, task | {"kernel": "linear"}]).collect()
    inertia = {r.kernel: r.inertia for r in rows}
    alone = {k: grid.run_tasks("d", df, [task | {"kernel": k}]).first().inertia for k in ("rbf", "linear")}
    assert inertia == pytest.approx(alone) and inertia["rbf"] != pytest.approx(inertia["linear"])
    km = task | {"algorithm": "KMeans_Standard", "metric": "euclidean"}
    got = {r.n_clusters: r for r in grid.run_tasks("d", frame(x[:3], label=["a", "b", "a"]), [km, km | {"n_clusters": 4}]).collect()}
    assert got[2].inertia is not None and got[2].error is None


def test_mixture_starts_share_their_scans(spark, frame):
    """As many jobs for many seeds as for one, and each model starts as it does alone."""
    x = np.random.default_rng(7).normal(size=(60, 2))
    blocks, shift = Blocks(frame(x)), x.mean(axis=0)
    made = []

    def started(specs, name):
        spark.sparkContext.setJobGroup(name, name)
        models = [gmm.MixtureModel(s, 60) for s in specs]
        gmm._start(blocks, models, shift)
        made.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
        return models

    specs = [MixtureSpec(k, kind, seed=s) for kind in ("random", "k-means++") for s in range(4) for k in (2, 3)]
    many = started(specs, "many")
    started([specs[1], specs[-1]], "few")
    assert made[0] == made[1]
    for i in (0, 5, 9, 14):
        one = started([specs[i]], f"one{i}")[0]
        assert np.allclose(one.means, many[i].means) and np.allclose(one.weights, many[i].weights)


def test_mixture_over_missing_values(frame):
    x = np.random.default_rng(4).normal(size=(40, 2))
    y = x.copy()
    x[3, 1] = np.nan
    y[3, 1] = 0.0
    a, b = (fit_mixture(frame(v), [MixtureSpec(2, "random", seed=1)])[0] for v in (x, y))
    assert np.isfinite(a.bic) and a.bic == pytest.approx(b.bic)


def test_davies_bouldin_forms_agree(frame, monkeypatch):
    df = frame([[0.0], [1.0], [5.0]], cluster=[0, 1, 2])
    narrow = evaluate.davies_bouldin(df).first()[0]
    monkeypatch.setattr(evaluate, "CENTRES_ON_DRIVER", 1)
    assert narrow is None and evaluate.davies_bouldin(df).first()[0] is None


def test_arff_rows_that_begin_with_at(spark, tmp_path):
    (tmp_path / "t.arff").write_text("@relation t\n@attribute name string\n@attribute n numeric\n@data\n@home,1\nb,2\n")
    assert sorted((r.name, r.n) for r in arff.read_arff(spark, str(tmp_path / "t.arff")).collect()) == [("@home", 1.0), ("b", 2.0)]


def test_arff_data_lines_declare_nothing(spark, tmp_path):
    (tmp_path / "b.arff").write_text("@relation t\n@data\n1,2\n")
    (tmp_path / "a.arff").write_text("% note\n@RELATION t\n@ATTRIBUTE 'my name' {a, b}\n@attribute n REAL\n\n@DATA\na,1\n@attribute x numeric\n")
    assert arff.read_attributes(spark, str(tmp_path)) == [("my name", "string"), ("n", "double")]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "c.arff").write_text("1,2\n")
    assert arff.read_attributes(spark, str(tmp_path / "none")) == []


def test_linear_kernel_needs_no_pairs(frame, monkeypatch):
    """Labels and inertia by feature sums are those of all kernel values, and no block of rows meets another."""
    x = np.random.default_rng(3).normal(size=(60, 3))
    monkeypatch.setattr(kernel_kmeans, "block_pairs", None)
    model = kernel_kmeans.fit_kernel_kmeans(frame(x), [2, 4], "linear", broadcast_bytes=0)[4]
    label = {r.id: r.cluster for r in model.labels.collect()}
    lab = np.array([label[k] for k in range(60)])
    gram = x @ x.T
    cost = np.stack([np.diag(gram) - 2 * gram[:, lab == c].mean(axis=1) + gram[np.ix_(lab == c, lab == c)].mean() for c in range(4)], axis=1)
    assert np.array_equal(cost.argmin(axis=1), lab) and np.isclose(cost.min(axis=1).sum(), model.inertia)


def test_result_files_with_any_header_order(spark, tmp_path):
    for k, head in enumerate(("dataset,ari", "ari,dataset", '"dataset","ari"')):
        row = "d,0.5" if head[0] in 'd"' else "0.5,d"
        (tmp_path / f"r{k}_final_results_compiled.csv").write_text(f"{head}\n{row}\n")
    assert results.scan_results(spark, [str(tmp_path)]).where("dataset = 'd'").count() == 3


def test_headers_are_first_lines_only(spark, tmp_path):
    """A data field that reads ``dataset`` makes no header; a file without that column is no result file; blank lines may lead."""
    (tmp_path / "a_final_results_compiled.csv").write_text("\nalgorithm,dataset,ari\ndataset,d,0.5\nx,dataset,0.25\n")
    (tmp_path / "b_final_results_compiled.csv").write_text("name,value\nq,dataset\n")
    got = results.scan_results(spark, [str(tmp_path)])
    assert sorted((r.algorithm, r.dataset, r.ari) for r in got.collect()) == [("dataset", "d", 0.5), ("x", "dataset", 0.25)]


def test_sparse_confusion(spark):
    t = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), (None, 2, 4), ("b", None, 2)], "label string, cluster int, n bigint")
    dense = {(r.label, r.cluster): (r.n, r.share) for r in evaluate.normalized_confusion(t).collect()}
    assert len(dense) == 9 and dense["a", 1] == (3, 0.75) and dense[None, 2] == (4, 1.0) and dense["b", None] == (2, 1.0) and dense["b", 1] == (0, 0.0)
    few = {(r.label, r.cluster): (r.n, r.share) for r in evaluate.normalized_confusion(t, dense=False).collect()}
    assert few == {k: v for k, v in dense.items() if v[0]}
    assert evaluate.normalized_confusion(t.where("n < 0")).count() == 0


def test_farthest_pair_of_balls(spark, frame, caplog):
    """Unit vectors in clusters: balls that cannot hold the pair do not meet, and the pair is the one of all pairs."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6))
    x = np.repeat(centres, 200, axis=0) + rng.normal(scale=0.02, size=(2400, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = frame(x)
    gap = np.linalg.norm(x[:, None] - x[None], axis=2)
    i, j = np.unravel_index(gap.argmax(), gap.shape)
    plan, placed, met = fekm.pair_plan(rows, gap.max() * (1 - 1e-9))
    assert met is not None and plan.ball_copies < plan.hashed_copies / 2
    around = pairs.balls(rows, x[::40])
    at = {r.id: r._b for r in around.rows.collect()}
    low, high = around.nearest(), around.farthest()
    b = np.array([at[k] for k in range(2400)])
    assert (low[b][:, b] <= gap + 1e-9).all() and (gap <= high[b][:, b] + 1e-9).all()
    p = fekm.farthest_pair(rows)
    assert (p.id_a, p.id_b) == (min(i, j), max(i, j)) and np.isclose(p.distance, gap.max())


def test_membership_change_is_that_of_the_last_round(frame):
    x = np.random.default_rng(2).normal(size=(50, 2))
    spec = [fuzzy.FuzzySpec(3, m, a, 1, max_iters=n, tol=0.0) for m, a in ((2.0, 1.0), (1.5, 0.5)) for n in (4, 5)]
    four, five, four_s, five_s = fuzzy.fit_fuzzy(frame(x), spec)
    for before, now in ((four, five), (four_s, five_s)):
        u, v = (linalg.memberships(x, f.centres, f.spec.m, f.spec.alpha) for f in (before, now))
        assert np.isclose(now.change, np.abs(u - v).max())


def test_tiles_meet_every_pair_once():
    n, m = 2 * pairs.TILE_ROWS + 5, pairs.TILE_ROWS + 1
    left, right = ({"features": np.arange(k)[:, None], "id_n": np.arange(k)} for k in (n, m))
    met = list(pairs.tiles(left, right, False))
    assert sum(len(a["id_n"]) * len(b["id_n"]) for a, b, _ in met) == n * m and not any(s for *_, s in met)
    met = list(pairs.tiles(left, left, True))
    assert sum(len(a["id_n"]) * (len(a["id_n"]) - 1) // 2 if s else len(a["id_n"]) * len(b["id_n"]) for a, b, s in met) == n * (n - 1) // 2
    assert max(len(t["id_n"]) for a, b, _ in met for t in (a, b)) <= pairs.TILE_ROWS


def test_kernel_sums_by_tiles():
    rng = np.random.default_rng(5)
    x, y, delta = rng.normal(size=(pairs.TILE_ROWS + 9, 3)), rng.normal(size=(2 * pairs.TILE_ROWS + 1, 3)), rng.normal(size=(2 * pairs.TILE_ROWS + 1, 2))
    assert np.allclose(kernel_kmeans._kernel_sums(x, y, delta, "rbf", 0.4), linalg.kernel(x, y, "rbf", 0.4) @ delta)


@pytest.mark.parametrize("same", [True, False])
def test_kernel_values_of_two_blocks_are_evaluated_once(monkeypatch, same):
    """Both blocks are corrected by one kernel value a pair, in tiles that stay small; pairs of rows that keep their label are left out."""
    rng, t, sizes, real = np.random.default_rng(4), kernel_kmeans.KERNEL_TILE, [], linalg.kernel
    x = rng.normal(size=(3 * t + 7, 3))
    y = x if same else rng.normal(size=(2 * t + 5, 3))
    dx = rng.normal(size=(t + 9, 2))
    dy = dx if same else rng.normal(size=(11, 2))
    want = real(x, y[: len(dy)], "rbf", 0.4) @ dy, real(y, x[: len(dx)], "rbf", 0.4) @ dx
    monkeypatch.setattr(linalg, "kernel", lambda a, b, *rest: sizes.append(len(a) * len(b)) or real(a, b, *rest))
    got = kernel_kmeans._mutual_sums(x, y, dx, dy, "rbf", 0.4, same)
    assert all(np.allclose(g, w) for g, w in zip(got, want))
    assert max(sizes) <= t * t and sum(sizes) <= (5 if same else 8) * t * t + 50 * t


def test_kernel_sums_take_small_tiles(monkeypatch):
    """A batch of 10,000 rows by 2,048 changed ones was 164 MB of kernel values in every worker."""
    real, sizes = linalg.kernel, []
    monkeypatch.setattr(linalg, "kernel", lambda a, b, *rest: sizes.append(len(a) * len(b)) or real(a, b, *rest))
    x = np.random.default_rng(5).normal(size=(3000, 2))
    sums = kernel_kmeans._kernel_sums(x, x, np.ones((3000, 1)), "rbf", 0.5)
    assert max(sizes) * 8 <= 8 << 20 and np.allclose(sums[:, 0], real(x, x, "rbf", 0.5).sum(axis=1))
