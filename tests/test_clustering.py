import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterloom.functions import columns as C
from clusterloom.functions import linalg
from clusterloom.operators import blocks as B
from clusterloom.operators import fekm, fuzzy, gmm, kernel_kmeans, kmeans, pca, selection


def lloyd(x, centres, rounds, metric="euclidean"):
    for _ in range(rounds):
        lab = linalg.direct_dists(x, centres, metric).argmin(1)
        centres = np.array([x[lab == j].mean(0) if (lab == j).any() else centres[j] for j in range(len(centres))])
    d = linalg.direct_dists(x, centres, metric)
    return d.argmin(1), centres, d.min(1).sum()


def labels_of(df, col="cluster"):
    return np.array([r[col] for r in df.orderBy("id").collect()])


# -- expressions


def test_expressions(spark):
    row = spark.range(1).select(F.array(F.lit(0.0), F.lit(0.0)).alias("a"), F.array(F.lit(1.0), F.lit(-1.0)).alias("b"))
    a, b = F.col("a"), F.col("b")
    got = row.select(
        C.sq_euclidean(a, b), C.manhattan(a, b), C.euclidean(a, b), C.rbf_kernel(a, b, 0.5), C.rbf_kernel(a, b), C.cosine_distance(b, b),
        C.argmax_index(F.array(F.lit(2), F.lit(5), F.lit(5))), C.argmin_index(b),
    ).first()
    assert np.allclose(list(got), [2, 2, np.sqrt(2), np.exp(-1), np.exp(-1), 0, 1, 1])


def test_near_ties_take_the_lowest_index():
    x = np.array([[0.1, 0.2], [1e8, 1.0]])
    c = np.array([[0.1, 0.4], [0.1, 0.0], [1e8, 1.0]])
    assert linalg.nearest(x, c, "euclidean")[0].tolist() == [linalg.direct_dists(x, c, "euclidean")[0].argmin(), 2]
    assert linalg.sq_dists(x, x).diagonal().tolist() == [0.0, 0.0]


# -- K-Means


@pytest.mark.parametrize("metric", kmeans.METRICS)
def test_kmeans_equals_numpy(frame, blobs, metric):
    x, _ = blobs
    df = frame(x)
    start = x[[0, 1, 2]]
    model = kmeans.fit_many(df, [kmeans.KMeansSpec(3, metric, init=start, max_iters=4, tol=0.0)])[0]
    want, centres, inertia = lloyd(x, start, 4, metric)
    assert np.allclose(model.centres, centres) and np.isclose(model.inertia, inertia)
    assert labels_of(model.transform(df)).tolist() == want.tolist()
    expr = df.withColumn("cluster", kmeans.assign_expression(F.col("features"), model.centres, metric))
    assert labels_of(expr).tolist() == want.tolist()


def test_kmeans_models_share_scans_without_mixing(frame, blobs):
    df = frame(blobs[0])
    specs = [kmeans.KMeansSpec(k, m, seed=s) for k in (2, 3) for m in kmeans.METRICS for s in (0, 1)]
    together = kmeans.fit_many(df, specs)
    for spec, model in zip(specs, together):
        alone = kmeans.fit_many(df, [spec])[0]
        assert np.allclose(alone.centres, model.centres) and alone.iterations == model.iterations
        if spec.metric == "euclidean":
            assert all(b <= a + 1e-9 for a, b in zip(model.history, model.history[1:]))


def test_emptied_cluster_restarts_from_a_row(frame):
    x = np.array([[0.0], [1.0], [10.0], [11.0]])
    spec = kmeans.KMeansSpec(3, init=np.array([[0.5], [10.5], [1e6]]), max_iters=1)
    model = kmeans.fit_many(frame(x), [spec])[0]
    assert model.centres[2] in x


def test_kmeans_errors(frame):
    with pytest.raises(ValueError):
        kmeans.KMeansSpec(2, "kernel")
    with pytest.raises(ValueError):
        kmeans.KMeansModel(kmeans.KMeansSpec(2)).transform(frame([[0.0]]))
    with pytest.raises(ValueError):
        kmeans.KMeans(5).fit(frame([[0.0], [1.0]]))


def test_partials_reduced_on_executors_agree(frame, blobs, monkeypatch):
    df = frame(blobs[0])
    spec = kmeans.KMeansSpec(3, seed=1)
    want = kmeans.fit_many(df, [spec])[0]
    fz = fuzzy.fit_fuzzy(df, [fuzzy.FuzzySpec(3, seed=1, max_iters=5)])[0]
    monkeypatch.setattr(B, "DRIVER_BYTES", 0)
    got = kmeans.fit_many(df, [spec])[0]
    assert np.allclose(got.centres, want.centres) and np.isclose(got.inertia, want.inertia)
    again = fuzzy.fit_fuzzy(df, [fuzzy.FuzzySpec(3, seed=1, max_iters=5)])[0]
    assert np.allclose(again.centres, fz.centres) and np.isclose(again.change, fz.change)
    assert fekm.farthest_pair(df).id_a == _farthest(blobs[0])[1]


# -- farthest pair


def _farthest(x):
    d = linalg.direct_dists(x, x, "euclidean")
    return max((d[i, j], -i, -j) for i in range(len(x)) for j in range(i + 1, len(x)))[0], *_first(d)


def _first(d):
    i, j = np.unravel_index(np.triu(d, 1).argmax(), d.shape)
    return int(i), int(j)


@pytest.mark.parametrize("seed", range(3))
def test_farthest_pair_is_exact(frame, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 4, size=(60, 3)).astype(float) if seed else rng.normal(size=(60, 3))
    pair = fekm.farthest_pair(frame(x))
    d2, i, j = _farthest(x)
    assert (pair.id_a, pair.id_b) == (i, j) and np.isclose(pair.distance, np.sqrt(d2))


def test_farthest_pair_small_cases(frame):
    p = fekm.farthest_pair(frame([[0.0], [1.0], [5.0], [10.0]]))
    assert (p.id_a, p.id_b) == (0, 3)
    same = fekm.farthest_pair(frame([[1.0]] * 4))
    assert (same.id_a, same.id_b, same.distance) == (0, 1, 0.0)


def test_seeding_steps(frame):
    blocks = B.Blocks(frame([[0.0], [1.0], [2.0], [8.0], [9.0], [10.0]]))
    pair = fekm.farthest_pair(blocks)
    groups = fekm.capped_groups(blocks, pair, [3])
    assert [g.count for g in groups[3]] == [1, 1] and [g.cut for g in groups[3]] == [0.0, 0.0]
    assert fekm.fekm_centres(blocks, [3])[3].ravel().tolist() == [0.0, 10.0, 2.0]
    with pytest.raises(ValueError):
        fekm.fekm_centres(blocks, [1])


@pytest.mark.parametrize("limit", [selection.COLLECTED, 2])
def test_fekm_start_equals_numpy_with_ties(frame, monkeypatch, limit):
    monkeypatch.setattr(selection, "COLLECTED", limit)
    monkeypatch.setattr(fekm, "COLLECTED", limit)
    x = np.random.default_rng(5).integers(0, 3, size=(80, 3)).astype(float)
    got = fekm.fekm_centres(frame(x), [2, 5])
    for k in (2, 5):
        _, i, j = _farthest(x)
        d = np.sqrt(linalg.direct_dists(x, x[[i, j]], "euclidean"))
        side = np.where(d[:, 0] <= d[:, 1], 0, 1)
        t, kept, cs = int(0.5 * len(x) / k), np.zeros(len(x), bool), []
        for s in (0, 1):
            mine = np.nonzero(side == s)[0]
            take = mine[np.lexsort((mine, d[mine, s]))][:t]
            kept[take] = True
            cs.append(x[take].mean(0))
        rest = x[~kept]
        while len(cs) < k:
            cs.append(rest[np.sqrt(linalg.direct_dists(rest, np.array(cs), "euclidean")).min(1).argmax()])
        assert np.allclose(got[k], cs)


# -- kernel K-Means


def kernel_reference(x, k, kernel, rounds):
    g = linalg.kernel(x, x, kernel, 1 / x.shape[1])
    diag = np.diag(g)
    chosen = [int((diag - 2 * g.mean(1)).argmax())]
    while len(chosen) < k:
        chosen.append(int(np.min([diag + g[c, c] - 2 * g[:, c] for c in chosen], axis=0).argmax()))
    lab = np.array([diag + g[c, c] - 2 * g[:, c] for c in chosen]).argmin(0)
    for _ in range(rounds):
        cols = []
        for c in range(k):
            m = lab == c
            cols.append(diag - 2 * g[:, m].mean(1) + g[np.ix_(m, m)].mean() if m.any() else np.full(len(x), np.inf))
        old, lab = lab, np.array(cols).argmin(0)
        if (old == lab).all():
            break
    return lab, np.array(cols).min(0).sum(), chosen


@pytest.mark.parametrize("kernel", kernel_kmeans.KERNELS)
@pytest.mark.parametrize("bytes_", [B.BROADCAST_BYTES, 0])
def test_kernel_kmeans_equals_numpy(frame, blobs, kernel, bytes_):
    x = np.vstack([blobs[0], blobs[0][:20]])  # with copies
    fits = kernel_kmeans.fit_kernel_kmeans(frame(x), [2, 4], kernel, broadcast_bytes=bytes_, max_iters=8)
    for k, m in fits.items():
        lab, inertia, chosen = kernel_reference(x, k, kernel, 8)
        assert labels_of(m.labels).tolist() == lab.tolist()
        assert np.isclose(m.inertia, inertia) and m.start_ids == chosen


def test_linear_kernel_is_plain_kmeans(frame, blobs):
    x = blobs[0]
    k = kernel_kmeans.fit_kernel_kmeans(frame(x), [3], "linear")[3]
    plain = kmeans.fit_many(frame(x), [kmeans.KMeansSpec(3, init=x[k.start_ids], tol=0.0, max_iters=50)])[0]
    assert labels_of(k.labels).tolist() == labels_of(plain.transform(frame(x))).tolist() and np.isclose(k.inertia, plain.inertia)
    with pytest.raises(ValueError):
        kernel_kmeans.KernelKMeans(2, kernel="poly")


# -- fuzzy means


def test_memberships_by_hand():
    c = np.array([[0.0], [3.0]])
    assert np.allclose(linalg.memberships(np.array([[1.0], [0.0]]), c, 2.0, 1.0), [[0.8, 0.2], [1.0, 0.0]])
    twin = linalg.memberships(np.array([[0.0]]), np.array([[0.0], [0.0], [1.0]]), 2.0, 1.0)
    assert twin.tolist() == [[1.0, 1.0, 0.0]]
    x = np.random.default_rng(0).normal(size=(9, 2))
    for m in (1.5, 1.7, 2.0, 2.5):
        u = linalg.memberships(x, x[:3] + 0.5, m, 0.5)
        assert np.allclose(u.sum(1), 1.0)
    u = np.array([[0.7, 0.3]])
    d = 1 / np.sqrt(u)  # distances that give these memberships at m = 2
    got = linalg.memberships(np.zeros((1, 1)), d.T, 2.0, 0.5)
    assert np.allclose(got, [[0.85, 0.15]])


@pytest.mark.parametrize("m,alpha", [(2.0, 1.0), (1.5, 0.5)])
def test_fuzzy_equals_numpy(frame, blobs, m, alpha):
    x = blobs[0]
    df = frame(x)
    u = np.array([r["u"] for r in df.select("id", fuzzy.initial_memberships("id", 3, 2).alias("u")).orderBy("id").collect()])
    assert np.allclose(u.sum(1), 1.0)
    for rounds in range(1, 300):
        w = u**m
        c = (w.T @ x) / w.sum(0)[:, None]
        old, u = u, linalg.memberships(x, c, m, alpha)
        if np.abs(u - old).max() < 1e-5:
            break
    model = fuzzy.fit_fuzzy(df, [fuzzy.FuzzySpec(3, m, alpha, seed=2)])[0]
    assert model.iterations == rounds and np.allclose(model.centres, c)
    assert labels_of(model.transform(df)).tolist() == u.argmax(1).tolist()
    assert fuzzy.fit_fuzzy(df, [fuzzy.FuzzySpec(1)])[0].iterations == 1


# -- mixtures


def test_mixture_recovers_blobs_and_scores(frame, blobs):
    x, y = blobs
    df = frame(x)
    models = gmm.fit_mixture(df, [gmm.MixtureSpec(3, i, 1) for i in gmm.INITS])
    for m in models:
        assert m.error is None and np.isclose(m.weights.sum(), 1.0)
        dens = np.zeros(len(x))
        for w, mu, s in zip(m.weights, m.means, m.covariances):
            z = x - mu
            dens += w * np.exp(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z)) / np.sqrt(np.linalg.det(2 * np.pi * s))
        assert np.isclose(m.avg_log_likelihood, np.log(dens).mean())
        assert np.isclose(m.bic, -2 * np.log(dens).sum() + (3 * 6 + 9 + 2) * np.log(len(x)))
    lab = labels_of(models[0].transform(df))
    assert len({(a, b) for a, b in zip(lab, y)}) == 3
    with pytest.raises(ValueError):
        gmm.MixtureSpec(2, "other")


def test_degenerate_mixture_reports_an_error(frame):
    good, bad = gmm.fit_mixture(frame([[0.0], [0.0], [1.0]]), [gmm.MixtureSpec(1, "random"), gmm.MixtureSpec(2, "k-means++", reg_covar=-1.0)])
    assert good.error is None and bad.error


# -- projection


def test_pca_by_hand_and_round_trip(spark, frame):
    m = pca.fit_pca(frame([[0.0, 0.0], [2.0, 2.0]]))
    assert np.allclose(m.covariance, 2.0) and np.allclose(m.eigenvalues, [4.0, 0.0]) and np.allclose(m.explained_variance_ratio(2), [1.0, 0.0])
    x = np.random.default_rng(1).normal(size=(50, 4)) @ np.diag([3, 2, 1, 0.5])
    df = frame(x)
    m = pca.fit_pca(df)
    assert np.allclose(m.covariance, np.cov(x.T)) and (np.diff(m.eigenvalues) <= 0).all()
    lead = m.components[np.abs(m.components).argmax(0), range(4)]
    assert (lead > 0).all()
    z = np.array([r["features"] for r in m.transform(df, 2).orderBy("id").collect()])
    assert np.allclose(z, (x - x.mean(0)) @ m.components[:, :2])
    back = m.inverse_transform(m.transform(df, 4), 4)
    assert np.allclose([r["features"] for r in back.orderBy("id").collect()], x)
    rec = pca.reconstruction(df, m, 1).orderBy("id").first()
    assert np.isclose(rec["x0"], x[0, 0])
    assert np.isclose(pca.reconstruction_error(df, m, 2).sum() * 50 / 49, m.eigenvalues[2:].sum())
    assert m.component_table(spark, 2).count() == 8
    assert pca.fit_pca(frame([[1.0, 1.0]] * 3)).explained_variance_ratio(2).tolist() == [0.0, 0.0]
