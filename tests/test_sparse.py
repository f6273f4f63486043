"""Sparse vectors: the matrix methods against dense ones, and wide tables through preparation, fits and scores."""

import numpy as np
import pyarrow as pa
import pytest

from clusterloom.functions import linalg
from clusterloom.functions.sparse import DENSE_CELLS, Csr
from clusterloom.operators import evaluate, fekm, fuzzy, kmeans, prep
from clusterloom.operators.blocks import Blocks


@pytest.fixture
def matrix():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(40, 12)) * (rng.random((40, 12)) < 0.2)
    x[3] = 0.0
    x[9] = x[8]
    return x


def test_methods_equal_dense_ones(matrix):
    s, rng = Csr.of(matrix), np.random.default_rng(1)
    c = np.vstack([rng.normal(size=(3, 12)), matrix[8], np.zeros(12)])
    assert np.array_equal(np.asarray(s), matrix) and s.shape == matrix.shape and len(s) == 40
    for rows in (slice(5, 20), slice(0, 0), slice(1, 30, 3), np.array([9, 3, 3]), matrix[:, 0] > 0):
        assert np.array_equal(np.asarray(s[rows]), matrix[rows])
    assert np.array_equal(s[8], matrix[8])
    assert np.allclose(s @ c.T, matrix @ c.T)
    w = rng.random((2, 40))
    assert np.allclose(w @ s, w @ matrix) and np.allclose(s.sum(axis=0), matrix.sum(axis=0)) and np.allclose(s - c[0], matrix - c[0])
    assert np.allclose(linalg.sq_dists(s, c), linalg.sq_dists(matrix, c)) and linalg.sq_dists(s, c)[9, 3] == 0 and linalg.sq_dists(s, c)[3, 4] == 0
    for metric in ("euclidean", "manhattan", "cosine"):
        assert np.allclose(linalg.direct_dists(s, c, metric), linalg.direct_dists(matrix, c, metric))
        got, want = linalg.nearest(s, c, metric), linalg.nearest(matrix, c, metric)
        assert np.array_equal(got[0], want[0]) and np.allclose(got[1], want[1])
    labels = rng.integers(0, 3, 40)
    assert np.allclose(linalg.group_sums(s, labels, 3), linalg.group_sums(matrix, labels, 3))
    assert np.allclose(linalg.own_dists(s, c, labels), linalg.own_dists(matrix, c, labels))
    assert np.allclose(linalg.memberships(s, c, 2.0, 0.5), linalg.memberships(matrix, c, 2.0, 0.5))
    back = linalg.unpack(pa.py_buffer(s.tobytes()), 40)
    assert isinstance(back, Csr) and np.array_equal(np.asarray(back), matrix)
    assert np.array_equal(linalg.unpack(pa.py_buffer(matrix.tobytes()), 40), matrix)
    with pytest.raises(ValueError, match="sparse form"):
        Csr([0, 0], [], [], DENSE_CELLS + 1).dense()


def _frames(spark, x, **columns):
    names = list(columns)
    rows = [(i, [float(v) for v in r], *[columns[c][i] for c in names]) for i, r in enumerate(x)]
    dense = spark.createDataFrame(rows, "id bigint, features array<double>" + "".join(f", {c} int" for c in names))
    thin = [(i, (len(r), [int(j) for j in np.flatnonzero(r)], [float(v) for v in r[np.flatnonzero(r)]]), *[columns[c][i] for c in names]) for i, r in enumerate(x)]
    return dense, spark.createDataFrame(thin, f"id bigint, features {linalg.SPARSE}" + "".join(f", {c} int" for c in names))


def test_fits_and_scores_equal_dense_ones(spark, matrix):
    y, p = [i % 3 for i in range(40)], [i % 4 for i in range(40)]
    dense, thin = _frames(spark, matrix, label=y, cluster=p)
    for metric in kmeans.METRICS:
        one, two = (kmeans.KMeans(4, max_iters=5, metric=metric, random_state=2).fit(df) for df in (dense, thin))
        assert np.allclose(one.centres, two.centres) and np.isclose(one.inertia, two.inertia)
        assert [r.cluster for r in one.transform(dense).orderBy("id").collect()] == [r.cluster for r in two.transform(thin).orderBy("id").collect()]
    one, two = (fuzzy.FuzzyCMeans(3, max_iters=6, random_state=1).fit(df) for df in (dense, thin))
    assert np.allclose(one.centres, two.centres) and np.isclose(one.change, two.change)
    assert np.allclose([r.u for r in one.memberships(dense).orderBy("id").collect()], [r.u for r in two.memberships(thin).orderBy("id").collect()])
    one, two = (fekm.fit_fekm(df, [3])[3, "euclidean"] for df in (dense, thin))
    assert np.isclose(one.inertia, two.inertia)
    one, two = (evaluate.metric_suite(df).first().asDict() for df in (dense, thin))
    assert one == pytest.approx(two)
    wide = Blocks(thin)
    assert (wide.n, wide.d) == (40, 12)


def test_wide_one_hot(spark, monkeypatch):
    """The same table with and without room for an array per row: same features, labels and clusters."""
    rng = np.random.default_rng(3)
    rows = [(i, float(v), None if i % 11 == 0 else f"c{rng.integers(0, 30)}", ("a", "b", "?")[i % 3], None if i % 7 == 0 else f"k{i % 20}") for i, v in enumerate(rng.random(80))]
    t = spark.createDataFrame(rows, "id bigint, n double, c string, m string, label string")
    dense, model = prep.prepare(t, class_col="label")
    monkeypatch.setattr(prep, "MAX_DENSE", 8)
    thin, wide = prep.prepare(t, class_col="label")
    assert wide.categories is None and wide.classes is None and dense.columns == thin.columns
    full = {r.id: (linalg.vector(r.features).tolist(), r.label) for r in thin.collect()}
    assert full == {r.id: (list(r.features), r.label) for r in dense.collect()} and wide.width == len(model.feature_names)
    one, two = (kmeans.KMeans(3, random_state=1).fit(x) for x in (dense, thin))
    assert np.isclose(one.inertia, two.inertia)
    new = spark.createDataFrame([(900, 0.5, "never", "a", "k1"), (901, None, "c1", None, "zz")], t.schema)
    got, want = ({r.id: r for r in m.transform(new).collect()} for m in (wide, model))
    assert {i: (linalg.vector(r.features).tolist(), r.label) for i, r in got.items()} == {i: (list(r.features), r.label) for i, r in want.items()}
    only = prep.prepare(t.select("id", "n", "label"), class_col="label")[0]
    assert {r.id: r.label for r in only.collect()} == {i: v for i, (_, v) in full.items()}
