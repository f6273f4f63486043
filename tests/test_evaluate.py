import itertools

import numpy as np
import pytest

from clusterloom.operators import evaluate as E
from clusterloom.operators import matching as M

Y = [0, 0, 0, 1, 1, 1]
P = [0, 0, 1, 1, 1, 1]


def scored(frame, y, p, x=None):
    return frame([[float(i)] for i in range(len(y))] if x is None else x, label=y, cluster=p)


def test_hand_computed_scores(frame):
    t = E.contingency(scored(frame, Y, P))
    assert {tuple(r) for r in t.collect()} == {(0, 0, 2), (0, 1, 1), (1, 1, 3)}
    assert np.isclose(E.purity(t).first()[0], 5 / 6)
    assert np.isclose(E.f_measure(t).first()[0], 0.5 * 0.8 + 0.5 * 6 / 7)
    assert np.isclose(E.adjusted_rand(t).first()[0], 1.2 / 3.7)
    dense = {(r["label"], r["cluster"]): r["share"] for r in E.normalized_confusion(t).collect()}
    assert np.allclose([dense[k] for k in ((0, 0), (0, 1), (1, 0), (1, 1))], [2 / 3, 1 / 3, 0, 1])


def test_rand_is_one_for_relabelled_classes(frame):
    assert E.adjusted_rand(E.contingency(scored(frame, Y, [5 - v for v in Y]))).first()[0] == 1.0
    assert E.adjusted_rand(E.contingency(scored(frame, [0] * 4, [1] * 4))).first()[0] == 1.0


def test_suite_of_many_models_equals_single_suites(frame, spark):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(40, 3)), [int(v) for v in rng.integers(0, 3, 40)]
    ps = [[int(v) for v in rng.integers(0, k, 40)] for k in (2, 5)] + [[0] * 40]
    rows = [(x[i].tolist(), y[i], [p[i] for p in ps]) for i in range(40)]
    many = E.suite_many(spark.createDataFrame(rows, "features array<double>, label int, clusters array<int>"), 3)
    for p, got in zip(ps, many):
        want = E.metric_suite(scored(frame, y, p, x)).first().asDict()
        assert want["davies_bouldin"] is got["davies_bouldin"] is None or np.isclose(want["davies_bouldin"], got["davies_bouldin"])
        assert all(np.isclose(want[k], got[k]) for k in ("ari", "purity", "f_measure"))
        t = E.contingency(scored(frame, y, p, x))
        assert np.isclose(E.purity(t).first()[0], got["purity"]) and np.isclose(E.f_measure(t).first()[0], got["f_measure"])
        assert np.isclose(E.adjusted_rand(t).first()[0], got["ari"])


@pytest.mark.parametrize("limit", [2000, 1])
def test_davies_bouldin(frame, monkeypatch, limit):
    monkeypatch.setattr(E, "CENTRES_ON_DRIVER", limit)
    df = scored(frame, [0, 0, 1, 1], [0, 0, 1, 1], [[0.0], [2.0], [10.0], [12.0]])
    assert np.isclose(E.davies_bouldin(df).first()[0], 0.2)
    x = np.random.default_rng(2).normal(size=(60, 3))
    p = [i % 4 for i in range(60)]
    got = E.davies_bouldin(scored(frame, p, p, x)).first()[0]
    c = np.array([x[np.array(p) == j].mean(0) for j in range(4)])
    s = np.array([np.linalg.norm(x[np.array(p) == j] - c[j], axis=1).mean() for j in range(4)])
    want = np.mean([max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(4) if j != i) for i in range(4)])
    assert np.isclose(got, want)


def test_davies_bouldin_is_null_without_two_clusters(frame):
    assert E.davies_bouldin(scored(frame, Y, [0] * 6)).first()[0] is None
    suite = E.metric_suite(scored(frame, Y, [0] * 6)).first()
    assert suite["davies_bouldin"] is None and suite["purity"] == 0.5


def test_matching_is_optimal(frame, spark):
    assert [tuple(r) for r in M.match_clusters(E.contingency(scored(frame, Y, P))).orderBy("cluster").collect()] == [(0, 0, 2), (1, 1, 3)]
    rng = np.random.default_rng(4)
    for clusters, classes in ((4, 4), (3, 5), (5, 3)):
        n = rng.integers(0, 9, size=(clusters, classes))
        n[0, 0] += 1
        t = spark.createDataFrame([(j, i, int(n[i, j])) for i in range(clusters) for j in range(classes)], "label int, cluster int, n bigint")
        got = M.match_clusters(t).collect()
        wide = np.hstack([n, np.zeros((clusters, clusters), int)])
        want = max(sum(wide[i, c] for i, c in enumerate(p)) for p in itertools.permutations(range(wide.shape[1]), clusters))
        assert sum(r["overlap"] for r in got) == want
        used = [r["matched"] for r in got if r["matched"] is not None]
        assert len(used) == len(set(used)) and len(got) == clusters


def _preferred(gain):
    """All choices by brute force: the largest sum, then the least class of the first cluster, and so on (none is the largest)."""
    n, k = gain.shape
    options = [*range(k), *[None] * max(0, n - k)]
    rank = lambda p: tuple(k if c is None else c for c in p)
    return list(min(itertools.permutations(options, n), key=lambda p: (-sum(gain[i, c] for i, c in enumerate(p) if c is not None), rank(p))))


def test_first_best_matching_of_small_tables():
    rng = np.random.default_rng(9)
    for shape in itertools.product(range(1, 6), range(1, 6)):
        for top in (1, 2, 4, 50):
            for _ in range(6):
                gain = rng.integers(0, top, size=shape)
                assert M.first_best(gain) == _preferred(gain), gain
    big = rng.integers(0, 10**12, size=(40, 60))
    match = M.first_best(big)
    assert len(set(match)) == 40 and M.first_best(big[::-1])[::-1] == match  # without ties the order of the clusters is all the same


@pytest.mark.parametrize("shape", [(23, 3), (3, 23), (9, 9), (1, 30), (40, 2)])
def test_blocks_give_the_matching_of_the_whole_table(spark, shape):
    rng = np.random.default_rng(sum(shape))
    for top in (2, 30):
        gain = rng.integers(0, top, size=shape)
        gain[:, 0] += gain.sum(axis=1) == 0
        gain[0] += gain.sum(axis=0) == 0
        rows = [(f"c{j:03d}", i, int(gain[i, j])) for i, j in np.argwhere(gain).tolist()]
        t = spark.createDataFrame(rows, "label string, cluster int, n bigint")
        want = [(i, None if j is None else f"c{j:03d}", 0 if j is None else int(gain[i, j])) for i, j in enumerate(M.first_best(gain))]
        for block in (512, 4):
            assert sorted(tuple(r) for r in M.match_clusters(t, block).collect()) == want


def test_matching_of_odd_tables(spark):
    t = spark.createDataFrame([(None, 0, 5), ("a", 0, 1), ("a", None, 2)], "label string, cluster int, n bigint")
    for block in (512, 1):
        assert {tuple(r) for r in M.match_clusters(t, block).collect()} == {(0, None, 5), (None, "a", 2)}
    assert M.match_clusters(t.where("n < 0")).count() == 0


def test_matched_confusion_and_relabel(frame):
    df = scored(frame, Y, [1 - p for p in P])
    assert {tuple(r) for r in M.matched_confusion(df).collect()} == {(0, 0, 2), (0, 1, 1), (1, 1, 3)}
    assert [r["matched"] for r in M.relabel(df, M.match_clusters(E.contingency(df))).orderBy("id").collect()] == P
