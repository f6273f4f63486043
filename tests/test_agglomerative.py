import re

import numpy as np
import pytest

from clusterloom.functions import linalg
from clusterloom.operators import agglomerative as A


def brute(ids, x, metric, linkage, k):
    d = linalg.direct_dists(x, x, metric)
    d = np.sqrt(d) if metric == "euclidean" else d
    groups = [[i] for i in range(len(x))]

    def gap(a, b):
        block = d[np.ix_(a, b)]
        if linkage == "ward":
            return np.sqrt(2 * len(a) * len(b) / (len(a) + len(b))) * np.linalg.norm(x[a].mean(0) - x[b].mean(0))
        return {"single": block.min, "complete": block.max, "average": block.mean}[linkage]()

    while len(groups) > k:
        _, i, j = min((gap(groups[i], groups[j]), i, j) for i in range(len(groups)) for j in range(i + 1, len(groups)))
        groups[i] += groups.pop(j)
    return {frozenset(ids[i] for i in g) for g in groups}


def partition(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["cluster"], set()).add(r["id"])
    return {frozenset(v) for v in out.values()}


@pytest.mark.parametrize("linkage,metric", [("single", "euclidean"), ("single", "cosine"), ("complete", "manhattan"), ("average", "cosine"), ("ward", "euclidean")])
@pytest.mark.parametrize("finish", [A.FINISH, 6])
def test_tree_equals_one_by_one_merging(frame, linkage, metric, finish):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 3))
    x[5] = x[7] = x[4]  # copies
    ids = [int(i) for i in rng.permutation(90)[:30]]
    tree = A.merge_tree(frame(x, ids), metric, linkage, finish=finish)
    for k in (2, 5):
        assert partition(tree.labels(k)) == brute(ids, x, metric, linkage, k)


@pytest.mark.parametrize("linkage,metric", [("complete", "euclidean"), ("average", "manhattan"), ("ward", "euclidean")])
def test_one_by_one_merges_of_a_matrix(linkage, metric):
    rng = np.random.default_rng(6)
    for x in (rng.normal(size=(60, 4)), rng.integers(0, 3, size=(40, 2)).astype(float) + 1e-3 * np.arange(40)[:, None]):
        n = len(x)
        names, w = np.arange(n) * 3, np.ones(n)
        d = A._first_dists(x, x, w, w, metric, linkage)
        merges = A._one_by_one(names, w, d, linkage, 0)
        heights = [h for _, _, h, _ in merges]
        assert len(merges) == n - 1 and all(a < b for a, b, *_ in merges) and np.all(np.diff(heights) >= -1e-9)
        root = {int(v): int(v) for v in names}
        for a, b, *_ in merges[: n - 4]:
            root = {v: a if r == b else r for v, r in root.items()}
        groups = {}
        for v, r in root.items():
            groups.setdefault(r, set()).add(v)
        assert {frozenset(g) for g in groups.values()} == brute(names.tolist(), x, metric, linkage, 4)


def test_rounds_of_several_blocks(frame, monkeypatch):
    """The distance table put together from block pairs, updated to the last merge."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(18, 3))
    monkeypatch.setattr(A, "block_count", lambda *a: 3)
    for linkage in ("complete", "average", "ward"):
        tree = A.merge_tree(frame(x), linkage=linkage, finish=1)
        assert partition(tree.labels(3)) == brute(list(range(18)), x, "euclidean", linkage, 3)
        heights = [r.d for r in tree.edges.orderBy("round", "d").collect()]
        whole = A.merge_tree(frame(x), linkage=linkage)
        assert np.allclose(np.sort(heights), np.sort([r.d for r in whole.edges.collect()]))


def test_blocks_of_the_distance_table_do_not_grow(frame, monkeypatch):
    """However few blocks their bytes ask for, the matrix that a pair of blocks sends is bounded."""
    x = np.random.default_rng(3).normal(size=(40, 3))
    asked, real = [], A.block_pairs
    monkeypatch.setattr(A, "TABLE_ROWS", 6, raising=False)
    monkeypatch.setattr(A, "block_count", lambda *a: 1)
    monkeypatch.setattr(A, "block_pairs", lambda *a, blocks: asked.append(blocks) or real(*a, blocks=blocks))
    for linkage, metric in (("complete", "manhattan"), ("average", "cosine"), ("ward", "euclidean")):
        tree = A.merge_tree(frame(x), metric, linkage, finish=25)
        assert partition(tree.labels(5)) == brute(list(range(40)), x, metric, linkage, 5)
    assert asked == [7] * 3


@pytest.mark.parametrize("linkage,metric", [("complete", "euclidean"), ("complete", "manhattan"), ("complete", "cosine"), ("average", "cosine"), ("average", "euclidean"), ("ward", "euclidean")])
def test_distance_table_is_bounded(frame, monkeypatch, linkage, metric):
    """With many clusters rounds measure again: no table of more than ``TABLED`` clusters is written, and the tree is the one of that table."""
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(size=(70, 3)), np.zeros((1, 3))])
    x[5] = x[7] = x[4]  # copies
    want = A.merge_tree(frame(x), metric, linkage)
    tables, real = [], A._distance_rows
    monkeypatch.setattr(A, "_distance_rows", lambda units, ids, *more: tables.append(len(ids)) or real(units, ids, *more))
    monkeypatch.setattr(A, "TABLED", 12, raising=False)
    monkeypatch.setattr(A, "LINK_ROWS", 9, raising=False)
    monkeypatch.setattr(A, "TABLE_ROWS", 20)
    got = A.merge_tree(frame(x), metric, linkage, finish=10)
    assert np.allclose(*[sorted(r.d for r in t.edges.collect()) for t in (got, want)]) and tables[0] <= 12
    assert partition(got.labels(30)) == partition(want.labels(30))
    assert partition(got.labels(4)) == brute(list(range(71)), x, metric, linkage, 4)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_spanning_tree_of_balls_skips_blocks(frame, metric, caplog):
    rng = np.random.default_rng(12)
    x = np.vstack([rng.normal(4 * c, 0.05, size=(40, 3)) for c in rng.normal(size=(6, 3))] + [np.zeros((1, 3))])
    with caplog.at_level("INFO", logger=A.__name__):
        tree = A.merge_tree(frame(x), metric, "single", finish=1)
    want = A.merge_tree(frame(x), metric, "single")
    key = lambda t: sorted((r.a, r.b, round(r.d, 9)) for r in t.edges.collect())
    assert key(tree) == key(want)
    sent, every = (int(v) for v in re.search(r"(\d+) of (\d+) row copies", caplog.text).groups())
    assert sent < every / 2


@pytest.mark.parametrize("block_bytes", [1 << 20, 1500])
def test_spanning_tree_measures_a_pair_of_blocks_once(frame, monkeypatch, block_bytes):
    """Many equal distances, and balls of one block or of several."""
    x = np.random.default_rng(5).integers(0, 9, size=(300, 3)).astype(float)
    met, real, cut = [], A.block_pairs, A.balls
    monkeypatch.setattr(A, "block_pairs", lambda *args, **more: met.append(more["met"]) or real(*args, **more))
    monkeypatch.setattr(A, "balls", lambda *args, **more: cut(*args, **more, block_bytes=block_bytes))
    key = lambda t: sorted((r.a, r.b, round(r.d, 9)) for r in t.edges.collect())
    want = key(A.merge_tree(frame(x), linkage="single"))
    for finish in (1, 60):
        met.clear()
        assert key(A.merge_tree(frame(x), linkage="single", finish=finish)) == want
        assert np.sum(met, axis=0).max() == 1


def test_copies_come_apart_last(frame):
    x = [[0.0], [0.0], [0.0], [5.0], [5.0], [9.0]]
    for linkage in ("single", "complete"):
        tree = A.merge_tree(frame(x, [4, 2, 9, 7, 1, 3]), linkage=linkage)
        want = {2: [{4, 2, 9}, {7, 1, 3}], 3: [{4, 2, 9}, {7, 1}, {3}], 4: [{4, 2}, {9}, {7, 1}, {3}], 5: [{2}, {4}, {9}, {7, 1}, {3}], 6: [{k} for k in (1, 2, 3, 4, 7, 9)]}
        for k, groups in want.items():
            assert partition(tree.labels(k)) == {frozenset(g) for g in groups}
        many = {r.id: r.clusters for r in tree.labels_many([2, 6, 4]).collect()}
        assert many[1][0] == many[7][0] and sorted(c[1] for c in many.values()) == list(range(6))
        with pytest.raises(ValueError):
            tree.labels(7)


def test_components_of_a_large_forest(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100 + i, 100) for i in range(1, 12)], "a bigint, b bigint")
    small = {tuple(r) for r in A.components(edges).collect()}
    monkeypatch.setattr(A, "LOCAL_EDGES", 3)
    assert {tuple(r) for r in A.components(edges).collect()} == small
    assert {r for _, r in small} == {0, 100}


def test_errors(frame):
    df = frame([[0.0], [1.0]])
    for bad in (dict(linkage="median"), dict(metric="hamming"), dict(linkage="ward", metric="cosine")):
        with pytest.raises(ValueError):
            A.merge_tree(df, **bad)
    with pytest.raises(ValueError):
        A.merge_tree(df).labels(3)
