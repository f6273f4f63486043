"""Packed blocks and the row-wise helpers that work on them."""

import tracemalloc

import numpy as np

from clusterloom.functions import linalg
from clusterloom.functions.sparse import Csr
from clusterloom.llm import textkit
from clusterloom.operators.blocks import SLOT, Blocks, slot_batch


def test_blocks_gather_small_arrow_batches(spark):
    """Rows of several Arrow batches share blocks, so that a pass has few calls on many rows, and every row is in one block."""
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        b = Blocks(spark.range(0, 20_000, 1, 2).selectExpr("id", "array(cast(id as double), 1.0D) features"))
        packed = b.df.select("n", "ids").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    assert b.n == 20_000 and len(packed) <= 2 * spark.sparkContext.defaultParallelism
    assert sorted(i for r in packed for i in r.ids) == list(range(20_000))
    assert b.sums(lambda x: x.sum(axis=0), 2).tolist() == [20_000 * 19_999 / 2, 20_000]
    b.unpersist()


def test_nearest_and_memberships_by_centre():
    rng = np.random.default_rng(3)
    x, c = rng.integers(0, 4, (500, 2)).astype(float), rng.integers(0, 4, (5, 2)).astype(float)
    for metric in ("euclidean", "manhattan"):
        d = linalg.direct_dists(x, c, metric)
        best, low = linalg.nearest(x, c, metric)
        assert (best == d.argmin(axis=1)).all() and np.allclose(low, d.min(axis=1))
    d = linalg.direct_dists(x, c, "euclidean")
    for m, alpha in ((2.0, 1.0), (1.5, 0.5)):
        inv = 1 / np.maximum(d, 1e-20) ** (1 / (m - 1))
        u = inv / inv.sum(axis=1, keepdims=True)
        on = d == 0
        u[on.any(axis=1)] = on[on.any(axis=1)]
        u, win = u * alpha, u.argmax(axis=1)
        u[np.arange(len(u)), win] += 1 - alpha
        assert np.allclose(linalg.memberships(x, c, m, alpha), u)


def test_sums_of_wide_sparse_rows_hold_one_table():
    k, d = 3, 1_000_000
    x = Csr([0, 2, 3, 5], [1, 999_999, 7, 1, 5], [1.0, 2.0, 3.0, 4.0, 5.0], d)
    out = np.empty((k, 1 + d))
    tracemalloc.start()
    linalg.group_sums(x, np.array([0, 2, 0]), k, out=out)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * 8 * d  # less than another table of k x d numbers
    assert out[0, [0, 2, 6, 1_000_000]].tolist() == [2, 5, 5, 2] and out[2, [0, 8]].tolist() == [1, 3] and not out[1].any()


def test_sums_in_slots():
    v = np.arange(SLOT + 2, dtype=float)
    b = slot_batch([0, 1], v)
    assert b.column("slot").to_pylist() == [0, 1] and np.concatenate([p.values.to_numpy() for p in b.column("v")]).tolist() == v.tolist()


def test_hash_powers_are_as_long_as_needed():
    p = textkit._Powers()
    up, down = p.get(1000)
    assert 1000 <= len(up) <= 4096
    longer, _ = p.get(5000)
    assert (longer[:1000] == up[:1000]).all() and (up[:1000] * down[:1000] == 1).all()
