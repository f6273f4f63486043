"""Agglomerative clustering with single, complete, average and Ward linkage. Ids must be BIGINT.

The tree is built in rounds that merge many clusters at once, and is cut afterwards, so one tree
serves every number of clusters. Distances are evaluated block against block and reduced in the
task (per row or per cluster); no table of row pairs exists at any time.

* single: rows are grouped in balls, every pair of blocks is measured once and leaves the spanning tree of its distances, and Boruvka rounds
  over these edges give the tree of all. Blocks that are too far apart do not meet;
* the others are reducible: all mutually nearest clusters may merge in the same round. While there are many clusters, a round measures
  again what lost its nearest cluster: by centroids for Ward and for average linkage of cosines, else by all rows of the clusters.
  Once there are ``TABLED`` clusters, their distances are kept in a table with a row per cluster, so that a round updates rows by the
  recurrence of the linkage. The shared folder takes the rows and 8 bytes a pair of these clusters, whatever the number of rows.
"""

from __future__ import annotations

import logging
import math
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.functions import linalg
from clusterloom.operators.blocks import BROADCAST_BYTES
from clusterloom.operators.kmeans import random_rows
from clusterloom.operators.pairs import SLACK, Balls, balls, block_count, block_pairs, frame_of, tiles
from clusterloom.operators.selection import row_numbers
from clusterloom.session import cut_lineage

LINKAGES = ("single", "complete", "average", "ward")
METRICS = ("euclidean", "manhattan", "cosine")
FINISH = 2048  # with so few clusters left one task merges them one by one (a distance matrix of 32 MiB)
TABLED = 2048  # with so few clusters left their distances are kept as a table (32 MiB)
BATCH_BYTES = 16 << 20
LINK_ROWS = 512  # rows of a tile whose distances are measured for the nearest clusters only: 2 MiB, which stay in the processor's cache
TABLE_ROWS = 1024  # rows of a block whose distances are kept: a pair of blocks is a matrix of 8 MiB
BALLS, ROWS_PER_BALL = 64, 16
MAPPED = 1000  # up to this many clusters are numbered by a literal map
ROUNDING = 1e-6  # of distances by matrix products, against bounds
TREE_EDGES = 1 << 20  # edges of trees that a task gathers before it drops those that cannot be of the tree
LOCAL_EDGES = 200_000  # forests up to this size are resolved on the driver

log = logging.getLogger(__name__)


@dataclass
class MergeTree:
    rows: DataFrame  # (id, features) as given
    nodes: DataFrame  # (id, features) distinct
    n_nodes: int
    edges: DataFrame  # (a, b, d, round): n_nodes - 1 merges
    n_rows: int

    def labels(self, k: int) -> DataFrame:
        """(id, cluster) after undoing the last k - 1 merges; clusters are numbered by smallest id.

        Copies of a row merge before everything else, so that they come apart, those of the largest ids first, only where ``k``
        exceeds the number of distinct rows.
        """
        return self.labels_many([k]).select("id", F.col("clusters")[0].alias("cluster"))

    def labels_many(self, ks: list[int]) -> DataFrame:
        """(id, clusters): one cluster number per k, with a single join to the rows."""
        for k in ks:
            if not 1 <= k <= self.n_rows:
                raise ValueError(f"{k} clusters asked from {self.n_rows} rows")
        coded = self.nodes
        for i, k in enumerate(ks):
            if k <= self.n_nodes:
                coded = coded.join(self._numbered(k, f"c{i}"), "id")
        out = self.rows.join(coded.withColumnRenamed("id", "node"), "features").drop("features")
        for i, k in enumerate(ks):
            if k > self.n_nodes:
                out = out.join(self._apart(k, f"c{i}"), "id")
        return out.select("id", F.array(*[f"c{i}" for i in range(len(ks))]).alias("clusters"))

    def _numbered(self, k: int, name: str) -> DataFrame:
        last = self.edges.orderBy(F.desc("d"), F.desc("round"), F.desc("a"), F.desc("b")).limit(k - 1).select("a", "b")
        kept = self.edges.join(F.broadcast(last) if k <= LOCAL_EDGES else last, ["a", "b"], "left_anti") if k > 1 else self.edges
        found = components(kept.select("a", "b"))
        return _coded(self.nodes.select("id").join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("root", "id").alias("root")), k, name)

    def _apart(self, k: int, name: str) -> DataFrame:
        """(id, name): every distinct row a cluster of its own, and ``k - n_nodes`` copies too."""
        rows = self.rows.join(self.nodes.withColumnRenamed("id", "node"), "features").select("id", "node")
        single = rows.where("id != node").orderBy(F.desc("node"), F.desc("id")).limit(k - self.n_nodes).select("id", F.lit(True).alias("single"))
        return _coded(rows.join(single, "id", "left").select("id", F.when(F.col("single"), F.col("id")).otherwise(F.col("node")).alias("root")), k, name)


def _coded(roots: DataFrame, k: int, name: str) -> DataFrame:
    """(id, name): roots (id, root) numbered in their order; there are ``k`` of them."""
    if k <= MAPPED:
        names = sorted(r["root"] for r in roots.select("root").distinct().collect())
        code = F.create_map(*[F.lit(v) for i, r in enumerate(names) for v in (r, i)])
        return roots.select("id", code[F.col("root")].alias(name))
    numbers = row_numbers(roots.select("root").distinct(), ["root"], name)
    return roots.join(numbers, "root").select("id", F.col(name).cast("int").alias(name))


def merge_tree(df: DataFrame, metric: str = "euclidean", linkage: str = "complete", finish: int = FINISH) -> MergeTree:
    """The tree of all merges. Rounds of merges go on until ``finish`` clusters are left, which one task then merges one by one."""
    if linkage not in LINKAGES or metric not in METRICS:
        raise ValueError(f"linkage must be one of {LINKAGES} and metric one of {METRICS}")
    if linkage == "ward" and metric != "euclidean":
        raise ValueError("ward linkage needs the euclidean metric")
    rows = df.select(F.col("id").cast("bigint").alias("id"), F.col("features").cast("array<double>").alias("features"))
    nodes = cut_lineage(
        rows.groupBy("features").agg(F.min("id").alias("id"), F.count("*").cast("double").alias("w")).select("id", "features", "w")
    )
    s = nodes.agg(F.count("*").alias("n"), F.max(F.size("features")).alias("d"), F.sum("w").alias("w")).first()
    blocks = block_count(s["n"], s["d"] or 1, df.sparkSession.sparkContext.defaultParallelism)
    if linkage == "single":
        edges = _spanning_tree(nodes, s["n"], metric, finish)
    else:
        edges = _mutual_merges(nodes, s["n"], metric, linkage, blocks, finish)
    return MergeTree(rows, nodes.select("id", "features"), s["n"], edges, int(s["w"] or 0))


class Agglomerative:
    """Single-model front."""

    def __init__(self, n_clusters: int, metric: str = "euclidean", linkage: str = "complete"):
        self.n_clusters, self.metric, self.linkage = n_clusters, metric, linkage

    def fit_predict(self, df: DataFrame) -> DataFrame:
        return merge_tree(df, self.metric, self.linkage).labels(self.n_clusters)


# -- forests --------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): smallest node of the connected component of every node with an edge."""
    spark = edges.sparkSession
    head = edges.select("a", "b").limit(LOCAL_EDGES + 1).toArrow()
    if head.num_rows <= LOCAL_EDGES:
        parent: dict = {}

        def find(v):
            while parent.setdefault(v, v) != v:
                parent[v] = v = parent[parent[v]]
            return v

        for a, b in zip(head.column("a").to_pylist(), head.column("b").to_pylist()):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        return spark.createDataFrame(pa.table({"node": pa.array(nodes, pa.int64()), "root": pa.array([find(v) for v in nodes], pa.int64())}))
    edges = cut_lineage(edges)
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    labels = cut_lineage(both.select(F.col("u").alias("node")).distinct().withColumn("root", F.col("node")))
    while True:
        seen = labels.select(F.col("node").alias("v"), F.col("root").alias("r"))
        low = both.join(seen, "v").groupBy(F.col("u").alias("node")).agg(F.min("r").alias("m"))
        step = labels.join(low, "node").select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        step = cut_lineage(step)
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
        fresh = cut_lineage(step.join(jump, "root").select("node", "old", F.col("up").alias("root")))
        if fresh.where("root != old").isEmpty():
            return fresh.select("node", "root")
        labels = fresh.select("node", "root")


# -- distances ------------------------------------------------------------------------------


def _dist(x, y, metric, same):
    """Distances; the metric "unit" is that of cosines of vectors of length one, or of their means."""
    if metric == "euclidean":
        d = np.sqrt(np.maximum(linalg.sq_dists(x, y), 0.0))
    elif metric == "unit":
        d = 1.0 - x @ y.T
    else:
        d = linalg.direct_dists(x, y, metric)
    return np.triu(d, 1) + np.triu(d, 1).T if same else d  # one value per unordered pair


_LINKS = "a bigint, b bigint, d double, lo int, hi int"


def _spanning_tree(nodes: DataFrame, n: int, metric: str, finish: int, n_balls: int = BALLS) -> DataFrame:
    """n - 1 edges (a, b, d, round) of the minimum spanning tree under the order (d, a, b).

    Rows lie in balls. An edge of the tree is one of the spanning tree of any part of the rows that holds it, so each pair of blocks is measured once
    and leaves the tree of its own distances, fewer edges than rows; the tree of all is found among these. Blocks meet first if their balls come
    nearer than the longest edge within either, and of the others those that are not too far apart by way of further blocks.
    """
    spark = nodes.sparkSession

    def points(block: pa.Table) -> pa.Table:
        side = _by_id(frame_of(block))
        return _edge_table(_by_prim(side["id_n"], _dist(side["features"], side["features"], metric, True)))

    if n <= max(finish, 1):
        return cut_lineage(nodes.select("id", "features").groupBy().applyInArrow(points, _EDGES))

    def forest(left, right, same):
        left, right = _by_id(left), _by_id(right)
        edges, held = None, 0
        for one, other, own in tiles(left, right, same):
            d = _dist(one["features"], other["features"], metric, own)
            found = [np.array(c) for c in zip(*_by_prim(one["id_n"], d) if own else _by_prim_across(one["id_n"], other["id_n"], d))][:3]
            if found:
                edges = found if edges is None else [np.concatenate(c) for c in zip(edges, found)]
            if edges is not None and len(edges[0]) > held + TREE_EDGES:
                edges = _forest(*edges)
                held = len(edges[0])
        if edges is None:
            return []
        a, b, d = _forest(*edges)
        lo, hi = (np.full(len(a), side["ball"][0], np.int32) for side in (left, right))
        return [pa.RecordBatch.from_pydict({"a": a, "b": b, "d": d, "lo": lo, "hi": hi})]

    # cosine distances are half the squared distances of unit vectors; manhattan distances are never below Euclidean ones
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, v: s + v * v))
    by = F.when(norm > 0, F.transform("features", lambda v: v / norm)).otherwise(F.col("features")) if metric == "cosine" else F.col("features")
    placed = cut_lineage(nodes.select("id", "features", by.alias("by")))
    around = balls(placed, np.array([f for _, f in random_rows(placed, max(1, min(n // ROWS_PER_BALL, n_balls)), 0, features="by")]), by="by")
    low, high = _ball_bounds(around, metric)
    rows = cut_lineage(around.rows.select("id", "features", "_b", F.col("_b").alias("ball")))

    def trees(met):
        return cut_lineage(block_pairs(rows, forest, _LINKS, met=met))

    found = trees(np.eye(len(low), dtype=bool))
    longest = np.zeros(len(low))
    for r in found.groupBy("lo").agg(F.max("d").alias("d")).collect():  # a row a block
        longest[r["lo"]] = r["d"]
    either = np.maximum(longest[:, None], longest[None, :])
    met = low <= either * (1 + ROUNDING)
    np.fill_diagonal(met, False)
    if met.any():
        near = trees(met)
        found = found.unionByName(near)
        for r in near.groupBy("lo", "hi").agg(F.min("d").alias("d")).collect():  # a row a pair of blocks
            high[r["lo"], r["hi"]] = high[r["hi"], r["lo"]] = r["d"]
    rest = _open_pairs(low, np.maximum(high, either), met)
    if rest.any():
        found = found.unionByName(trees(rest))
    log.info("spanning tree: %d of %d row copies", around.copies(met | rest), around.copies(np.ones_like(met)))
    return _tree_of(found.select("a", "b", "d"), n, finish)


def _ball_bounds(around: Balls, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) by block and block: no row of one is nearer to one of the other than ``low``, and two of them are no farther apart than ``high``."""
    centres, low, high = around.centres, around.nearest(), around.farthest()
    apart = linalg.direct_dists(centres, centres, metric)
    if metric == "euclidean":
        apart = np.sqrt(apart)
    elif metric == "cosine":  # a zero vector is at distance 1 from everything
        low, high = low**2 / 2, np.maximum(high**2 / 2, 1.0)
    else:
        root = np.sqrt(centres.shape[1])
        low = np.maximum(low, apart * (1 - SLACK) - root * (around.radius[:, None] + around.radius[None, :]))
        high = high * root
    _, ball, blocks = np.unique(centres, axis=0, return_inverse=True, return_counts=True)
    whole = blocks[ball.ravel()] == 1  # such a block holds its centre, which is a row
    return low, np.where(whole[:, None] & whole[None, :], apart, high)


def _open_pairs(low: np.ndarray, high: np.ndarray, met: np.ndarray) -> np.ndarray:
    """Flags of the pairs of different blocks, not in ``met``, that may hold an edge of the tree: there is no way between them by way of other
    blocks whose steps (``high``: no longer than this) are all shorter than their distance (``low``: no shorter than this)."""
    way = high.copy()
    for k in range(len(way)):
        np.minimum(way, np.maximum(way[:, k, None], way[None, k, :]), out=way)
    out = (low <= way * (1 + ROUNDING)) & ~met
    np.fill_diagonal(out, False)
    return out


def _tree_of(edges: DataFrame, n: int, finish: int) -> DataFrame:
    """The spanning tree (a, b, d, round) of ``n`` nodes among ``edges`` (a, b, d): every component takes its shortest outgoing edge, until ``finish``
    components are left, whose edges one task sees."""
    live = edges.select(F.col("a").alias("x"), F.col("b").alias("y"), "d", "a", "b")
    tree, left = None, n

    def rest(block: pa.Table) -> pa.Table:
        x, y, d, a, b = (block.column(c).to_numpy() for c in ("x", "y", "d", "a", "b"))
        at = _forest_at(x, y, d, a, b)
        return _edge_table(list(zip(a[at], b[at], d[at], [0] * len(at))))

    while left > max(finish, 1):
        ends = live.select("x", "y", "d", "a", "b").unionByName(live.select(F.col("y").alias("x"), F.col("x").alias("y"), "d", "a", "b"))
        picked = cut_lineage(ends.groupBy("x").agg(F.min(F.struct("d", "a", "b", "y")).alias("e")).select("x", "e.*"))
        chosen = picked.select("a", "b", "d").distinct().withColumn("round", F.lit(0))
        tree = chosen if tree is None else tree.unionByName(chosen)
        left -= chosen.count()
        if left <= 1:
            return tree
        joined = cut_lineage(components(picked.select(F.col("x").alias("a"), F.col("y").alias("b"))))
        for end in ("x", "y"):
            live = live.join(joined.select(F.col("node").alias(end), F.col("root").alias("r")), end).drop(end).withColumnRenamed("r", end)
        apart = live.where("x != y").groupBy(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).agg(F.min(F.struct("d", "a", "b")).alias("e"))
        live = cut_lineage(apart.select(F.col("lo").alias("x"), F.col("hi").alias("y"), "e.*"))
    last = live.groupBy().applyInArrow(rest, _EDGES)
    return cut_lineage(last if tree is None else tree.unionByName(last))


def _forest_at(x, y, d, a, b) -> np.ndarray:
    """Positions of the edges of the minimum spanning forest of nodes ``x`` and ``y`` under the order (d, a, b)."""
    order = np.lexsort((b, a, d))
    names, code = np.unique(np.concatenate((x[order], y[order])), return_inverse=True)
    u, v = code[: len(x)], code[len(x) :]
    comp, live, kept = np.arange(len(names)), np.arange(len(x)), []
    while True:
        apart = comp[u[live]] != comp[v[live]]
        live = live[apart]
        if not len(live):
            return order[np.concatenate(kept)] if kept else np.zeros(0, int)
        first = np.full(len(names), len(x))
        np.minimum.at(first, comp[u[live]], live)
        np.minimum.at(first, comp[v[live]], live)
        own = np.flatnonzero(first < len(x))
        kept.append(np.unique(first[own]))
        up = np.arange(len(names))
        up[own] = comp[u[first[own]]] + comp[v[first[own]]] - own  # the other end
        top = (up[up] == np.arange(len(up))) & (np.arange(len(up)) < up)
        up[top] = np.flatnonzero(top)
        while (up[up] != up).any():
            up = up[up]
        comp = up[comp]


def _forest(a, b, d):
    at = _forest_at(a, b, d, a, b)
    return a[at], b[at], d[at]


def _by_prim(names: np.ndarray, d: np.ndarray) -> list[tuple]:
    """Minimum spanning tree of a distance matrix under the order (d, smaller name, larger name); names rise."""
    return _prim(names, lambda v: (slice(None), d[v]))


def _by_prim_across(left: np.ndarray, right: np.ndarray, d: np.ndarray) -> list[tuple]:
    """The same of the distances of two sets of rows, none within either; the names of either rise."""
    by_row, by_column, n = np.ascontiguousarray(d), np.ascontiguousarray(d.T), len(left)
    return _prim(np.concatenate((left, right)), lambda v: (slice(n, None), by_row[v]) if v < n else (slice(0, n), by_column[v - n]))


def _prim(names: np.ndarray, distances) -> list[tuple]:
    """``distances(v)`` gives the slice of nodes that node ``v`` has edges to, with names that rise, and their lengths."""
    n = len(names)
    best, src, outside = np.full(n, np.inf), np.full(n, n), np.ones(n, bool)
    out, v = [], 0
    for _ in range(n - 1):
        outside[v], best[v] = False, np.inf
        at, d = distances(v)
        b, s = best[at], src[at]
        nearer = ((d < b) | ((d == b) & (v < s))) & outside[at]
        b[nearer], s[nearer] = d[nearer], v
        tied = np.flatnonzero(best == best.min())
        if len(tied) > 1:
            ends = names[tied], names[src[tied]]
            tied = tied[np.lexsort((np.maximum(*ends), np.minimum(*ends)))]
        v = int(tied[0])
        i, j = int(names[v]), int(names[src[v]])
        out.append((min(i, j), max(i, j), float(best[v]), 0))
    return out


def _by_id(side: dict, key: str = "id") -> dict:
    ids = side["id"].to_numpy()
    order = np.lexsort((ids, side[key])) if key != "id" else np.argsort(ids)
    out = {c: v[order] for c, v in side.items() if c != "id"}
    out["id_n"] = ids[order]
    return out


# -- linkages with a table of cluster distances ------------------------------------------------


def _joined(linkage: str, x, y, wx, wy, wc, height):
    """Distance of clusters of weight ``wc`` to the union of two at distance ``height``, from their distances ``x`` and ``y`` to either."""
    if linkage == "complete":
        return np.maximum(x, y)
    if linkage == "average":
        return (wx * x + wy * y) / (wx + wy)
    return np.sqrt(np.maximum(((wx + wc) * x**2 + (wy + wc) * y**2 - wc * height**2) / (wx + wy + wc), 0.0))


def _first_dists(x, y, wx, wy, metric, linkage, same=False):
    d = _dist(x, y, metric, same)
    return d * np.sqrt(2.0 * wx[:, None] * wy[None, :] / (wx[:, None] + wy[None, :])) if linkage == "ward" else d


def _one_by_one(names: np.ndarray, w: np.ndarray, d: np.ndarray, linkage: str, rnd: int):
    """Merges of a symmetric distance matrix in the order (d, smaller name, larger name); names rise.

    The nearest cluster of each is kept: of the linkages here none brings a merged cluster nearer than both its parts were, so that
    only clusters whose nearest took part look again.
    """
    n, w = len(names), w.copy()
    np.fill_diagonal(d, np.inf)
    near = d.argmin(axis=1)
    least = d[np.arange(n), near]
    out = []
    for step in range(n - 1):
        i = int(least.argmin())
        j = int(near[i])
        i, j = min(i, j), max(i, j)
        height = d[i, j]
        out.append((int(names[i]), int(names[j]), float(height), rnd + step))
        fresh = _joined(linkage, d[i], d[j], w[i], w[j], w, height)
        fresh[[i, j]] = np.inf
        fresh[np.isinf(d[i])] = np.inf
        d[i], d[:, i], d[j], d[:, j] = fresh, fresh, np.inf, np.inf
        w[i] += w[j]
        again = (near == i) | (near == j)
        again[[i, j]] = True, False
        sooner = ~again & ((fresh < least) | ((fresh == least) & (i < near)))
        near[sooner], least[sooner] = i, fresh[sooner]
        again = np.flatnonzero(again & np.isfinite(least))
        near[again] = d[again].argmin(axis=1)
        least[again] = d[again, near[again]]
        least[j], near[j] = np.inf, -1
    return out


_EDGES = "a bigint, b bigint, d double, round int"
_ROWS = "cid bigint, dist array<double>, other bigint, d double"


def _edge_table(merges) -> pa.Table:
    cols = list(zip(*merges)) if merges else [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int32()))], names=["a", "b", "d", "round"])


def _row_table(cid, dist: np.ndarray, ids: np.ndarray):
    """Rows of the distance table with the nearest cluster of each, the one of the least name on ties."""
    near = dist.argmin(axis=1)
    rows = pa.ListArray.from_arrays(pa.array(np.arange(len(dist) + 1) * dist.shape[1], pa.int32()), pa.array(dist.ravel()))
    return pa.table({"cid": pa.array(cid, pa.int64()), "dist": rows, "other": ids[near], "d": dist[np.arange(len(dist)), near]})


def _matrix(column, width: int) -> np.ndarray:
    return pa.concat_arrays(column.chunks if isinstance(column, pa.ChunkedArray) else [column]).flatten().to_numpy().reshape(-1, width)


@contextmanager
def _batches_of(spark, width: int):
    """Arrow batches of distance rows of at most ``BATCH_BYTES`` while jobs run in here."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(1, min(10_000, BATCH_BYTES // (8 * width)))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _starts(cid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the clusters of rows in the order of their names, and the first row of each."""
    at = np.flatnonzero(np.concatenate(([len(cid) > 0], cid[1:] != cid[:-1])))
    return cid[at], at


def _between(one: dict, other: dict, metric: str, linkage: str, same: bool) -> np.ndarray:
    """Distances of all clusters of one set of rows to all of another, from the rows (cid, features, w), which lie cluster by cluster.

    Clusters of several rows are measured ``LINK_ROWS`` x ``LINK_ROWS`` rows at once and reduced there.
    """
    (x, sx, wx), (y, sy, wy) = ((side["features"], _starts(side["cid"])[1], side["w"]) for side in (one, other))
    if len(sx) == len(x) and len(sy) == len(y):
        return _first_dists(x, y, wx, wy, metric, linkage, same)
    squared, join = metric == "euclidean" and linkage == "complete", np.maximum if linkage == "complete" else np.add
    out = np.full((len(sx), len(sy)), -np.inf if linkage == "complete" else 0.0)

    def pieces(starts, n):
        for a in range(0, n, LINK_ROWS):
            b = min(a + LINK_ROWS, n)
            lo, hi = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, b)
            yield slice(a, b), slice(lo, hi), np.maximum(starts[lo:hi] - a, 0)

    for rows, i, first in pieces(sx, len(x)):
        for cols, j, top in pieces(sy, len(y)):
            d = np.maximum(linalg.sq_dists(x[rows], y[cols]), 0.0) if squared else _dist(x[rows], y[cols], metric, False)
            if linkage == "average":
                d = d * (wx[rows, None] * wy[None, cols])
            d = join.reduceat(join.reduceat(d, first, axis=0), top, axis=1)
            join(out[i, j], d, out=out[i, j])
    if squared:
        out = np.sqrt(out)
    elif linkage == "average":
        out /= np.add.reduceat(wx, sx)[:, None] * np.add.reduceat(wy, sy)[None, :]
    return np.triu(out, 1) + np.triu(out, 1).T if same else out  # one value per unordered pair


def _least(held: dict, names_of: np.ndarray, m: np.ndarray, names: np.ndarray) -> None:
    """Keep in ``held`` the nearest cluster so far, the one of the least name on ties, by distances ``m`` of the clusters ``names_of`` to ``names``."""
    first = np.searchsorted(held["cid"], names_of[0])
    at, near = slice(first, first + len(names_of)), m.argmin(axis=1)
    d, other = m[np.arange(len(m)), near], names[near]
    nearer = (d < held["d"][at]) | ((d == held["d"][at]) & (other < held["other"][at]))
    held["d"][at], held["other"][at] = np.where(nearer, d, held["d"][at]), np.where(nearer, other, held["other"][at])


def _held(side: dict) -> tuple[dict, np.ndarray]:
    """No nearest cluster yet, and cuts of the rows, which lie cluster by cluster, into tiles of whole clusters."""
    names, at = _starts(side["cid"])
    first = np.searchsorted(at, np.arange(0, len(side["cid"]), LINK_ROWS))
    cuts = np.unique(np.append(at[first[first < len(at)]], len(side["cid"])))
    return {"cid": names, "d": np.full(len(names), np.inf), "other": np.full(len(names), np.iinfo(np.int64).max)}, cuts


def _found(held: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c: held[c][np.isfinite(held["d"])] for c in ("cid", "other", "d")})


_NEAREST = "cid bigint, other bigint, d double"


def _nearest_clusters(units: DataFrame, metric: str, linkage: str, blocks: int) -> DataFrame:
    """(cid, other, d): the nearest cluster of each. A pair of blocks leaves a row per cluster."""

    def emit(left, right, same):
        left = _by_id(left, "cid")
        right = left if same else _by_id(right, "cid")
        mine, cuts = _held(left)
        theirs, other_cuts = (mine, cuts) if same else _held(right)
        for one, other, own in tiles(left, right, same, cuts, other_cuts):
            m = _between(one, other, metric, linkage, own)
            names, other_names = _starts(one["cid"])[0], _starts(other["cid"])[0]
            if own:
                np.fill_diagonal(m, np.inf)
            else:
                _least(theirs, other_names, np.ascontiguousarray(m.T), names)
            _least(mine, names, m, other_names)
        return [_found(held) for held in ((mine,) if same else (mine, theirs))]

    return _nearest_of_all(block_pairs(units, emit, _NEAREST, "cid", blocks=blocks))


def _nearest_of_few(units: DataFrame, asked: pa.Table, metric: str, linkage: str, blocks: int) -> DataFrame:
    """The same for the clusters whose rows are ``asked``, which all tasks get. Each row of ``units`` is sent to one task."""
    schema = pa.schema([("cid", pa.int64()), ("other", pa.int64()), ("d", pa.float64())])
    shared = units.sparkSession.sparkContext.broadcast(_by_id(frame_of(asked), "cid"))

    def emit(block: pa.Table) -> pa.Table:
        few, side = shared.value, _by_id(frame_of(block.drop_columns("_b")), "cid")
        (held, cuts), other_cuts = _held(few), _held(side)[1]
        for one, other, _ in tiles(few, side, False, cuts, other_cuts):
            m = _between(one, other, metric, linkage, False)
            names, other_names = _starts(one["cid"])[0], _starts(other["cid"])[0]
            _, i, j = np.intersect1d(names, other_names, assume_unique=True, return_indices=True)
            m[i, j] = np.inf  # of a cluster to itself
            _least(held, names, m, other_names)
        return pa.Table.from_batches([_found(held)]).cast(schema)

    return _nearest_of_all(units.withColumn("_b", F.pmod(F.xxhash64("cid"), F.lit(blocks))).groupBy("_b").applyInArrow(emit, _NEAREST))


def _nearest_of_all(found: DataFrame) -> DataFrame:
    return found.groupBy("cid").agg(F.min(F.struct("d", "other")).alias("e")).select("cid", "e.other", "e.d")


def _united(units: DataFrame, a: np.ndarray, b: np.ndarray) -> DataFrame:
    """Centroids after clusters ``b`` have joined clusters ``a``."""
    roles = units.sparkSession.createDataFrame(pa.table({"cid": np.concatenate((a, b)), "root": np.concatenate((a, a))}))
    placed = units.join(roles, "cid", "left")
    pairs = placed.where("root IS NOT NULL").groupBy("root").agg(F.sort_array(F.collect_list(F.struct("cid", "w", "features"))).alias("p"))
    x, y = F.col("p")[0], F.col("p")[1]
    total = x["w"] + y["w"]
    mean = F.zip_with(x["features"], y["features"], lambda u, v: (u * x["w"] + v * y["w"]) / total)
    merged = pairs.select(F.col("root").alias("id"), mean.alias("features"), total.alias("w"), F.col("root").alias("cid"))
    return placed.where("root IS NULL").select("id", "features", "w", "cid").unionByName(merged)


def _distance_rows(units: DataFrame, ids: np.ndarray, metric: str, linkage: str, blocks: int) -> DataFrame:
    """A row per cluster with its distances to all in the order of ``ids``, put together from the pairs of blocks.

    Blocks have about ``TABLE_ROWS`` clusters whatever the table, as a pair of them leaves its task as a matrix.
    """
    blocks = max(blocks, -(-len(ids) // TABLE_ROWS))
    numbered = units.select("id", "features", "w", "cid", F.pmod(F.xxhash64("cid"), F.lit(blocks)).alias("part"))
    head = numbered.select("cid", "part").distinct().toArrow()
    part = head.column("part").to_numpy()[np.argsort(head.column("cid").to_numpy())]
    shared = units.sparkSession.sparkContext.broadcast((ids, np.argsort(part, kind="stable")))  # positions by part, names rise within

    def emit(left, right, same):
        left, right = _by_id(left, "cid"), _by_id(right, "cid")
        d = _between(left, right, metric, linkage, same)
        out = []
        for x, y, m in ((left, right, d),) if same else ((left, right, d), (right, left, d.T)):
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))
            out.append(pa.RecordBatch.from_arrays([pa.array(_starts(x["cid"])[0], pa.int64()), pa.array(np.full(len(m), y["part"][0]), pa.int64()), cells], ["cid", "part", "dist"]))
        return out

    def whole(key, parts):
        names, places = shared.value
        parts = parts.combine_chunks()
        order = np.argsort(parts.column("part").to_numpy())
        dist = np.empty((1, len(names)))
        dist[0, places] = parts.column("dist").combine_chunks().take(pa.array(order)).flatten().to_numpy()
        dist[0, np.searchsorted(names, key[0].as_py())] = np.inf
        return _row_table([key[0].as_py()], dist, names)

    parts = block_pairs(numbered, emit, "cid bigint, part bigint, dist array<double>", "cid", blocks=blocks)
    return parts.groupBy("cid").applyInArrow(whole, _ROWS)


def _after(rows: DataFrame, state, linkage: str) -> DataFrame:
    """The distance table after a round of merges; ``state`` (a broadcast) has names, weights and merges as positions, and the names that stay."""

    def columns(cid, dist):
        s = state.value
        at = np.searchsorted(s["ids"], cid)
        out = dist.copy()
        out[:, s["a"]] = _joined(linkage, dist[:, s["a"]], dist[:, s["b"]], s["w"][s["a"]], s["w"][s["b"]], s["w"][at][:, None], s["h"])
        return out[:, s["stay"]]

    def untouched(batches):
        s = state.value
        ids = s["ids"][s["stay"]]
        for batch in batches:
            cid = batch.column("cid").to_numpy()
            if len(cid):
                yield from _row_table(cid, columns(cid, _matrix(batch.column("dist"), len(s["ids"]))), ids).to_batches()

    def merged(key, pair):
        s = state.value
        ids = s["ids"][s["stay"]]
        cid = pair.column("cid").to_numpy()
        order = np.argsort(cid)  # the one that gives the name first
        dist = columns(cid, _matrix(pair.column("dist"), len(s["ids"])))[order]
        wa, wb = s["w"][np.searchsorted(s["ids"], cid[order])]
        height = s["h"][np.searchsorted(s["ids"][s["a"]], key[0].as_py())]
        row = _joined(linkage, dist[0], dist[1], wa, wb, s["w_new"], height)[None, :]
        row[0, np.searchsorted(ids, key[0].as_py())] = np.inf
        return _row_table([key[0].as_py()], row, ids)

    s = state.value
    roots = np.concatenate([s["ids"][s["a"]]] * 2)
    roles = rows.sparkSession.createDataFrame(pa.table({"cid": np.concatenate([s["ids"][s["a"]], s["ids"][s["b"]]]), "root": roots}))
    placed = rows.join(F.broadcast(roles), "cid", "left")  # 16 bytes a cluster, less than two rows of the table
    alone = placed.where("root IS NULL").select("cid", "dist").mapInArrow(untouched, _ROWS)
    return alone.unionByName(placed.where("root IS NOT NULL").groupBy("root").applyInArrow(merged, _ROWS))


def _mutual(ids: np.ndarray, near: pa.Table):
    """Positions (a, b) of mutually nearest clusters and their distances; if rounding leaves none, the nearest pair of all."""
    order = np.argsort(near.column("cid").to_numpy())
    to = np.searchsorted(ids, near.column("other").to_numpy()[order])
    d = near.column("d").to_numpy()[order]
    own = np.arange(len(ids))
    a = np.flatnonzero((to[to] == own) & (own < to))
    if not len(a):
        i = int(d.argmin())
        return np.array([min(i, to[i])]), np.array([max(i, to[i])]), d[i : i + 1]
    return a, to[a], d[a]


def _mutual_merges(nodes, n, metric, linkage, blocks, finish) -> DataFrame:
    """n - 1 merges (a, b, d, round); a cluster is named by its smallest id and a absorbs b.

    Each round merges all mutually nearest clusters. Beyond ``TABLED`` clusters it measures; then distances are computed once and each round
    updates the table by the recurrence of the linkage, so that it shrinks. Names, weights and nearest clusters are all that the driver sees.
    """
    spark = nodes.sparkSession

    def points(block: pa.Table) -> pa.Table:
        side = _by_id(frame_of(block))
        d = _first_dists(side["features"], side["features"], side["w"], side["w"], metric, linkage, same=True)
        return _edge_table(_one_by_one(side["id_n"], side["w"], d, linkage, 0))

    if n <= max(finish, 1):
        return cut_lineage(nodes.select("id", "features", "w").groupBy().applyInArrow(points, _EDGES))
    head = nodes.select("id", "w").toArrow()
    order = np.argsort(head.column("id").to_numpy())
    ids, w = head.column("id").to_numpy()[order], head.column("w").to_numpy()[order]
    merges: list[tuple] = []
    rnd = 0
    units, apart = nodes.select("id", "features", "w", F.col("id").alias("cid")), metric
    if n > max(TABLED, finish):
        units, apart, ids, w, merges, rnd = _measured_rounds(nodes, ids, w, metric, linkage, blocks, max(TABLED, finish))
    with _batches_of(spark, len(ids)):
        rows = cut_lineage(_distance_rows(units, ids, apart, linkage, blocks))
    while len(ids) > max(finish, 1):
        a, b, h = _mutual(ids, rows.select("cid", "other", "d").toArrow())
        merges += zip(ids[a].tolist(), ids[b].tolist(), h.tolist(), [rnd] * len(a))
        stay = np.setdiff1d(np.arange(len(ids)), b)
        w_new = w.copy()
        w_new[a] += w[b]
        w_new = w_new[stay]
        if len(stay) > 1:
            state = spark.sparkContext.broadcast({"ids": ids, "w": w, "a": a, "b": b, "h": h, "stay": stay, "w_new": w_new})
            with _batches_of(spark, len(ids)):
                rows = cut_lineage(_after(rows, state, linkage))
            state.destroy()
        ids, w, rnd = ids[stay], w_new, rnd + 1
    total = spark.createDataFrame(_edge_table(merges), _EDGES)
    if len(ids) < 2:
        return total

    def rest(block: pa.Table) -> pa.Table:
        order = np.argsort(block.column("cid").to_numpy())
        d = _matrix(block.column("dist"), len(ids))[order]
        return _edge_table(_one_by_one(ids, w, np.triu(d, 1) + np.triu(d, 1).T, linkage, rnd))

    return cut_lineage(total.unionByName(rows.select("cid", "dist").groupBy().applyInArrow(rest, _EDGES)))


def _measured_rounds(nodes, ids, w, metric, linkage, blocks, until):
    """Rounds of merges until ``until`` clusters are left; each measures clusters that merged or whose nearest did: (rows of the clusters (id, features, w, cid), their
    metric, names, weights, merges, next round).

    Ward distances are those of centroids, and the mean cosine distance of two clusters is one minus the product of the means of their unit
    vectors, so that these have a row per cluster. The others keep all rows.
    """
    spark = nodes.sparkSession
    central = linkage == "ward" or (linkage, metric) == ("average", "cosine")
    units = nodes.select("id", "features", "w", F.col("id").alias("cid"))
    if metric == "cosine":  # a zero vector is at distance 1 from everything
        norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, v: s + v * v))
        units = units.withColumn("features", F.when(norm > 0, F.transform("features", lambda v: v / norm)).otherwise(F.col("features")))
        metric = "unit"
    units = points = cut_lineage(units)
    names, home = ids, np.arange(len(ids))  # of the rows: their cluster
    cores, row_bytes = spark.sparkContext.defaultParallelism, 8 * (nodes.select(F.size("features")).first()[0] + 3)
    pair_blocks = max(blocks, min(math.ceil(math.sqrt(8 * cores)), len(ids) // TABLE_ROWS))
    merges, rnd, height = [], 0, np.zeros(len(ids))
    other, d, open_ = np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.ones(len(ids), bool)
    while len(ids) > until:
        asked = int(open_.sum() if central else open_[home].sum())
        if asked * row_bytes > BROADCAST_BYTES or 2 * asked > len(names if not central else ids):
            found = _nearest_clusters(units, metric, linkage, pair_blocks)
        else:
            of = spark.createDataFrame(pa.table({"cid": ids[open_]}))
            found = _nearest_of_few(units, units.join(of, "cid", "left_semi").toArrow(), metric, linkage, max(blocks, 2 * cores))
        found = found.toArrow()
        at = np.searchsorted(ids, found.column("cid").to_numpy())
        other[at], d[at] = found.column("other").to_numpy(), found.column("d").to_numpy()
        a, b, h = _mutual(ids, pa.table({"cid": ids, "other": other, "d": d}))
        height[a] = h = np.maximum(h, np.maximum(height[a], height[b]))  # a merge is no lower than those before it, whatever the rounding
        merges += zip(ids[a].tolist(), ids[b].tolist(), h.tolist(), [rnd] * len(a))
        joined = np.zeros(len(ids), bool)
        joined[a] = joined[b] = True
        open_ = joined | joined[np.searchsorted(ids, other)]  # a merged cluster is no nearer than both its parts, so that the others keep theirs
        stay = np.setdiff1d(np.arange(len(ids)), b)
        to = np.arange(len(ids))
        to[b] = a
        home = np.searchsorted(stay, to[home])
        w[a] += w[b]
        if central:
            units = cut_lineage(_united(units, ids[a], ids[b]))
        else:
            of = spark.createDataFrame(pa.table({"id": names, "cid": ids[stay][home]}))  # 16 bytes a row
            units = points.drop("cid").join(of, "id")
        ids, w, height, other, d, open_, rnd = ids[stay], w[stay], height[stay], other[stay], d[stay], open_[stay], rnd + 1
        log.info("%s linkage: %d clusters after round %d, %d rows asked", linkage, len(ids), rnd, asked)
    return units, metric, ids, w, merges, rnd
