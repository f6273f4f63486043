"""K-Means started from the farthest pair of points and MaxMin seeding.

The farthest pair does not depend on k, and the seeding scans serve every k at once, so a sweep
over k costs little more than one fit.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.functions import linalg
from clusterloom.operators.blocks import Blocks
from clusterloom.operators.kmeans import KMeansModel, KMeansSpec, fit_many, random_rows
from clusterloom.operators.pairs import balls, block_count, block_pairs
from clusterloom.operators.selection import COLLECTED, order_statistics
from clusterloom.session import cut_lineage

SWEEPS = 4
PIVOTS_SLACK = 1e-9
BALLS = 64
TIED = 1 << 15  # pairs within rounding of the top that are compared at once

log = logging.getLogger(__name__)


@dataclass
class FarthestPair:
    id_a: object
    id_b: object
    a: np.ndarray
    b: np.ndarray
    distance: float


def farthest_pair(data: DataFrame | Blocks) -> FarthestPair:
    """The two rows with the largest Euclidean distance; smallest (id, id) on ties. Exact.

    Sweeps (farthest from the mean, farthest from that, ...) give a lower bound L. A row x can be
    in a pair at distance >= L only if d(x, p) + max d(., p) >= L for every pivot p, so the pair
    pass sees the few rows that pass, with equal copies collapsed. They are grouped in balls, and balls whose
    centres and radii keep all their rows nearer than L do not meet.
    """
    blocks = data if isinstance(data, Blocks) else Blocks(data)
    if blocks.n < 2:
        raise ValueError("a farthest pair needs two rows")
    mean = blocks.sums(lambda x: x.sum(axis=0), blocks.d) / blocks.n
    pivots, radii, low = [mean], [], 0.0
    for step in range(SWEEPS):
        p = pivots[-1]
        far = blocks.best(lambda x, ids: np.sqrt(linalg.direct_dists(x, p[None, :], "euclidean")).T, 1)[0]
        radii.append(far.value)
        if step and far.value <= low:
            break
        low = max(low, far.value) if step else 0.0
        pivots.append(far.features)
    pivots = np.array(pivots[: len(radii)])
    reach = np.array(radii)
    bound = low * (1.0 - PIVOTS_SLACK)

    def may_pair(x, ids):
        d = np.sqrt(linalg.direct_dists(x, pivots, "euclidean"))
        return (d + reach >= bound).all(axis=1)

    survivors = _kept_rows(blocks, may_pair)
    distinct = cut_lineage(survivors.groupBy("features").agg(F.min("id").alias("id")).select("id", "features"))
    id_type = blocks.id_type

    def farthest(left, right, same):
        best = None
        step = max(1, (8 << 20) // max(1, 8 * len(right["id"])))
        x, y = left["features"], right["features"]
        for s in range(0, len(x), step):
            d2 = linalg.sq_dists(x[s : s + step], y)
            top = d2.max()
            if best is not None and top < best[0] * (1 - 1e-9):
                continue
            # candidates within rounding of the top are compared on plain differences
            rows, cols = np.nonzero(d2 >= top * (1 - 1e-9))
            for t in range(0, len(rows), TIED):
                r, c = rows[t : t + TIED], cols[t : t + TIED]
                diff = x[r + s] - y[c]
                exact = np.einsum("ij,ij->i", diff, diff)
                keep = np.nonzero(exact == exact.max())[0]
                a = left["id"].take(pa.array(r[keep] + s)).to_pylist()
                b = right["id"].take(pa.array(c[keep])).to_pylist()
                for i, u, v in zip(keep, a, b):
                    cand = (exact[i], min(u, v), max(u, v))
                    if u != v and (best is None or (-cand[0], cand[1], cand[2]) < (-best[0], best[1], best[2])):
                        best = cand
        if best is None:
            return []
        cols = {"d": pa.array([float(np.sqrt(best[0]))]), "a": pa.array([best[1]]), "b": pa.array([best[2]])}
        return [pa.RecordBatch.from_pydict(cols)]

    plan, rows, met = pair_plan(distinct, bound)
    log.info("farthest pair: %s", plan)
    found = block_pairs(rows, farthest, f"d double, a {id_type}, b {id_type}", blocks=plan.blocks, met=met).orderBy(F.desc("d"), "a", "b").limit(1).collect()
    if found and found[0]["d"] > 0:
        d, a, b = found[0]["d"], found[0]["a"], found[0]["b"]
    else:  # all rows are equal: the first two ids
        a, b = (r["id"] for r in blocks.rows.select("id").orderBy("id").limit(2).collect())
        d = 0.0
    ends = {r["id"]: linalg.vector(r["features"]) for r in blocks.rows.where(F.col("id").isin([a, b])).collect()}
    return FarthestPair(a, b, ends[a], ends[b], d)


@dataclass
class PairPlan:
    """Rows sent by blocks of hashed ids, and by balls of which only those meet that can hold a pair at the bound; the cheaper one runs."""

    rows: int
    blocks: int | None
    hashed_copies: int
    ball_copies: int


def pair_plan(rows: DataFrame, bound: float, n_balls: int = BALLS):
    """(plan, rows to pass to the pair pass, flags of the pairs of blocks to meet or None)."""
    s = rows.agg(F.count("*").alias("n"), F.max(F.size("features")).alias("d")).first()
    n, d = s["n"], s["d"] or 1
    blocks = block_count(n, d, rows.sparkSession.sparkContext.defaultParallelism)
    hashed = n * blocks
    if n < 2 * n_balls:
        return PairPlan(n, blocks, hashed, hashed), rows, None
    around = balls(rows, np.array([f for _, f in random_rows(rows, n_balls, 0)]))
    met = around.farthest() >= bound
    plan = PairPlan(n, blocks, hashed, around.copies(met))
    return (plan, around.rows, met) if plan.ball_copies < hashed else (plan, rows, None)


def _kept_rows(blocks: Blocks, keep) -> DataFrame:
    """(id, features) of the rows that pass, straight from the packed blocks."""

    def emit(batches):
        for b in batches:
            for buf, n, ids in zip(b.column("x"), b.column("n").to_pylist(), b.column("ids")):
                x, ids = linalg.unpack(buf.as_buffer(), n), ids.values
                at = np.nonzero(keep(x, ids))[0]
                flat = pa.array(np.asarray(x[at]).ravel())
                offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * x.shape[1])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.ListArray.from_arrays(offsets, flat)], names=["id", "features"])

    return blocks.df.select("x", "n", "ids").mapInArrow(emit, f"id {blocks.id_type}, features array<double>")


@dataclass
class SeedGroup:
    """The nearest-t rows of one seed, as a cut: distance < cut, or == cut and id <= last_id (None: all)."""

    count: int
    cut: float = -1.0
    last_id: object = None


def seed_distances(blocks: Blocks, pair: FarthestPair) -> DataFrame:
    """(id, side, dist): the nearer of the two seeds (first on ties) and the distance to it."""
    ends = np.array([pair.a, pair.b])
    d = blocks.per_row(lambda x, ids: np.sqrt(linalg.direct_dists(x, ends, "euclidean")), "d", "array<double>", pa.list_(pa.float64()))
    near = F.when(F.col("d")[0] <= F.col("d")[1], F.lit(0)).otherwise(F.lit(1))
    return d.select("id", near.alias("side"), F.least(F.col("d")[0], F.col("d")[1]).alias("dist"))


def capped_groups(blocks: Blocks, pair: FarthestPair, ks: list[int]) -> dict[int, list[SeedGroup]]:
    """For each k the rows nearest to each seed, at most int(0.5 * N / k) of them, ties by id.

    Instead of sorting half the table into one window, the cut value is found as an order
    statistic, once per distinct cap.
    """
    near = seed_distances(blocks, pair).persist()
    sizes = {r["side"]: r["count"] for r in near.groupBy("side").count().collect()}
    out: dict[int, list[SeedGroup]] = {k: [] for k in ks}
    for side in (0, 1):
        mine = near.where(F.col("side") == side)
        take = {k: min(sizes.get(side, 0), int(0.5 * (blocks.n / k))) for k in ks}
        cuts = order_statistics(mine, "dist", [t - 1 for t in take.values() if t > 0])
        split = {t: cuts[t - 1] for t in take.values() if t > 0 and t - cuts[t - 1].under < cuts[t - 1].at}
        last = _last_ids(mine, {c.value: c for c in split.values()}, {(c.value, t - c.under) for t, c in split.items()})
        for k in ks:
            t = take[k]
            if t == 0:
                out[k].append(SeedGroup(0))
            else:
                c = cuts[t - 1]
                out[k].append(SeedGroup(t, c.value, last.get((c.value, t - c.under))))
    near.unpersist()
    return out


def _last_ids(mine: DataFrame, cuts: dict, wanted: set) -> dict:
    """Id of the need-th tied row, for every (cut, need) where only part of the tied rows is kept."""
    if not wanted:
        return {}
    if sum(c.at for c in cuts.values()) <= COLLECTED:
        ids: dict = {}
        for r in mine.where(F.col("dist").isin(list(cuts))).select("dist", "id").orderBy("dist", "id").collect():
            ids.setdefault(r["dist"], []).append(r["id"])
        return {(cut, need): ids[cut][need - 1] for cut, need in wanted}
    out = {}
    for cut in cuts:
        needs = [n for c, n in wanted if c == cut]
        found = order_statistics(mine.where(F.col("dist") == F.lit(cut)), "id", [n - 1 for n in needs])
        out.update({(cut, n): found[n - 1].value for n in needs})
    return out


def in_group(x: np.ndarray, ids, ends: np.ndarray, groups: list[SeedGroup]):
    """Side (0 or 1) of each row and whether it is among the kept rows of that side."""
    d = np.sqrt(linalg.direct_dists(x, ends, "euclidean"))
    side = np.where(d[:, 0] <= d[:, 1], 0, 1)
    kept = np.zeros(len(x), bool)
    for s, g in enumerate(groups):
        mine = (side == s) & (g.count > 0)
        kept |= mine & (d[:, s] < g.cut)
        edge = np.nonzero(mine & (d[:, s] == g.cut))[0]
        if len(edge):
            names = ids.take(pa.array(edge)).to_pylist()
            kept[edge] = [g.last_id is None or v <= g.last_id for v in names]
    return side, kept


def fekm_centres(data: DataFrame | Blocks, ks: list[int], pair: FarthestPair | None = None) -> dict[int, np.ndarray]:
    """Start centres for every k in ``ks``."""
    if min(ks) < 2:
        raise ValueError("farthest-pair seeding needs at least two clusters")
    blocks = data if isinstance(data, Blocks) else Blocks(data)
    pair = pair or farthest_pair(blocks)
    groups = capped_groups(blocks, pair, ks)
    seeds = seed_means(blocks, pair, groups)
    return maxmin_centres(blocks, pair, groups, seeds)


def seed_means(blocks: Blocks, pair: FarthestPair, groups: dict[int, list[SeedGroup]]) -> dict[int, np.ndarray]:
    """Centres 1 and 2 per k: mean of the kept rows of each side, the seed itself if none."""
    ends, d, ks = np.array([pair.a, pair.b]), blocks.d, list(groups)
    starts = {}

    def emit(batches):
        total = np.zeros((len(ks), 2, 1 + d))
        for b in batches:
            for buf, n, ids in zip(b.column("x"), b.column("n").to_pylist(), b.column("ids")):
                x = linalg.unpack(buf.as_buffer(), n)
                for i, k in enumerate(ks):
                    side, kept = in_group(x, ids.values, ends, groups[k])
                    if kept.any():
                        total[i] += linalg.group_sums(x[kept], side[kept], 2)
        flat = total.reshape(len(ks) * 2, 1 + d)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(range(len(flat)), pa.int32()), "v": pa.array(flat.tolist(), pa.list_(pa.float64()))})

    parts = blocks.df.select("x", "n", "ids").mapInArrow(emit, "slot int, v array<double>")
    sums = parts.select("slot", F.posexplode("v").alias("pos", "v")).groupBy("slot", "pos").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((len(ks) * 2, 1 + d))
    for r in sums:
        total[r["slot"], r["pos"]] = r["v"]
    total = total.reshape(len(ks), 2, 1 + d)
    for i, k in enumerate(ks):
        two = ends.copy()
        filled = total[i, :, 0] > 0
        two[filled] = total[i, filled, 1:] / total[i, filled, :1]
        starts[k] = two
    return starts


def maxmin_centres(blocks: Blocks, pair: FarthestPair, groups: dict[int, list[SeedGroup]], seeds: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Add centres until each k is complete: the remaining row farthest from its nearest centre.

    One scan per added centre for all k together, which measures that centre only: rows carry their least distance, and those of the
    seed groups carry none. If nothing remains, all rows take part.
    """
    ends = np.array([pair.a, pair.b])
    centres = {k: c.copy() for k, c in seeds.items()}
    everyone = {k for k in groups if sum(g.count for g in groups[k]) >= blocks.n}
    names = list(centres)
    run = blocks.running(len(names))
    fresh = {k: c for k, c in centres.items() if len(c) < k}

    def first(x, ids, _):
        out = np.full((len(names), len(x)), -np.inf)
        for i, k in enumerate(names):
            if k in fresh:
                out[i] = np.sqrt(linalg.direct_dists(x, fresh[k], "euclidean").min(axis=1))
                if k not in everyone:
                    out[i][in_group(x, ids, ends, groups[k])[1]] = -np.inf
        return out

    def nearer(x, ids, m):
        out = m.copy()
        for i, k in enumerate(names):
            if k in fresh:
                np.minimum(out[i], np.sqrt(linalg.direct_dists(x, fresh[k], "euclidean")[:, 0]), out=out[i])
        return out

    step = first
    while fresh:
        for k, b in zip(names, run.step(step)):
            if k in fresh:
                centres[k] = np.vstack([centres[k], b.features])
        fresh = {k: c[-1:] for k, c in centres.items() if len(c) < k}
        step = nearer
    run.close()
    return centres


def fit_fekm(data: DataFrame | Blocks, ks: list[int], metrics: list[str] = ("euclidean",), max_iters: int = 300, tol: float = 1e-4) -> dict[tuple[int, str], KMeansModel]:
    """Fit every (k, metric); the start is Euclidean whatever the metric."""
    blocks = data if isinstance(data, Blocks) else Blocks(data)
    starts = fekm_centres(blocks, list(ks))
    specs = [KMeansSpec(k, m, init=starts[k], max_iters=max_iters, tol=tol) for k in ks for m in metrics]
    return {(m.spec.k, m.spec.metric): m for m in fit_many(blocks, specs)}
