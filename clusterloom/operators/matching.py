"""One-to-one matching of clusters to classes with the largest total overlap.

The contingency table is counted on Spark and stays there. The larger side is dealt into blocks; a block matches its part with the whole smaller
side and keeps what it has matched. What a part leaves out, the whole leaves out too: matchings choose their members like a firm whose
workers are substitutes, and the rule for ties makes the choice unique. So rounds of blocks narrow the larger side until one block of at most twice the
smaller side is left, which is matched for good.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from clusterloom.operators.evaluate import contingency
from clusterloom.session import cut_lineage

#: Members of the larger side in one block; never less than twice the smaller side.
BLOCK = 512


def _heaviest(gain: np.ndarray):
    """(column of each row, duals of rows and columns) of a heaviest matching that covers all rows (rows <= columns, integers):
    shortest augmenting paths, a row of the table at a time."""
    rows, cols = gain.shape
    u, v, owner = np.zeros(rows + 1, np.int64), np.zeros(cols + 1, np.int64), np.zeros(cols + 1, np.int64)
    far = np.iinfo(np.int64).max
    for r in range(1, rows + 1):
        owner[0], at = r, 0
        slack, came, done = np.full(cols + 1, far), np.zeros(cols + 1, np.int64), np.zeros(cols + 1, bool)
        while owner[at]:
            done[at] = True
            row = owner[at]
            cost = -gain[row - 1] - u[row] - v[1:]
            nearer = ~done[1:] & (cost < slack[1:])
            slack[1:][nearer], came[1:][nearer] = cost[nearer], at
            to = 1 + int(np.argmin(np.where(done[1:], far, slack[1:])))
            step = slack[to]
            u[owner[done]] += step
            v[done] -= step
            slack[1:][~done[1:] & (slack[1:] < far)] -= step
            at = to
        while at:
            owner[at] = owner[came[at]]
            at = came[at]
    pick = np.zeros(rows, np.int64)
    for c in np.flatnonzero(owner[1:]):
        pick[owner[1 + c] - 1] = c
    return pick, -u[1:], -v[1:]


def first_best(gain: np.ndarray) -> list[int | None]:
    """Class of each cluster (rows of ``gain``; integers from 0) with the largest sum, in as many pairs as the smaller side has members.

    Of all such matchings the one in which the first cluster has the least class (none is the largest), then the second, and so on. The
    duals of one heaviest matching show which pairs any of them can use, so that each cluster in turn moves along alternating paths of those.
    """
    n, k = gain.shape
    if n <= k:
        pick, pi, price = _heaviest(gain)
        match = [int(c) for c in pick]
    else:
        pick, price, pi = _heaviest(gain.T)
        match = [None] * n
        for c, i in enumerate(pick):
            match[i] = c
    tight = gain == pi[:, None] + price[None, :]
    owner = np.full(k, -1)
    for i, c in enumerate(match):
        if c is not None:
            owner[c] = i
    for i in range(n):
        now = match[i]
        better = [int(c) for c in np.flatnonzero(tight[i][:now]) if owner[c] < 0 or owner[c] > i]
        if not better:
            continue
        later = [x for x in range(i + 1, n) if match[x] is not None]
        if now is None:
            round_, chain, ends = {}, [], {x: None for x in later if pi[x] == 0}
        else:
            round_, chain = {x: now for x in later if tight[x, now]}, _refilled(now, i, match, owner, tight, price)
            free = np.flatnonzero(owner < 0)
            ends = {} if chain is None else {x: None for x in later if pi[x] == 0} if n > k else {x: int(free[np.argmax(tight[x, free])]) for x in later if tight[x, free].any()}
        round_, ends = (_reaching(way, later, match, tight) for way in (round_, ends))
        for to in better:
            if owner[to] in round_:  # a cycle that ends where the cluster was
                _moved(i, to, round_, match, owner)
                break
            if chain is not None and (owner[to] in ends or owner[to] < 0):  # a way to a free place, and others fill the old one
                _moved(i, to, ends, match, owner)
                for x, c in chain:
                    match[x], owner[c] = c, x
                break
    return match


def _reaching(way: dict, later: list[int], match: list, tight: np.ndarray) -> dict:
    """Where each later cluster could go if it had to make room: to an end, or to the class of one that could go on."""
    fresh = list(way)
    while fresh:
        opened = np.array([match[x] for x in fresh])
        fresh = [x for x in later if x not in way and tight[x, opened].any()]
        for x in fresh:
            way[x] = int(opened[np.argmax(tight[x, opened])])
    return way


def _refilled(now: int, i: int, match: list, owner: np.ndarray, tight: np.ndarray, price: np.ndarray):
    """[(cluster, class), ...] that fills class ``now`` if cluster ``i`` leaves it; empty if it may stay free; None if there is no way."""
    n, k = tight.shape
    came, waiting = {now: None}, [now]
    for c in waiting:
        end = None
        if n < k and price[c] == 0:
            end = []
        elif n > k:
            end = next(([(x, c)] for x in range(i + 1, n) if match[x] is None and tight[x, c]), None)
        if end is not None:
            while came[c] is not None:  # the cluster that leaves c for the class before it
                x, before = came[c]
                end.append((x, before))
                c = before
            return end[::-1]
        for x in range(i + 1, n):
            if match[x] is not None and match[x] not in came and tight[x, c]:
                came[match[x]] = (x, c)
                waiting.append(match[x])
    return None


def _moved(i: int, to: int, way: dict, match: list, owner: np.ndarray) -> None:
    """Cluster ``i`` takes class ``to``; who had it goes its way, and so on."""
    if match[i] is not None:
        owner[match[i]] = -1
    while True:
        match[i], out, owner[to] = to, int(owner[to]), i
        if out < 0:
            return
        i, to = out, way[out]
        if to is None:
            match[i] = None
            return


def _by_value(values) -> list:
    return sorted(set(values), key=lambda v: (v is not None, v))


def _solved(block: pa.Table):
    """(clusters, classes, counts by cluster and class, class of each cluster) of one block."""
    cells = list(zip(*(block.column(c).to_pylist() for c in ("cluster", "label", "n"))))
    clusters, classes = _by_value(c for c, _, _ in cells), _by_value(j for _, j, _ in cells)
    row, col = ({v: i for i, v in enumerate(side)} for side in (clusters, classes))
    gain = np.zeros((len(clusters), len(classes)), np.int64)
    for c, j, m in cells:
        if m:
            gain[row[c], col[j]] += m
    return clusters, classes, gain, first_best(gain)


def _narrowed(table: DataFrame, large: str, small: str, blocks: int, seed: int) -> DataFrame:
    """``table`` with those members of the larger side that their block matches."""
    member = table.schema[large]
    dealt = table.withColumn("_b", F.pmod(F.xxhash64(F.lit(seed), large), F.lit(blocks)).cast("int"))
    # every block sees the whole smaller side, also members that it shares no row with
    every = table.select(small).distinct().withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    one = dealt.groupBy("_b").agg(F.min(F.struct(large)).alias("m")).select("_b", f"m.{large}")
    empty = every.join(one, "_b").select("cluster", "label", F.lit(0).cast("bigint").alias("n"), "_b")
    out = to_arrow_schema(StructType([member]))

    def keep(block: pa.Table) -> pa.Table:
        clusters, classes, _, match = _solved(block)
        kept = [c for c, j in zip(clusters, match) if j is not None] if large == "cluster" else [classes[j] for j in match if j is not None]
        return pa.table({large: pa.array(kept, out.field(0).type)}, schema=out)

    kept = dealt.select("cluster", "label", "n", "_b").unionByName(empty).groupBy("_b").applyInArrow(keep, StructType([member]))
    kept = kept.withColumnRenamed(large, "_kept")
    return cut_lineage(table.join(kept, F.col(large).eqNullSafe(F.col("_kept")), "left_semi"))


def match_clusters(table: DataFrame, block: int = BLOCK) -> DataFrame:
    """(cluster, matched, overlap) from a contingency table (label, cluster, n).

    Every cluster gets a different class or, when clusters outnumber classes, none (null). Ties go to
    the smaller class of the earlier cluster. A null cluster or class is one of its own, before all others.
    """
    table = rest = cut_lineage(table.select("cluster", "label", F.col("n").cast("bigint").alias("n")))
    seed = 0
    while True:
        s = rest.agg(F.count_distinct(F.struct("cluster")).alias("n"), F.count_distinct(F.struct("label")).alias("k")).first()
        size = max(2 * min(s["n"], s["k"]), block)
        if max(s["n"], s["k"]) <= size:
            break
        large, small = ("cluster", "label") if s["n"] > s["k"] else ("label", "cluster")
        rest = _narrowed(rest, large, small, -(-max(s["n"], s["k"]) // size), seed)
        seed += 1
    schema = StructType([table.schema["cluster"], StructField("matched", table.schema["label"].dataType), StructField("overlap", LongType())])
    out = to_arrow_schema(schema)

    def final(part: pa.Table) -> pa.Table:
        clusters, classes, gain, match = _solved(part)
        cols = clusters, [None if j is None else classes[j] for j in match], [0 if j is None else int(gain[i, j]) for i, j in enumerate(match)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    found = rest.groupBy().applyInArrow(final, schema)
    if rest is table:
        return found
    found = found.withColumnRenamed("cluster", "_c")
    every = table.select("cluster").distinct().join(found, F.col("cluster").eqNullSafe(F.col("_c")), "left")
    return every.select("cluster", "matched", F.coalesce("overlap", F.lit(0)).cast("bigint").alias("overlap"))


def relabel(df: DataFrame, matches: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Replace every cluster id by its matched class; ``matches`` has one row per cluster."""
    m = matches.select(F.col("cluster").alias("_c"), F.col("matched"))
    return df.join(m, df[cluster] == m["_c"], "left").drop("_c")


def matched_confusion(df: DataFrame, label: str = "label", cluster: str = "cluster") -> DataFrame:
    """(label, matched, n): confusion of classes with matched clusters, without touching the rows twice."""
    table = contingency(df, label, cluster)
    return relabel(table, match_clusters(table)).groupBy("label", "matched").agg(F.sum("n").alias("n"))
