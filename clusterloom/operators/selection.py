"""Exact order statistics, exact-size samples and distributed row numbers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clusterloom.functions import columns as C
from clusterloom.session import cut_lineage

COLLECTED = 20_000  # distinct values per narrowing round that may reach the driver
ACCURACY = 10_000
TOP_ROWS = 10_000  # samples up to this size are taken by a top-n


@dataclass(frozen=True)
class Ranked:
    """Value at a rank, how many values lie below it and how many equal it."""

    value: object
    under: int
    at: int


def order_statistics(df: DataFrame, column: str, ranks: list[int]) -> dict[int, Ranked]:
    """The exact values at zero-based ``ranks`` of a non-null column.

    A quantile sketch brackets each rank, counts place the bracket, and the next round looks only
    inside it; once few distinct values are left their counts decide. Every round is an
    aggregate with bounded state, whatever the row count or the number of copies.
    """
    return _solve(df.select(F.col(column).alias("v")), 0, sorted(set(ranks))) if ranks else {}


def _solve(inside: DataFrame, below: int, ranks: list[int]) -> dict[int, Ranked]:
    shape = inside.agg(F.count("*").alias("n"), F.approx_count_distinct("v").alias("u")).first()
    n = shape["n"]
    if ranks[0] < below or ranks[-1] >= below + n:
        raise ValueError(f"ranks {ranks} are beyond the data")
    if shape["u"] <= COLLECTED:
        out, todo = {}, list(ranks)
        for r in inside.groupBy("v").agg(F.count("*").alias("n")).orderBy("v").collect():
            while todo and todo[0] < below + r["n"]:
                out[todo.pop(0)] = Ranked(r["v"], below, r["n"])
            below += r["n"]
        return out
    # ranks close to the first one share its bracket
    reach = max(1, int(n * 4.0 / ACCURACY))
    group = [r for r in ranks if r - ranks[0] <= reach]
    slack = 2.0 / ACCURACY
    p = [(r - below) / n for r in (group[0], group[-1])]
    q = inside.agg(F.percentile_approx("v", [max(0.0, p[0] - slack), min(1.0, p[1] + slack)], ACCURACY)).first()[0]
    low = F.lit(None) if p[0] <= slack else F.lit(q[0])
    high = F.lit(None) if p[1] >= 1 - slack else F.lit(q[1])
    is_low = F.coalesce(F.col("v") < low, F.lit(False))
    is_high = F.coalesce(F.col("v") > high, F.lit(False))
    c = inside.agg(F.count_if(is_low).alias("low"), F.count_if(is_high).alias("high")).first()
    out = {}
    # the sketch error is bounded, but the counts decide on which side each rank really is
    for ranks_in, part, start in (
        ([r for r in group if r < below + c["low"]], is_low, below),
        ([r for r in group if below + c["low"] <= r < below + n - c["high"]], ~is_low & ~is_high, below + c["low"]),
        ([r for r in group if r >= below + n - c["high"]], is_high, below + n - c["high"]),
    ):
        if ranks_in:
            out.update(_solve(inside.where(part), start, ranks_in))
    rest = [r for r in ranks if r not in group]
    if rest:
        out.update(_solve(inside, below, rest))
    return out


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Exact median of each numeric column, nulls and NaN left out; None for an empty column.

    Columns with few distinct values use the built-in median, whose state is one count per value;
    the others are narrowed by :func:`order_statistics`.
    """
    if not columns:
        return {}
    clean = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    shape = df.agg(
        *[F.count(v).alias(f"n_{i}") for i, v in enumerate(clean.values())],
        *[F.approx_count_distinct(v).alias(f"u_{i}") for i, v in enumerate(clean.values())],
    ).first()
    narrow = [c for i, c in enumerate(columns) if shape[f"u_{i}"] <= COLLECTED]
    out: dict[str, float | None] = {}
    if narrow:
        row = df.agg(*[F.median(clean[c]).alias(f"m_{j}") for j, c in enumerate(narrow)]).first()
        out.update({c: row[f"m_{j}"] for j, c in enumerate(narrow)})
    for i, c in enumerate(columns):
        if c not in out:
            n = shape[f"n_{i}"]
            ranks = [(n - 1) // 2, n // 2]
            found = order_statistics(df.select(clean[c].alias("v")).where("v IS NOT NULL"), "v", ranks)
            out[c] = (found[ranks[0]].value + found[ranks[1]].value) / 2.0
    return out


def exact_sample(df: DataFrame, n: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) drawn by seeded hash order: the same rows on any engine.

    A small sample is a bounded top-n. A large one would gather in one task, so its last hash is found
    as an order statistic instead and the rows up to it are filtered in place.
    """
    key = C.hash_order(id_col, seed)
    if n <= TOP_ROWS:
        return df.orderBy(key, F.col(id_col)).limit(n)
    prefix = F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint")  # orders as the hash does
    if df.count() <= n:
        return df
    cut = order_statistics(df.select(prefix.alias("h")), "h", [n - 1])[n - 1]
    tied = df.where(prefix == F.lit(cut.value)).orderBy(key, F.col(id_col)).limit(n - cut.under)
    return df.where(prefix < F.lit(cut.value)).unionByName(tied)


def row_numbers(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Zero-based global position in ``order``, without a single-task window.

    Range partitions are sorted and written once, so that offsets and positions see the same
    split; only one count per partition reaches the driver.
    """
    placed = cut_lineage(df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_p", F.spark_partition_id()))
    sizes = {r["_p"]: r["count"] for r in placed.groupBy("_p").count().collect()}
    offset, pairs = 0, []
    for p in sorted(sizes):
        pairs += [F.lit(p), F.lit(offset)]
        offset += sizes[p]
    if not pairs:
        return placed.drop("_p").withColumn(name, F.lit(0).cast("bigint"))
    local = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return placed.withColumn(name, (F.create_map(*pairs)[F.col("_p")] + local).cast("bigint")).drop("_p")
