"""Block-pair pass for all-pairs work.

Rows are hashed by id into blocks of bounded size and every pair of blocks meets in one task,
where the pair values are reduced at once. No row pairs are emitted or stored; a row is copied
once per block, so traffic is rows x blocks and the block size is chosen by bytes.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.functions import linalg

BLOCK_BYTES = 32 << 20
#: A task evaluates pairs tile by tile: a matrix of pair values holds TILE_ROWS x TILE_ROWS doubles (32 MiB), whatever the block size.
TILE_ROWS = 2048
SLACK = 1e-9  # of bounds, against rounding


def block_count(rows: int, width: int, cores: int) -> int:
    """Enough blocks that one holds BLOCK_BYTES at most and all cores get pairs."""
    by_size = math.ceil(rows * (width + 4) * 8 / BLOCK_BYTES)
    by_cores = min(math.ceil(math.sqrt(2 * cores)), max(1, rows // 256))
    return max(1, by_size, by_cores)


def frame_of(batch) -> dict:
    """Columns of an Arrow table as arrays; the list column becomes a matrix."""
    out = {}
    for name in batch.column_names:
        col = batch.column(name).combine_chunks()
        if pa.types.is_list(col.type):
            out[name] = linalg.rows_of(col)
        elif name == "id":
            out[name] = col
        else:
            out[name] = col.to_numpy(zero_copy_only=False)
    return out


def tiles(left: dict, right: dict, same: bool, left_cuts=None, right_cuts=None):
    """(left tile, right tile, same) of two blocks: every pair of rows once; ``same`` blocks give each unordered pair of tiles.

    Tiles begin at the given cuts (first 0, last the number of rows), or every ``TILE_ROWS`` rows.
    """

    def cut(side, cuts):
        n = len(side["features"])
        cuts = range(0, n + TILE_ROWS, TILE_ROWS) if cuts is None else cuts
        return [{c: v[a:b] for c, v in side.items()} for a, b in zip(cuts[:-1], cuts[1:]) if a < n]

    ones = cut(left, left_cuts)
    others = ones if same else cut(right, right_cuts)
    for i, one in enumerate(ones):
        for j in range(i if same else 0, len(others)):
            yield one, others[j], same and i == j


@dataclass
class Balls:
    """Rows grouped round centres: ``rows`` has ``_b``, the block of a row. A large ball has several blocks."""

    rows: DataFrame
    centres: np.ndarray  # of each block
    radius: np.ndarray  # largest distance of a row to the centre of its block
    count: np.ndarray  # rows of each block

    def between(self) -> np.ndarray:
        return np.sqrt(linalg.direct_dists(self.centres, self.centres, "euclidean"))

    def farthest(self) -> np.ndarray:
        """Upper bounds of the distance of any two rows, by block and block."""
        return (self.between() + self.radius[:, None] + self.radius[None, :]) * (1 + SLACK)

    def nearest(self) -> np.ndarray:
        """Lower bounds of the distance of any two rows, by block and block."""
        return np.maximum(self.between() * (1 - SLACK) - self.radius[:, None] - self.radius[None, :], 0.0)

    def copies(self, met: np.ndarray) -> int:
        """Rows sent if the pairs of blocks in the symmetric matrix ``met`` meet."""
        return int((self.count * met.sum(axis=1)).sum())


def balls(df: DataFrame, centres: np.ndarray, by: str = "features", block_bytes: int = BLOCK_BYTES) -> Balls:
    """Group rows (id, ``by``, ...) by their nearest centre (Euclidean), in blocks of about ``block_bytes``. ``df`` should be cheap to read: it is
    read twice."""
    centres = np.asarray(centres, float)

    @F.arrow_udf("struct<ball: int, reach: double>")
    def nearest(x: pa.Array) -> pa.Array:
        rows = linalg.rows_of(x)
        best, d = linalg.nearest(rows, centres, "euclidean") if len(rows) else (np.zeros(0, int), np.zeros(0))
        return pa.StructArray.from_arrays([pa.array(best, pa.int32()), pa.array(np.sqrt(d))], ["ball", "reach"])

    placed = df.withColumn("_n", nearest(by))
    found = placed.groupBy("_n.ball").agg(F.count("*").alias("n"), F.max("_n.reach").alias("r")).collect()  # a row per centre
    width = 8 * (centres.shape[1] + 4)
    parts = [max(1, math.ceil(r["n"] * width / block_bytes)) for r in found]
    first = np.concatenate(([0], np.cumsum(parts))).astype(int)
    of = {r["ball"]: (int(f), p) for r, f, p in zip(found, first, parts)}
    code = F.create_map(*[F.lit(v) for ball, (f, p) in of.items() for v in (ball, F.struct(F.lit(f).alias("f"), F.lit(p).alias("p")))]) if of else None
    if code is None:
        return Balls(df.withColumn("_b", F.lit(0)), centres[:0], np.zeros(0), np.zeros(0))
    spot = code[F.col("_n.ball")]
    rows = placed.withColumn("_b", (spot["f"] + F.pmod(F.xxhash64("id"), spot["p"])).cast("int")).drop("_n")
    repeat = lambda v: np.repeat(np.array(v, float), parts)
    return Balls(rows, np.repeat(centres[[r["ball"] for r in found]], parts, axis=0), repeat([r["r"] for r in found]) * (1 + SLACK), repeat([r["n"] / p for r, p in zip(found, parts)]))


def block_pairs(df: DataFrame, fn: Callable, schema: str, block_key: str = "id", blocks: int | None = None, met: np.ndarray | None = None) -> DataFrame:
    """Run ``fn(left, right, same) -> [RecordBatch]`` on every unordered pair of blocks.

    ``df`` has ``id``, ``features`` and any scalar columns. Rows with one ``block_key`` stay in one block. With ``met``, a symmetric matrix of
    flags, blocks are given as ``_b`` and only flagged pairs meet; no row is sent to another.
    """
    if met is not None:
        lo, hi = np.nonzero(np.triu(met))
        both = pa.table({"_b": np.concatenate([lo, hi[hi != lo]]).astype(np.int32), "_lo": np.concatenate([lo, lo[hi != lo]]).astype(np.int32), "_hi": np.concatenate([hi, hi[hi != lo]]).astype(np.int32)})
        ways = df.sparkSession.createDataFrame(both, "_b int, _lo int, _hi int")  # as many rows as there are block pairs
        return _run_pairs(df.join(F.broadcast(ways), "_b"), [c for c in df.columns if c != "_b"], fn, schema)
    if blocks is None:
        s = df.agg(F.count("*").alias("n"), F.max(F.size("features")).alias("d")).first()
        blocks = block_count(s["n"], s["d"] or 1, df.sparkSession.sparkContext.defaultParallelism)
    cols = df.columns
    blocked = df.withColumn("_b", F.pmod(F.xxhash64(block_key), F.lit(blocks)).cast("int"))
    met = blocked.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumns(
        {"_lo": F.least("_b", "_o"), "_hi": F.greatest("_b", "_o")}
    ).drop("_o")
    return _run_pairs(met, cols, fn, schema)


def _run_pairs(met: DataFrame, cols: list[str], fn: Callable, schema: str) -> DataFrame:
    def run(key, table):
        lo, hi = key[0].as_py(), key[1].as_py()
        side = table.column("_b").to_numpy()
        body = table.select(cols)
        order = np.argsort(side, kind="stable")
        body = body.take(pa.array(order))
        cut = int((side == lo).sum())
        left = frame_of(body.slice(0, cut))
        right = left if lo == hi else frame_of(body.slice(cut))
        if not len(left["id"]) or not len(right["id"]):
            return pa.table({}, schema=empty)
        found = [b for b in fn(left, right, lo == hi) if b.num_rows]
        return pa.Table.from_batches(found).cast(empty) if found else pa.Table.from_batches([], schema=empty)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    empty = to_arrow_schema(StructType.fromDDL(schema))
    return met.groupBy("_lo", "_hi").applyInArrow(run, schema)
