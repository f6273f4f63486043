"""Packed feature blocks: the unit every iterative fit scans.

Rows (id, features) are packed once into one matrix per Arrow batch and persisted. A pass sends
a small model to the tasks and brings back sums, maxima or best rows; data rows never move, and no
lineage grows between passes. Losing an executor only repacks its blocks from the source. Sparse vectors (see ``linalg.SPARSE``)
are packed without their zeros.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clusterloom.functions import linalg

BLOCK_BYTES = 512 << 10  # upper size of one packed matrix: the intermediate results of a pass stay in the processor's cache
SPARSE_BLOCK_BYTES = 4 << 20  # the same without zeros, where each block costs sums as wide as the table
GATHER_BYTES = 16 << 20  # rows of several Arrow batches are cut into blocks together
PARTITION_BYTES = 64 << 20  # partitions are merged towards this size
DRIVER_BYTES = 32 << 20  # partial results above this are reduced on executors
BROADCAST_BYTES = 64 << 20  # data above this is never sent whole to every task
SLOT = 4096  # partial vectors travel in pieces of this many numbers


def is_sparse(df: DataFrame, features: str = "features") -> bool:
    return isinstance(df.schema[features].dataType, StructType)


def vectors(df: DataFrame, features: str = "features"):
    """The feature column: sparse vectors as they are, anything else as an array of doubles."""
    return F.col(features) if is_sparse(df, features) else F.col(features).cast("array<double>")


def gathered(batches):
    """The rows of Arrow batches in batches of about ``GATHER_BYTES``: Spark hands over a fixed number of rows, which are few bytes of a narrow table."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.get_total_buffer_size()
        if size >= GATHER_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def slot_batch(slots: list[int], v: np.ndarray) -> pa.RecordBatch:
    """Numbers in pieces of ``SLOT``, or in one piece, without an object for each."""
    ends = [*range(0, len(v), SLOT)] if len(slots) > 1 else [0] * len(slots)
    lists = pa.ListArray.from_arrays(pa.array([*ends, len(v)], pa.int32()), pa.array(v, pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), lists], names=["slot", "v"])


@dataclass
class Best:
    """Winning row of one slot of a best-row pass."""

    value: float
    id: object
    features: np.ndarray


class Blocks:
    """Packed, persisted view of ``df(id, features)``."""

    def __init__(self, df: DataFrame, id_col: str = "id", features: str = "features"):
        self.spark = df.sparkSession
        self.rows = df.select(F.col(id_col).alias("id"), vectors(df, features).alias("features"))
        self.id_type = self.rows.schema["id"].dataType.simpleString()
        packed = self._pack(self.rows)
        cores = self.spark.sparkContext.defaultParallelism
        self.df = packed.persist(StorageLevel.MEMORY_AND_DISK)
        s = self._shape()
        target = max(cores, -(-int(s["n"] or 0) * int(s["d"] or 0) * 8 // PARTITION_BYTES))
        placed = None
        if s["parts"] > 2 * target:
            placed = packed.coalesce(target)  # many small partitions: fewer tasks per pass, no shuffle
        elif s["parts"] < cores and s["n"] and s["blocks"] > s["parts"]:
            placed = packed.repartition(min(cores, s["blocks"]))
        if placed is not None:
            old, self.df = self.df, placed.persist(StorageLevel.MEMORY_AND_DISK)
            s = self._shape()
            old.unpersist()
        self.n, self.d, self.parts = int(s["n"] or 0), int(s["d"] or 0), max(1, int(s["parts"]))
        if s["d"] != s["d_min"]:
            raise ValueError("feature vectors differ in length")

    def _shape(self):
        return self.df.select("n", "d", F.spark_partition_id().alias("p")).agg(
            F.sum("n").alias("n"), F.max("d").alias("d"), F.min("d").alias("d_min"), F.count("*").alias("blocks"),
            F.count_distinct("p").alias("parts"),
        ).first()

    def _pack(self, rows: DataFrame) -> DataFrame:
        spread = max(1, self.spark.sparkContext.defaultParallelism)

        def pack(batches):
            schema = None
            for b in gathered(batches):
                x = linalg.rows_of(b.column("features"))
                ids = b.column("id")
                dense = isinstance(x, np.ndarray)
                row_bytes = 8 * max(1, x.shape[1]) if dense else 8 + 12 * max(1, len(x.values) // max(1, len(x)))
                step = max(1, min((BLOCK_BYTES if dense else SPARSE_BLOCK_BYTES) // row_bytes, -(-len(x) // spread) if len(x) > 512 else 512))
                schema = schema or pa.schema([("ids", pa.list_(ids.type)), ("x", pa.binary()), ("n", pa.int32()), ("d", pa.int32())])
                cuts = list(range(0, len(x), step))
                for s in cuts:
                    part = x[s : s + step]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), ids.slice(s, len(part))),
                            pa.array([part.tobytes()], pa.binary()),
                            pa.array([len(part)], pa.int32()),
                            pa.array([x.shape[1]], pa.int32()),
                        ],
                        schema=schema,
                    )

        return rows.mapInArrow(pack, f"ids array<{self.id_type}>, x binary, n int, d int")

    def unpersist(self) -> None:
        self.df.unpersist()

    def bytes(self) -> int:
        return self.n * self.d * 8

    # -- passes ---------------------------------------------------------------------------

    def sums(self, fn: Callable, size: int, maxima: int = 0):
        """Sum ``fn(x) -> vector`` over all blocks; with ``maxima`` fn returns (vector, vector to max)."""

        def partial(batches):
            total, top = np.zeros(size), np.full(maxima, -np.inf)
            for b in batches:
                for buf, n in zip(b.column("x"), b.column("n").to_pylist()):
                    out = fn(linalg.unpack(buf.as_buffer(), n))
                    if maxima:
                        total += out[0]
                        np.maximum(top, out[1], out=top)
                    else:
                        total += out
            yield slot_batch(list(range(-(-size // SLOT))), total)
            if maxima:
                yield slot_batch([-1], top)

        parts = self.df.select("x", "n").mapInArrow(partial, "slot int, v array<double>")
        total, top = np.zeros(size), np.full(maxima, -np.inf)
        if self.parts * (size + maxima) * 8 > DRIVER_BYTES:
            summed = (
                parts.where("slot >= 0").groupBy("slot")
                .agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("v")))).alias("v"))
            )
            if maxima:
                peak = (
                    parts.where("slot < 0").select(F.posexplode("v").alias("pos", "m")).groupBy("pos").agg(F.max("m").alias("m"))
                )
                for r in peak.collect():
                    top[r["pos"]] = r["m"]
            parts = summed
        table = parts.toArrow()
        for slot, v in zip(table.column("slot").to_pylist(), table.column("v")):
            v = v.values.to_numpy(zero_copy_only=False)
            if slot < 0:
                np.maximum(top, v, out=top)
            else:
                total[slot * SLOT : slot * SLOT + len(v)] += v
        return (total, top) if maxima else total

    def running(self, slots: int) -> Running:
        return Running(self, slots)

    def best(self, fn: Callable, slots: int, df: DataFrame | None = None) -> list[Best | None]:
        """Per slot the row with the largest value, smallest id on ties.

        ``fn(x, ids) -> (slots, n)`` scores; -inf leaves a row out. With ``df``, blocks that carry numbers, the score is what they carry.
        """
        id_type, carries = self.id_type, df is not None

        def partial(batches):
            found: dict[int, tuple] = {}
            for b in batches:
                carried = b.column("m") if carries else [None] * b.num_rows
                for buf, n, ids, m in zip(b.column("x"), b.column("n").to_pylist(), b.column("ids"), carried):
                    x, ids = linalg.unpack(buf.as_buffer(), n), ids.values
                    score = linalg.unpack(m.as_buffer(), slots) if carries else fn(x, ids)
                    for s in range(slots):
                        top = score[s].max()
                        if top == -np.inf:
                            continue
                        tied = np.nonzero(score[s] == top)[0]
                        names = ids.take(pa.array(tied)).to_pylist()
                        j = min(range(len(tied)), key=names.__getitem__)
                        if s not in found or (-top, names[j]) < (-found[s][0], found[s][1]):
                            found[s] = (float(top), names[j], x[tied[j]].tolist())
            if found:
                keys = list(found)
                yield pa.RecordBatch.from_pydict(
                    {
                        "slot": pa.array(keys, pa.int32()),
                        "value": pa.array([found[s][0] for s in keys], pa.float64()),
                        "id": pa.array([found[s][1] for s in keys]),
                        "features": pa.array([found[s][2] for s in keys], pa.list_(pa.float64())),
                    }
                )

        source = self.df.select("x", "n", "ids") if df is None else df
        parts = source.mapInArrow(partial, f"slot int, value double, id {id_type}, features array<double>")
        if self.parts * slots * (self.d + 4) * 8 > DRIVER_BYTES:
            parts = (
                parts.groupBy("slot")
                .agg(F.min_by(F.struct("value", "id", "features"), F.struct(-F.col("value"), F.col("id"))).alias("b"))
                .select("slot", "b.*")
            )
        out: list[Best | None] = [None] * slots
        for r in parts.collect():
            held = out[r["slot"]]
            if held is None or (-r["value"], r["id"]) < (-held.value, held.id):
                out[r["slot"]] = Best(r["value"], r["id"], np.array(r["features"]))
        return out

    def per_row(self, fn: Callable, column: str, ddl: str, arrow_type: pa.DataType) -> DataFrame:
        """DataFrame(id, column): ``fn(x, ids)`` gives one value (or one list) for each row."""

        def emit(batches):
            for b in batches:
                for buf, n, ids in zip(b.column("x"), b.column("n").to_pylist(), b.column("ids")):
                    ids = ids.values
                    out = fn(linalg.unpack(buf.as_buffer(), n), ids)
                    if out.ndim == 2:
                        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * out.shape[1])
                        col = pa.ListArray.from_arrays(offsets, pa.array(out.ravel(), arrow_type.value_type))
                    else:
                        col = pa.array(out, arrow_type)
                    yield pa.RecordBatch.from_arrays([ids, col], names=["id", column])

        return self.df.select("x", "n", "ids").mapInArrow(emit, f"id {self.id_type}, {column} {ddl}")


class Running:
    """Blocks that carry a number per slot and row from pass to pass, as the least distance so far: each step is one scan that measures what is new."""

    def __init__(self, blocks: Blocks, slots: int):
        self.blocks, self.slots, self.df = blocks, slots, None

    def step(self, fn: Callable) -> list[Best | None]:
        """``fn(x, ids, m) -> (slots, n)`` makes the new numbers of the old ones (None at the first step); the best row of each slot by them."""
        old, slots, carries = self.df, self.slots, self.df is not None
        source = self.blocks.df.select("x", "n", "ids") if old is None else old

        def advance(batches):
            for b in batches:
                out = []
                carried = b.column("m") if carries else [None] * b.num_rows
                for buf, n, ids, m in zip(b.column("x"), b.column("n").to_pylist(), b.column("ids"), carried):
                    x = linalg.unpack(buf.as_buffer(), n)
                    out.append(np.ascontiguousarray(fn(x, ids.values, None if m is None else linalg.unpack(m.as_buffer(), slots)), dtype=float).tobytes())
                yield pa.RecordBatch.from_arrays([b.column("x"), b.column("n"), b.column("ids"), pa.array(out, pa.binary())], names=["x", "n", "ids", "m"])

        self.df = source.mapInArrow(advance, f"x binary, n int, ids array<{self.blocks.id_type}>, m binary").persist(StorageLevel.MEMORY_AND_DISK)
        found = self.blocks.best(None, slots, self.df)
        if old is not None:
            old.unpersist()
        return found

    def close(self) -> None:
        if self.df is not None:
            self.df.unpersist()
