"""Helpers of the text operators: tables, shared scratch tables, size-checked joins, connected components."""

from __future__ import annotations

import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from clusterloom.session import shared_dir

#: A side of a join is broadcast only when it was counted and holds at most so many bytes.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends here and a lost executor loses
    nothing. The files go when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/clusterloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path)


def small_or_shuffled(side: DataFrame, row_bytes, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``side`` with a broadcast hint if its rows of ``row_bytes`` (a number, or a column for rows of different sizes) add up to at
    most ``limit``, else unchanged: the join then shuffles both sides, and adaptive execution may split a hot key. ``side`` should be
    a written table, since it is measured."""
    total = side.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0] or 0
    return F.broadcast(side) if total <= limit else side


def text_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text as UTF-8 bytes); a null text is empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))


def packed(texts: DataFrame) -> DataFrame:
    """``texts`` with ``z``, the text compressed, in place of the binary column ``text``: half the bytes to shuffle."""
    keep = [f for f in texts.schema.fields if f.name != "text"]

    def scan(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = pa.array([press.compress(v.as_py()) for v in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), z], [*(f.name for f in keep), "z"])

    return texts.mapInArrow(scan, StructType([*keep, StructField("z", BinaryType())]))


def unpacked(column):
    """The texts of a column of packed ones, one at a time."""
    press = zstandard.ZstdDecompressor()
    return (press.decompress(v.as_py()) for v in column)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1,000 rows, since texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def pieces(column: pa.Array, limit: int = 1 << 21):
    """Cut a binary Arrow column into (first row, list of bytes) of about ``limit`` bytes; a longer text stands alone."""
    values, first, size = [], 0, 0
    for k in range(len(column)):
        v = column[k].as_py() or b""
        if values and size + len(v) > limit:
            yield first, values
            values, first, size = [], k, 0
        values.append(v)
        size += len(v)
    if values:
        yield first, values


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node reachable.

    Alternating large-star and small-star rounds: only joins and minima on keys, no neighbour list is ever gathered.
    Loops, repeated edges and an empty table are fine.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(small_low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(hung.union(small_low).distinct())
        row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == (row["n"], row["s"]):
            break
        state = (row["n"], row["s"])
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
