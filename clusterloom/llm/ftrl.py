"""Quality classifier: hashed word n-grams, logistic regression trained by follow-the-regularised-leader updates.

Training runs on at most about ``TRAIN_ROWS`` labelled documents (chosen by a hash of the id): each shard of them makes FTRL
passes in its own task, and the shards' weights are averaged over epochs that start from the average. Scoring is one scan of the whole
table, a sparse dot product per document. Nothing but the weights (``BUCKETS`` numbers) reaches the driver.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.llm import textkit
from clusterloom.llm.common import pieces, small_batches, small_or_shuffled, text_bytes, written

BITS = 18
BUCKETS = 1 << BITS
#: Bound on the labelled documents that training reads, in expectation.
TRAIN_ROWS = 12_000
SHARDS = 6
THRESHOLD = 0.3
PIECE_BYTES = 1 << 19  # texts whose words are hashed at once; a longer text stands alone


class Settings(NamedTuple):
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 0.0003
    l2: float = 0.002
    passes: int = 4
    epochs: int = 2


def _features(texts: list[bytes]):
    """(buckets, values, ends) of the word uni- and bigrams of each text: counts damped by a square root, then scaled to
    length one, so that a text's length alone says nothing. Case and punctuation stay part of the words."""
    w = textkit.hash_words(texts, lower=False)
    shift = np.uint64(64 - BITS)
    one, two = (textkit.mix(w.hash) >> shift).astype(np.int64), (textkit.windows(w.hash, 2) >> shift).astype(np.int64)
    count = np.diff(w.first)
    doc = np.repeat(np.arange(len(texts)), count)
    inside = doc[1:] == doc[:-1]
    keys = np.concatenate((doc << BITS | one, (doc[1:] << BITS | two)[inside]))
    keys, n = np.unique(keys, return_counts=True)
    doc, bucket, value = keys >> BITS, keys & (BUCKETS - 1), np.sqrt(n)
    norm = np.sqrt(np.bincount(doc, weights=value * value, minlength=len(texts)))
    ends = np.searchsorted(doc, np.arange(len(texts) + 1))
    return bucket, value / np.maximum(norm, 1e-9)[doc], ends


def _sparse_rows(batches):
    for batch in batches:
        for first, texts in pieces(batch.column("text"), PIECE_BYTES):
            bucket, value, ends = _features(texts)
            ends = pa.array(ends, pa.int32())
            side = batch.slice(first, len(texts))
            yield pa.RecordBatch.from_arrays(
                [side.column("doc_id"), side.column("label"), pa.ListArray.from_arrays(ends, pa.array(bucket, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(value))],
                ["doc_id", "label", "bucket", "value"],
            )


def _weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def _columns(rows: pa.Table) -> dict:
    """The columns of a shard, a value for each row; lists are views of the Arrow columns, no copies."""
    out: dict[str, list] = {c: [] for c in rows.column_names}
    for batch in rows.to_batches():
        for c, column in zip(batch.column_names, batch.columns):
            if pa.types.is_list(column.type):
                flat, ends = column.values.to_numpy(), column.offsets.to_pylist()
                out[c] += [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
            else:
                out[c] += column.to_pylist()
    return out


def _shard_fit(start, s: Settings):
    """FTRL-proximal over one shard, in id order; starts at the given weights. Bucket BUCKETS is the bias."""

    def fit(rows) -> pa.Table:
        order = np.argsort(np.asarray(rows["doc_id"]))
        docs = [tuple(rows[c][k] for c in ("bucket", "value", "label")) for k in order]
        z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
        z[:] = -start.value * (s.beta / s.alpha + s.l2) - np.sign(start.value) * s.l1
        for _ in range(s.passes):
            for b, v, y in docs:
                b, v = np.append(b, BUCKETS), np.append(v, 1.0)  # anew in each pass: copies of all rows would double the worker's memory
                w = _weights(z[b], n[b], s)
                g = (1 / (1 + np.exp(-np.clip(v @ w, -35, 35))) - y) * v
                z[b] += g - (np.sqrt(n[b] + g * g) - np.sqrt(n[b])) / s.alpha * w
                n[b] += g * g
        w = _weights(z, n, s)
        at = np.flatnonzero(w)
        return pa.table({"bucket": at, "weight": w[at]})

    return fit


def _arrow_fit(start, s: Settings):
    fit = _shard_fit(start, s)

    def run(rows: pa.Table) -> pa.Table:
        return fit(_columns(rows))

    return run


def _label_fold(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(), train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights (last: bias) learnt from the labelled rows outside the held-out fold (crc32(id) mod 5 = 0).

    Labels that are null or whose document is missing are ignored, a document labelled twice counts as it is; without any
    label all weights are 0 (every score 0.5).
    """
    spark = docs.sparkSession
    small_batches(spark)
    usable = labels.where(F.col(label_col).isNotNull() & (_label_fold(id_col) != 0)).select(F.col(id_col).alias("doc_id"), (F.col(label_col) > 0).cast("int").alias("label"))
    total = usable.count()
    chosen = written(usable.where(F.crc32(F.concat(F.lit("fit"), F.col("doc_id").cast("string")).cast("binary")) < F.lit(2**32 * min(1.0, train_rows / max(total, 1)))))
    rows = text_bytes(docs, id_col, text_col).join(small_or_shuffled(chosen, 16), "doc_id").mapInArrow(_sparse_rows, "doc_id bigint, label int, bucket array<int>, value array<double>")
    rows = written(rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS))))
    shards = max(1, rows.select("shard").distinct().count())  # with few labels some are empty
    weights = np.zeros(BUCKETS + 1)
    for _ in range(settings.epochs):
        start = spark.sparkContext.broadcast(weights)
        parts = rows.groupBy("shard").applyInArrow(_arrow_fit(start, settings), "bucket bigint, weight double")
        summed = parts.groupBy("bucket").agg(F.sum("weight").alias("w")).toArrow()  # at most BUCKETS + 1 rows; in columns, not an object a number
        start.destroy()
        weights = np.zeros(BUCKETS + 1)
        weights[summed["bucket"].to_numpy()] = summed["w"].to_numpy() / shards
    return weights


def _scores(column, weights: np.ndarray) -> np.ndarray:
    out = [np.zeros(0)]
    for _, texts in pieces(column, PIECE_BYTES):
        bucket, value, ends = _features(texts)
        sums = np.concatenate(([0.0], np.cumsum(weights[bucket] * value)))
        out.append(1 / (1 + np.exp(-np.clip(sums[ends[1:]] - sums[ends[:-1]] + weights[BUCKETS], -35, 35))))
    return np.concatenate(out)


def _score_scan(model):
    def scan(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(batch.column("text"), model.value))], ["doc_id", "score"])

    return scan


def _keep_scan(model, text_col: str, threshold: float):
    def scan(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
            yield batch.filter(pa.array(_scores(texts, model.value) >= threshold))

    return scan


def keep_good(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that score below the threshold."""
    small_batches(docs.sparkSession)
    return docs.mapInArrow(_keep_scan(docs.sparkSession.sparkContext.broadcast(weights), text_col, threshold), docs.schema)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score in 0..1) of every document; null and empty texts get the score of the bias."""
    small_batches(docs.sparkSession)
    return text_bytes(docs, id_col, text_col).mapInArrow(_score_scan(docs.sparkSession.sparkContext.broadcast(weights)), "doc_id bigint, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on)."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", (_label_fold() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
