"""Removal of repeated word spans by compaction of a De Bruijn graph of token k-mers.

The edges are the windows of ``WINDOW`` words, the nodes what two neighbouring windows share. Windows in a row that have the same anchor (of the
``GRAM``-word grams in a window the one with the least hash, leftmost on ties) travel as one edge run; since the anchor
depends on the window alone, equal passages are cut into equal runs, except for the runs at their two ends.

1. Runs whose anchor gram stands only once cannot hold a repeated window; a count and a join by gram drop them.
2. Of the others, runs that occur twice or more are repeated edges. A join gives every occurrence what its run knows: where it occurs first, how
   often, and whether the same run always follows. Where it does, as often as it occurs itself, nothing branches and the runs join to one path;
   every occurrence of a path covers it whole; its first occurrence stays, the words of the others go.
3. Different runs with one anchor gram meet where a repeat begins or ends. Of each such run the first occurrence is taken apart, and its windows are
   compared one by one by their source coordinates.

Nulls and odd rows: a null text has no words. Rows with the same id and different texts are different documents in the order of a
hash of the text, a null id comes before all others, and rows equal in both are one document, so that each gets the same result. Texts of
fewer than ``WINDOW`` words keep everything; other columns are ignored.

Scale: the first scan ships 8 bytes for each some eight words, the second a row of some 35; texts meet their open runs, and at the end their
spans, in joins by id of packed texts, whatever their size. No list is gathered but of one document's own runs. Grams and runs are counted with map-side
aggregation; joins by gram or run can be split by adaptive execution. Words, runs and windows are compared by 64-bit hashes among those that share
a 64-bit anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.llm import textkit
from clusterloom.llm.common import packed, small_batches, unpacked, written

WINDOW = 20
GRAM = 6
BLOCK = 1 << 20  # windows worked off at once
PIECE = 1 << 21  # bytes of texts hashed at once
_BASE = 0xD6E8FEB86659FD93
_PLACE = np.uint64((1 << 22) - 1)


def _least(grams: np.ndarray, reach: int) -> np.ndarray:
    """For each place the place of the least of the ``reach`` grams from it, the leftmost on ties."""
    n = len(grams) - reach + 1
    out = np.empty(max(n, 0), np.int64)
    for lo in range(0, n, BLOCK):
        m = min(BLOCK, n - lo)
        key = np.full(-(-(m + reach) // reach) * reach, np.uint64(2**64 - 1))
        part = grams[lo : lo + m + reach - 1]
        key[: len(part)] = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        rows = key.reshape(-1, reach)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        out[lo : lo + m] = lo + (np.minimum(behind[:m], ahead[reach - 1 : reach - 1 + m]) & _PLACE).astype(np.int64)
    return out


class _Hashed:
    """Word hashes of some texts, their edge runs, and hashes of any stretch of words."""

    def __init__(self, texts: list[bytes], window: int, gram: int):
        words = textkit.hash_words(texts, lower=False)
        self.first, self.window = words.first, window
        self.grams = textkit.windows(words.hash, gram)
        n = len(words.hash)
        starts = np.zeros(n + 1, bool)  # windows that lie in one text
        for a, b in zip(self.first[:-1], self.first[1:]):
            starts[a : max(a, b - window + 1)] = True
        valid = np.flatnonzero(starts)
        anchor = _least(self.grams, window - gram + 1)[valid] if len(valid) else valid
        cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)) + 1
        lo = np.concatenate(([0], cut)).astype(np.int64) if len(valid) else valid
        hi = np.append(lo[1:], len(valid))
        self.start, self.count, self.anchor = valid[lo], hi - lo, anchor[lo]
        self.text = np.searchsorted(self.first, self.start, side="right") - 1
        self._word = words.hash

    def bucket(self) -> np.ndarray:
        return self.grams[self.anchor].view(np.int64)

    def powers(self):
        n = len(self._word)
        up, down = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, pow(_BASE, -1, 2**64), np.uint64)
        up[:1] = down[:1] = 1
        self.up, self.down = np.cumprod(up), np.cumprod(down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self._word * self.up[:n], out=self.sums[1:])

    def stretch(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return textkit.mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))


def _pieces(texts):
    """(first row, texts) of about ``PIECE`` bytes."""
    values, first, size = [], 0, 0
    for k, text in enumerate(texts):
        if values and size + len(text) > PIECE:
            yield first, values
            values, first, size = [], k, 0
        values.append(text)
        size += len(text)
    if values:
        yield first, values


def _arrow(columns: dict, **types):
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, types.get(k, pa.int64())) for k, v in columns.items()], list(columns))


def _gram_scan(window: int, gram: int):
    """Anchor grams of the edge runs, with their number."""

    def scan(batches):
        for batch in batches:
            for _, texts in _pieces(v.as_py() for v in batch.column("text")):
                bucket, c = np.unique(_Hashed(texts, window, gram).bucket(), return_counts=True)
                yield _arrow({"bucket": bucket, "c": c})

    return scan


def _run_scan(window: int, gram: int):
    """Every edge run: document, start, number of windows, anchor gram, identifier ``e``, and what identifies the run behind it in the document."""

    def scan(batches):
        for batch in batches:
            for first, texts in _pieces(v.as_py() for v in batch.column("text")):
                x = _Hashed(texts, window, gram)
                x.powers()
                e = textkit.mix(x.stretch(x.start, x.start + x.count + window - 1) + (x.anchor - x.start).astype(np.uint64))
                both = textkit.mix(e ^ (x.grams[x.anchor] * np.uint64(_BASE)))
                last = np.append(x.text[1:] != x.text[:-1], True)[: len(e)]
                row = pa.array(first + x.text)
                cols = {"doc_id": batch.column("doc_id").take(row), "t": batch.column("t").take(row), "s": x.start - x.first[x.text], "n": x.count, "bucket": x.bucket(), "e": e.view(np.int64)}
                cols["nxt"] = pa.array(np.roll(both, -1).view(np.int64), pa.int64(), mask=last)
                yield _arrow(cols)

    return scan


def _window_scan(window: int, gram: int):
    """Every window of the open runs of a document: start, anchor gram, hash."""

    def scan(batches):
        for batch in batches:
            wanted = batch.column("open")
            for first, texts in _pieces(unpacked(batch.column("z"))):
                x = _Hashed(texts, window, gram)
                x.powers()
                own = x.start - x.first[x.text]
                is_open = np.zeros(len(own), bool)
                for j in range(len(texts)):
                    a, b = np.searchsorted(x.text, (j, j + 1))
                    is_open[a:b] = np.isin(own[a:b], wanted[first + j].values.to_numpy())
                at = np.flatnonzero(is_open)
                start, count = x.start[at], x.count[at]
                ends = np.concatenate(([0], np.cumsum(count))).astype(np.int64)
                each = np.arange(ends[-1]) - np.repeat(ends[:-1] - start, count)
                text = np.repeat(x.text[at], count)
                rows = pa.array(first + text)
                yield _arrow({"doc_id": batch.column("doc_id").take(rows), "t": batch.column("t").take(rows), "s": each - x.first[text], "bucket": np.repeat(x.bucket()[at], count), "w": x.stretch(each, each + window).view(np.int64)})

    return scan


def _path_scan(window: int):
    """Word spans of the paths of each document that do not occur here first: repeated runs, joined where every occurrence of either has the other beside it."""

    def scan(batches):
        for batch in batches:
            out: list[list] = []
            for row, runs in enumerate(batch.column("runs").to_pylist()):
                end, before = -1, None
                for r in sorted(runs, key=lambda r: r["s"]):
                    if before is not None and r["s"] == end and before["one_nxt"] and before["c"] == r["c"] and before["here"] == r["here"]:
                        out[-1][2] += r["n"]
                    else:
                        out.append([row, r["s"], r["s"] + r["n"] + window - 1, r["here"]])
                    end, before = r["s"] + r["n"], r
            cols = list(zip(*(p for p in out if not p[3]))) or [[]] * 4
            rows = pa.array(cols[0], pa.int64())
            yield _arrow({"doc_id": batch.column("doc_id").take(rows), "t": batch.column("t").take(rows), "a": cols[1], "b": cols[2]})

    return scan


_AT = ["doc_id", "t", "s"]


def _later(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose ``keys`` also stand at an earlier place (document, then start)."""
    first = rows.groupBy(*keys).agg(F.min(F.struct(*_AT)).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    return rows.join(first, keys).where(F.struct(*_AT) > F.col("first")).drop("first")


def _hashed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.col(id_col).alias("doc_id"), F.hash(text).alias("t"), text.alias("text"))


def _by_document(texts: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """Texts with what ``side`` has for their document (one row each)."""
    side = side.withColumnRenamed("doc_id", "_id").withColumnRenamed("t", "_t")
    return texts.join(side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")), how).drop("_id", "_t")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, t, spans): word spans (a, b), end exclusive, that windows cover which also start earlier; they may overlap. ``t`` is a hash of the text."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = _hashed_texts(docs, id_col, text_col)
    key = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, t int"
    counts = texts.mapInArrow(_gram_scan(window, gram), "bucket bigint, c bigint").groupBy("bucket").agg(F.sum("c").alias("c"))
    many = written(counts.where("c > 1").select("bucket"))
    runs = texts.mapInArrow(_run_scan(window, gram), f"{key}, s bigint, n bigint, bucket bigint, e bigint, nxt bigint")
    edges = written(runs.join(many, "bucket", "left_semi"))

    one_nxt = (F.count("nxt") == F.count("*")) & (F.min("nxt") == F.max("nxt"))
    known = edges.groupBy("bucket", "e").agg(F.count("*").alias("c"), F.min(F.struct(*_AT)).alias("first"), one_nxt.alias("one_nxt")).where("c > 1")
    here = F.struct(*_AT) == F.col("first")
    marked = written(edges.drop("nxt").join(known, ["bucket", "e"], "left").select(*_AT, "n", "bucket", "e", "c", "one_nxt", here.alias("here")))

    repeated = marked.where("c IS NOT NULL").groupBy("doc_id", "t").agg(F.collect_set(F.struct("s", "n", "c", "one_nxt", "here")).alias("runs"))
    whole = repeated.mapInArrow(_path_scan(window), f"{key}, a bigint, b bigint")

    apart = marked.where("c IS NULL OR here").select(*_AT, "bucket", "e")
    mixed = apart.groupBy("bucket").agg(F.min("e").alias("lo"), F.max("e").alias("hi")).where("lo < hi").select("bucket")
    wanted = written(apart.join(mixed, "bucket", "left_semi").groupBy("doc_id", "t").agg(F.collect_set("s").alias("open")))
    single = written(_by_document(packed(texts), wanted, "inner").mapInArrow(_window_scan(window, gram), f"{key}, s bigint, bucket bigint, w bigint"))
    parts = _later(single, ["bucket", "w"]).select("doc_id", "t", F.col("s").alias("a"), (F.col("s") + window).alias("b"))
    return whole.union(parts).groupBy("doc_id", "t").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def _keep_scan(batches):
    for batch in batches:
        out = []
        for raw, spans in zip(unpacked(batch.column("z")), batch.column("spans").to_pylist()):
            words, kept, reach = raw.split(), [], 0
            n = len(words)
            for a, b in sorted((x["a"], x["b"]) for x in spans or []):
                if a > reach:
                    kept += words[reach:a]
                reach = max(reach, b)
            kept += words[reach:]
            out.append((n, n - len(kept), b" ".join(kept)))
        cols = list(zip(*out)) if out else [[]] * 3
        yield _arrow({"doc_id": batch.column("doc_id"), "n_words": cols[0], "n_removed": cols[1], "kept": cols[2]}, kept=pa.binary())


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row's words without those covered by a window that also starts earlier, joined by one space (UTF-8, binary)."""
    spans = written(repeated_spans(docs, id_col, text_col, window, gram))
    texts = _hashed_texts(docs, id_col, text_col)
    met = _by_document(packed(texts), spans, "left")
    return met.mapInArrow(_keep_scan, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_removed bigint, kept binary")


def report(docs: DataFrame) -> DataFrame:
    """``dedup`` with a digest in place of the words."""
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
