"""Exact removal of long repeated byte strings by bucket-pointer refinement.

A string of ``LENGTH`` bytes is a suffix prefix to be told apart. Of the q-grams that start in its first ``REACH`` bytes, the one with
the least hash (leftmost on ties) is its anchor, so equal strings have equal anchors at equal offsets, and only anchors, about two in
``REACH`` positions, need to be sorted instead of every suffix. An anchor stands for the run of string starts it serves.

Initial buckets hold anchors with the same q-gram. A bucket is then refined by what stands at earlier and later offsets: first
by the whole context of the run (a bucket of two or more: all its strings repeat), then, for anchors left over, by the contexts of blocks of
``STEP`` starts, and at last by single strings. Identifiers hash raw bytes, not the buckets of later offsets as a bucket-pointer
sort does; the stages only narrow what the next one reads. A part whose shared core is alone in its bucket is dropped at once.

Scale: the first scan reduces the text to one row of 56 bytes per some 160 bytes; buckets are counted with map-side aggregation and joined
back by sort-merge joins that adaptive execution can split, so a bucket may hold any share of the rows. Texts meet their open anchors, and at the
end their runs, in joins by id of packed texts, at every size alike. Bucket identifiers have 64 bits
where they only select candidates and 128 bits where they decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.common import packed, small_batches, text_bytes, unpacked, written
from clusterloom.llm.textkit import mix

LENGTH = 400
REACH = 320
STEP = 16
Q = LENGTH - REACH + 1
PIECE = 1 << 20
_PLACE = np.uint64((1 << 22) - 1)
_SCHEMA = "doc_id bigint, p bigint, s bigint, e bigint, q bigint, o1 bigint, o2 bigint"


def _two(data: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(data)
    return (h >> 64) - 2**63, (h & (2**64 - 1)) - 2**63


def _one(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - 2**63


def _least_in_reach(buffer: bytes) -> np.ndarray:
    """For each position the place of the least hashed 8-gram among the ``REACH`` positions from it."""
    n = len(buffer)
    key = np.zeros(-(-n // REACH) * REACH + REACH, np.uint64)
    for k in range(min(8, n)):
        m = (n - k) // 8
        key[k : k + 8 * m : 8] = np.frombuffer(buffer, "<u8", m, k)
    key = (mix(key) & ~_PLACE) | np.arange(len(key), dtype=np.uint64)
    rows = key.reshape(-1, REACH)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[REACH - 1 : REACH - 1 + n]) & _PLACE).astype(np.int64)


def _joined(column):
    """Pieces of about ``PIECE`` bytes: (buffer, [(row, offset in the text, offset in the buffer, bytes, first and end of the own
    starts in the buffer)]). A longer text is cut into parts; a part holds one start before its own ones and ``REACH`` after
    them, so that it sees every run whole that begins with one of its own."""
    parts, places, size = [], [], 0
    for row in range(len(column)):
        text = column[row].as_py()
        for own in range(0, max(1, len(text) - LENGTH + 1), PIECE):
            at = max(0, own - 1)
            part = text[at : own + PIECE + REACH + LENGTH - 1] if len(text) > PIECE else text
            if len(part) < LENGTH:
                continue
            if size and size + len(part) > PIECE:
                yield b"".join(parts), places
                parts, places, size = [], [], 0
            places.append((row, at, size, len(part), size + own - at, size + own - at + PIECE))
            parts.append(part)
            size += len(part)
    if parts:
        yield b"".join(parts), places


def _anchor_scan(batches):
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for buffer, places in _joined(batch.column("text")):
            least = _least_in_reach(buffer)
            valid = np.concatenate([np.arange(off, off + n - LENGTH + 1) for _, _, off, n, *_ in places])
            part = np.repeat(np.arange(len(places)), [n - LENGTH + 1 for _, _, _, n, *_ in places])
            a = least[valid]
            cut = np.flatnonzero((a[1:] != a[:-1]) | (part[1:] != part[:-1])) + 1
            lo, hi = np.concatenate(([0], cut)), np.concatenate((cut - 1, [len(a) - 1]))
            first, end = (np.array(v)[part[lo]] for v in list(zip(*places))[4:])
            own = (valid[lo] >= first) & (valid[lo] < end)  # a run that crosses a cut belongs to the part where it begins
            lo, hi = lo[own], hi[own]
            p, s, e, part = a[lo], valid[lo], valid[hi], part[lo]
            shift = np.array([at - off for _, at, off, *_ in places])[part]
            rows = np.array([ids[r] for r, *_ in places])[part]
            q, o1, o2 = (np.empty(len(p), np.int64) for _ in range(3))
            for k, (x, y, z) in enumerate(zip(p.tolist(), s.tolist(), e.tolist())):
                q[k] = _one(buffer[x : x + Q])
                o1[k], o2[k] = _two(b"%d %d " % (x - y, z - x) + buffer[y : z + LENGTH])
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (rows, p + shift, s + shift, e + shift, q, o1, o2)], ["doc_id", "p", "s", "e", "q", "o1", "o2"])


def _context_scan(batches):
    """The bytes around the anchors that are left."""
    for batch in batches:
        out: list[tuple] = []
        for doc, text, left in zip(batch.column("doc_id").to_pylist(), unpacked(batch.column("z")), batch.column("open").to_pylist()):
            for r in left:
                lo, hi = max(0, r["s"] - STEP), r["e"] + LENGTH + STEP
                out.append((doc, r["p"], r["s"], r["e"], r["q"], lo, text[lo:hi]))
        types = [*[pa.int64()] * 6, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)], ["doc_id", "p", "s", "e", "q", "at", "context"])


def _block_scan(batches):
    """Blocks of ``STEP`` offsets between string start and anchor, aligned alike for every anchor: ``core`` is what all
    strings of the block share, ``o1, o2`` the whole of them (null where the text ends before)."""
    for batch in batches:
        out: list[tuple] = []
        for doc, p, s, e, q, at, context in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "p", "s", "e", "q", "at", "context"))):
            for b in range((p - e) // STEP, (p - s) // STEP + 1):
                near, far = p - STEP * b - at, p - STEP * b - STEP + 1 - at  # last and first start of the block
                label = b"%d %d " % (q, b)
                whole = _two(label + context[far : near + LENGTH]) if far >= 0 and near + LENGTH <= len(context) else (None, None)
                out.append((doc, p, b, max(s, far + at), min(e, near + at), _one(label + context[near : far + LENGTH]), *whole))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 8)], ["doc_id", "p", "b", "s", "e", "core", "o1", "o2"])


def _string_scan(batches):
    for batch in batches:
        out: list[tuple] = []
        for doc, p, at, context, s, e in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "p", "at", "context", "s", "e"))):
            out += [(doc, i, *_two(b"%d " % (p - i) + context[i - at : i - at + LENGTH])) for i in range(s, e + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)], ["doc_id", "i", "o1", "o2"])


def _repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Bucket identifiers that two or more rows have, as a table of its own: a join with it can be split where a bucket is hot."""
    return written(df.groupBy(*keys).count().where("count > 1").drop("count"))


def _still_open(marked: DataFrame, bucket: str) -> DataFrame:
    """Rows whose whole context stands alone, and one row of each repeated context in the same buckets, as their partner."""
    alone = marked.where("NOT whole")
    rest = [c for c in marked.columns if c not in ("o1", "o2", "whole")]
    one = marked.where("whole").groupBy("o1", "o2").agg(F.min(F.struct(*rest)).alias("r")).select("r.*")
    return alone.select(rest).union(one.join(alone.select(bucket).distinct(), bucket, "left_semi").select(rest))


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``whole``: does their whole context (o1, o2) occur more than once?"""
    equal = _repeated(rows.where("o1 IS NOT NULL"), "o1", "o2").withColumn("whole", F.lit(True))
    return written(rows.join(equal, ["o1", "o2"], "left").withColumn("whole", F.col("whole").isNotNull()))


def _merge_scan(batches):
    """Maximal runs [start, end, ...] of each document's covered bytes."""
    for batch in batches:
        out = []
        for spans in batch.column("spans").to_pylist():
            whole: list[int] = []
            for a, b in sorted((x["a"], x["b"]) for x in spans):
                if whole and a <= whole[-1]:
                    whole[-1] = max(whole[-1], b)
                else:
                    whole += [a, b]
            out.append(whole)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "runs"])


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs): maximal runs [start, end, ...] of bytes covered by strings of ``LENGTH`` bytes that start more than once
    in all texts (overlaps count). Documents without any are not listed. Ids must be unique and not null."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = text_bytes(docs, id_col, text_col)
    anchors = written(texts.where(F.length("text") >= LENGTH).mapInArrow(_anchor_scan, _SCHEMA))
    buckets = written(anchors.join(_repeated(anchors, "q"), "q", "left_semi"))
    marked = _marked(buckets)
    found = [marked.where("whole").select("doc_id", F.col("s").alias("a"), (F.col("e") + LENGTH).alias("b"))]

    per_doc = written(_still_open(marked, "q").groupBy("doc_id").agg(F.collect_list(F.struct("p", "s", "e", "q")).alias("open")))
    contexts = written(packed(texts.where(F.length("text") >= LENGTH)).join(per_doc, "doc_id").mapInArrow(_context_scan, "doc_id bigint, p bigint, s bigint, e bigint, q bigint, at bigint, context binary"))
    blocks = written(contexts.mapInArrow(_block_scan, "doc_id bigint, p bigint, b bigint, s bigint, e bigint, core bigint, o1 bigint, o2 bigint"))
    judged = _marked(blocks.join(_repeated(blocks, "core"), "core", "left_semi"))
    found.append(judged.where("whole").select("doc_id", F.col("s").alias("a"), (F.col("e") + LENGTH).alias("b")))

    last = _still_open(judged, "core").select("doc_id", "p", "s", "e")
    strings = written(last.join(contexts.select("doc_id", "p", "at", "context"), ["doc_id", "p"]).mapInArrow(_string_scan, "doc_id bigint, i bigint, o1 bigint, o2 bigint"))
    found.append(strings.join(_repeated(strings, "o1", "o2"), ["o1", "o2"], "left_semi").select("doc_id", F.col("i").alias("a"), (F.col("i") + LENGTH).alias("b")))
    every = found[0].union(found[1]).union(found[2])
    return every.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("spans")).mapInArrow(_merge_scan, "doc_id bigint, runs array<bigint>")


def _kept_scan(batches):
    """The texts without their runs, and counts."""
    for batch in batches:
        out = []
        for raw, runs in zip(unpacked(batch.column("z")), batch.column("runs").to_pylist()):
            runs = runs or []
            edges = [0, *runs, len(raw)]
            kept = b"".join(raw[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
            out.append((len(raw), len(raw) - len(kept), len(runs) // 2, kept))
        cols = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every text as UTF-8 bytes without its repeated runs.

    Null and empty texts, and those shorter than ``LENGTH`` bytes, lose nothing; equal texts lose all their bytes from that length on.
    """
    runs = written(repeated_runs(docs, id_col, text_col))
    return packed(text_bytes(docs, id_col, text_col)).join(runs, "doc_id", "left").mapInArrow(_kept_scan, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def report(docs: DataFrame) -> DataFrame:
    """``dedup`` with a digest in place of the bytes."""
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
