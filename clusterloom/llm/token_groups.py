"""N-gram Jaccard join by a token-group matrix.

Every text becomes a set of hashed word shingles. Similar sets are partitioned into groups; the matrix keeps, for each
group, how many tokens its union can hold in each of 256 token classes. The overlap of two groups cannot exceed the sum of the smaller
entries, so only pairs of groups that may hold a link are opened, and only pairs of sets that pass the same bound are compared in full.

Scale: texts are scanned where they lie and never shuffled whole; what is shuffled are the rarest fifth of a set's tokens
(two sets with a Jaccard similarity of t share one of their first n - ceil(t n) + 1 tokens in any fixed order). The order
puts frequent tokens last, by a counting sketch of fixed size over all documents. Copies collapse into classes by
map-side aggregation. Groups have about ``GROUP`` members, whatever the number of similar documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.llm import textkit
from clusterloom.llm.common import components, pieces, small_batches, small_or_shuffled, text_bytes, written

SKETCH = 1 << 22  # counters, 16 MiB in all
CHUNK = 1 << 14
GROUP = 128
CLASSES = 256


def _sets(column, k: int):
    """(row, sorted distinct shingle hashes) of every text of a binary Arrow column."""
    for first, texts in pieces(column):
        w = textkit.hash_words(texts)
        runs = textkit.windows(w.hash, k)
        for j in range(len(texts)):
            a, b = w.first[j], w.first[j + 1]
            yield first + j, np.unique(runs[a : b - k + 1]) if b - a >= k else textkit.whole(w.hash[a:b]) if b > a else w.hash[:0]


def _count_scan(k: int):
    def scan(batches):
        counts, waiting, size = np.zeros(SKETCH, np.int64), [], 0
        for batch in batches:
            for _, texts in pieces(batch.column("text")):
                waiting.append((textkit.windows(textkit.hash_words(texts).hash, k) & np.uint64(SKETCH - 1)).astype(np.int64))
                size += len(waiting[-1])
                if size > SKETCH:
                    counts += np.bincount(np.concatenate(waiting), minlength=SKETCH)
                    waiting, size = [], 0
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=SKETCH)
        press = zstandard.ZstdCompressor(level=1)
        for lo in range(0, SKETCH, CHUNK):
            part = counts[lo : lo + CHUNK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([lo // CHUNK]), pa.array([press.compress(part.tobytes())])], ["chunk", "counts"])

    return scan


def _sum_chunks(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for c, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.int64)
            sums[c] = sums[c] + part if c in sums else part
    for c, part in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([c]), pa.array([zstandard.ZstdCompressor(level=1).compress(part.tobytes())])], ["chunk", "counts"])


def shingle_counts(texts: DataFrame, k: int) -> np.ndarray:
    """Counters of all shingles of all texts, hashed into a table of fixed size: merged chunk by chunk on executors."""
    merged = texts.mapInArrow(_count_scan(k), "chunk bigint, counts binary").repartition(SKETCH // CHUNK, "chunk").mapInArrow(_sum_chunks, "chunk bigint, counts binary")
    out = np.zeros(SKETCH, np.int64)
    for row in merged.collect():  # at most SKETCH / CHUNK rows
        out[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row.counts)), np.int64)
    return np.minimum(out, 2**32 - 1).astype(np.uint32)


def _classes(s: np.ndarray) -> bytes | None:
    """How many tokens fall into each token class; null where a count leaves a byte (such sets pass every bound)."""
    c = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=CLASSES)
    return c.astype(np.uint8).tobytes() if len(c) and c.max() < 256 else None


def _signature_scan(k: int, percent: int, sketch):
    def scan(batches):
        order = sketch.value
        for batch in batches:
            n, fp, hist, prefix, ends = [], [], [], [], [0]
            for _, s in _sets(batch.column("text"), k):
                n.append(len(s))
                fp.append(xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63)
                hist.append(_classes(s))
                keep = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                rank = (np.minimum(order[(s & np.uint64(SKETCH - 1)).astype(np.int64)], 65535).astype(np.uint64) << np.uint64(48)) | (s >> np.uint64(16))
                prefix.append(s[np.argsort(rank, kind="stable")[:keep]])
                ends.append(ends[-1] + keep)
            flat = np.concatenate(prefix).view(np.int64) if prefix else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), pa.array(hist, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["doc_id", "n", "fp", "hist", "prefix"],
            )

    return scan


def _set_scan(k: int):
    def scan(batches):
        for batch in batches:
            sets = [s.tobytes() for _, s in _sets(batch.column("text"), k)]
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(sets, pa.binary())], ["fp", "tokens"])

    return scan


def _need(n1, n2, percent: int):
    """Least overlap of two linked sets."""
    return -(-percent * (n1 + n2) // (100 + percent))


def _matrix(column) -> np.ndarray:
    """Rows of token class counts as int16; a null row is unbounded."""
    free = np.full(CLASSES, 2**14, np.int16)
    return np.array([free if h is None else np.frombuffer(h, np.uint8).astype(np.int16) for h in column]).reshape(-1, CLASSES)


def _bounded(percent: int):
    """Keep rows (n1, n2, h1, h2, ...) whose sets, or groups of sets of at least these sizes, may still be linked."""

    def scan(batches):
        for batch in batches:
            n1, n2 = (batch.column(c).to_numpy() for c in ("n1", "n2"))
            most = np.minimum(_matrix(batch.column("h1").to_pylist()), _matrix(batch.column("h2").to_pylist())).sum(axis=1, dtype=np.int64)
            yield batch.filter(pa.array(most >= _need(n1, n2, percent))).select(["a", "b"])

    return scan


def _group_rows(batches):
    """One matrix row per group: for each token class the most tokens any member has there, and the members' sizes."""
    for batch in batches:
        out = []
        for members in batch.column("members").to_pylist():
            out.append(None if any(m["hist"] is None for m in members) else _matrix([m["hist"] for m in members]).max(axis=0).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("g"), pa.array(out, pa.binary())], ["g", "row"])


def _opened(percent: int):
    """Open a pair of groups: pairs of members of different components that pass sizes and bound."""

    def scan(batches):
        for batch in batches:
            left, right = [], []
            for g1, g2, m1, m2 in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "m1", "m2"))):
                f1, n1, c1 = (np.array([m[x] for m in m1]) for x in ("fp", "n", "comp"))
                f2, n2, c2 = (np.array([m[x] for m in m2]) for x in ("fp", "n", "comp"))
                h1, h2 = _matrix([m["hist"] for m in m1]), _matrix([m["hist"] for m in m2])
                for i in range(len(m1)):
                    may = (c2 != c1[i]) & (100 * np.minimum(n2, n1[i]) >= percent * np.maximum(n2, n1[i]))
                    if g1 == g2:
                        may &= f2 > f1[i]
                    may = np.flatnonzero(may)
                    may = may[np.minimum(h2[may], h1[i]).sum(axis=1, dtype=np.int64) >= _need(n2[may], n1[i], percent)]
                    left.extend([int(f1[i])] * len(may))
                    right.extend(f2[may].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return scan


def _compared(percent: int):
    def scan(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("s1"), batch.column("s2")):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(linked)).select(["a", "b"])

    return scan


def _links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough; each class's text is read once, by its first document."""
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    sets = written(texts.join(small_or_shuffled(wanted, 16), "doc_id").select(F.col("doc_id").alias("fp"), "text").mapInArrow(_set_scan(k), "fp bigint, tokens binary"))
    full = pairs.join(sets.select(F.col("fp").alias("a"), F.col("tokens").alias("s1")), "a").join(sets.select(F.col("fp").alias("b"), F.col("tokens").alias("s2")), "b")
    return written(full.mapInArrow(_compared(percent), "a bigint, b bigint"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of every document of ``docs``.

    Words are runs of non-space characters, A-Z lower-cased; a set holds the distinct ``k``-word shingles (a shorter text
    is one shingle). Sets link at a Jaccard similarity of ``percent`` / 100 or more, and components follow links. Null
    and empty texts have no shingles and stand alone. Equal sets form one class (class_id: its smallest id). Ids must be
    unique and not null; other columns are ignored. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = text_bytes(docs, id_col, text_col)
    sketch = spark.sparkContext.broadcast(shingle_counts(texts, k))
    sigs = written(texts.mapInArrow(_signature_scan(k, percent, sketch), "doc_id bigint, n bigint, fp bigint, hist binary, prefix array<bigint>"))

    # Classes of equal sets; from here on a class goes by its least document (column fp).
    classes = sigs.groupBy("fp").agg(F.min("doc_id").alias("class_id"))
    named = written(sigs.select("doc_id", "n", "fp").join(classes, "fp").select("doc_id", "n", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id")))
    copies = written(named.where("doc_id <> class_id").select("doc_id"))
    one_each = sigs.join(small_or_shuffled(copies, 16), "doc_id", "left_anti").withColumn("fp", F.col("doc_id"))

    # Tokens of prefixes that more than one class has.
    # The smaller set of a link has one of the common tokens among its first n - ceil(2 t n / (1 + t)) + 1, so a token that no set has there
    # can go.
    early = F.col("pos") < F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / (100 + percent)) + 1
    tokens = one_each.select("fp", "n", F.posexplode("prefix").alias("pos", "token"))
    counted = tokens.select("token", early.alias("early")).groupBy("token").agg(F.count("*").alias("c"), F.max("early").alias("early"))
    shared = written(counted.where("c > 1 AND early").select("token"))
    tokens = tokens.select("fp", "token")
    held = written(tokens.join(shared, "token", "left_semi"))
    member = written(one_each.select("fp", "n", "hist").join(held.select("fp").distinct(), "fp", "left_semi"))
    rows = written(held.join(member.select("fp", "n"), "fp"))

    def fits(n1, n2):
        return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)

    def by_hist(pairs):
        one, two = (member.select(F.col("fp").alias(c), F.col("n").alias(f"n{i}"), F.col("hist").alias(f"h{i}")) for c, i in (("a", 1), ("b", 2)))
        return pairs.join(one, "a").join(two, "b").mapInArrow(_bounded(percent), "a bigint, b bigint")

    # First links: every class with the least class of each of its tokens.
    least = rows.groupBy("token").agg(F.min(F.struct("fp", "n")).alias("l"))
    star = rows.join(least, "token").where((F.col("fp") != F.col("l.fp")) & fits(F.col("n"), F.col("l.n"))).select(F.col("l.fp").alias("a"), F.col("fp").alias("b")).distinct()
    first = _links(written(by_hist(star)), texts, k, percent)
    comp = written(components(first))

    # What is left: tokens that join different components. Groups are made by the commonest such token of a class.
    marked = rows.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("token", "fp", F.coalesce("root", "fp").alias("comp"))
    open_tokens = marked.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c")).where("lo < hi").select("token", "c")
    left = written(marked.join(open_tokens, "token"))
    main = left.groupBy("fp").agg(F.max(F.struct("c", "token"))["token"].alias("main"), F.first("comp").alias("comp"))
    many = main.groupBy("main").agg(F.ceil(F.count("*") / GROUP).alias("blocks"))
    grouped = written(main.join(many, "main").select("fp", "comp", F.xxhash64("main", F.pmod(F.xxhash64("fp"), F.col("blocks"))).alias("g")))
    groups = written(grouped.join(member.select("fp", "n", "hist"), "fp").groupBy("g").agg(F.collect_list(F.struct("fp", "n", "comp", "hist")).alias("members"), F.min("n").alias("least_n"), F.max("n").alias("most_n")))
    matrix = written(groups.mapInArrow(_group_rows, "g bigint, row binary").join(groups.select("g", "least_n", "most_n"), "g"))
    in_group = left.join(grouped.select("fp", "g"), "fp").select("token", "g").distinct()
    met = in_group.alias("x").join(in_group.alias("y"), "token").where("x.g <= y.g").select(F.col("x.g").alias("a"), F.col("y.g").alias("b")).distinct()
    one, two = (matrix.select(F.col("g").alias(c), F.col("least_n").alias(f"n{i}"), F.col("most_n").alias(f"m{i}"), F.col("row").alias(f"h{i}")) for c, i in (("a", 1), ("b", 2)))
    near = met.join(one, "a").join(two, "b").where(f"100 * m1 >= {percent} * n2 and 100 * m2 >= {percent} * n1").mapInArrow(_bounded(percent), "a bigint, b bigint")
    one, two = (groups.select(F.col("g").alias(c), F.col("members").alias(f"m{i}")) for c, i in (("a", 1), ("b", 2)))
    pairs = written(near.join(one, "a").join(two, "b").mapInArrow(_opened(percent), "a bigint, b bigint").distinct())
    second = _links(pairs, texts, k, percent)

    roots = components(first.union(second))
    lowest = roots.groupBy("root").agg(F.min("node").alias("component_id"))
    found = written(roots.join(lowest, "root").select(F.col("node").alias("class_id"), "component_id"))
    return named.join(found, "class_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "class_id").alias("component_id"), "class_id")
