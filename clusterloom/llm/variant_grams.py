"""Spelling variant grouping by a variable-length gram index.

A dictionary holds the grams that are frequent among all words; everywhere in a word the shortest gram outside it is taken, up to ``QMAX``
code points, and grams inside an earlier one are left out. So frequent letter runs get long grams and rare ones short grams.
For each word the number of its grams that one edit can change is bounded (``affected``), hence two words that are one edit apart
share all but that many grams of either. Of the grams in order of their rarity it is enough to merge the lists of one more than the bound.
A shared gram that an edit left alone stands behind an equal beginning or before an equal ending, so lists are split by these. Words that
meet in a list are compared by their gram signatures against both bounds, and then by the edit itself.

A word whose bound leaves nothing to share takes part with the grams of the empty dictionary as well, in lists of their own: two such
words meet there, and with any other word it must share a gram of the other's.

Scale: runs are counted with map-side aggregation. The dictionary keeps at most ``SHARE`` grams of each length whatever the number of words,
since it takes those above a ``SHARE``-th of all places, so it may be broadcast. Lists are met by a sort-merge join on the
list and the length, which adaptive execution can split; only pairs that pass every test leave it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from clusterloom.llm import textkit
from clusterloom.llm.common import small_batches, written

RUNS = "[a-zÀ-ÿ]"  # of lower-cased text
LEAST_LENGTH, LEAST_COUNT, DROP_EVERY, RATIO = 7, 2, 31, 10
QMIN, QMAX, SHARE = 2, 3, 1 << 14
TASK_WORDS = 1 << 14  # words that one task takes apart


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences, after the seeded loss of letters.

    A null text has no words; a null id draws as an empty one; bytes that are no UTF-8 part words.
    """
    small_batches(docs.sparkSession)

    def scan(batches):
        # A loss makes a run shorter, never longer, so that shorter runs cannot become words.
        runs = re.compile(f"{RUNS}{{{LEAST_LENGTH},}}")
        for batch in batches:
            counts: Counter = Counter()
            for doc, raw in zip(batch.column("doc").to_pylist(), batch.column("text")):
                low = (raw.as_py() or b"").translate(textkit.LOWER).decode("utf-8", "replace")
                start = crc32(f"{doc or ''}:".encode())
                for run, n in Counter(runs.findall(low)).items():
                    h = crc32(run.encode(), start)
                    if h % DROP_EVERY == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= LEAST_LENGTH:
                        counts[run] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    texts = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(scan, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def gram_dictionary(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX, share: int = SHARE) -> dict[str, int]:
    """Counts of the grams of ``qmin`` to ``qmax`` code points that stand at more than a ``share``-th of all letter places: at most ``share`` of
    each length."""
    places = words.agg(F.sum(F.length("word"))).first()[0] or 0
    grams = None
    for q in range(qmin, qmax + 1):
        one = words.select(F.explode(F.expr(f"transform(sequence(1, greatest(length(word) - {q - 1}, 1)), i -> substring(word, i, {q}))")).alias("gram")).where(F.length("gram") == q)
        grams = one if grams is None else grams.union(one)
    return {r.gram: r["count"] for r in grams.groupBy("gram").count().where(F.col("count") * share > places).collect()}


def infixes(frequent, qmax: int = QMAX) -> set[str]:
    """What of a gram that is extended stands behind its first letter: its parts there, the empty one too."""
    return {""} | {g[a:b] for g in frequent if len(g) < qmax for a in range(1, len(g)) for b in range(a + 1, len(g) + 1)}


def decompose(word: str, frequent, qmin: int = QMIN, qmax: int = QMAX) -> list[tuple[int, int]]:
    """(start, end) of the grams of a word; starts and ends both rise."""
    out, reach, n = [], 0, len(word)
    for start in range(n - qmin + 1):
        end = start + qmin
        while end - start < qmax and end < n and word[start:end] in frequent:
            end += 1
        if end > reach:
            reach = end
            out.append((start, end))
    return out


def affected(word: str, grams: list[tuple[int, int]], frequent, inside: set[str], qmin: int = QMIN, qmax: int = QMAX) -> int:
    """The most grams of a word that one inserted, deleted or replaced code point can change.

    An edit at ``i`` changes grams over it. A gram that ends before it stays unless an earlier start, or its own, may now reach further,
    which only a start can whose letters up to ``i`` are frequent or too few for a gram. One that begins behind it stays unless a gram over
    the edit may now contain it, for which what it covers behind the edit must stand inside an extended gram.
    """
    most, n = 0, len(word)
    starts = [start for start, _ in grams]
    for i in range(n + 1):
        early = i
        for p in range(max(0, i - qmax + 1), i):
            if i - p < qmin or word[p:i] in frequent:
                early = p
                break
        near = grams[bisect_right(starts, i - qmax) : bisect_left(starts, i + qmax)]  # no other can change
        for behind in (i, i + 1)[: n - i + 1]:
            count = 0
            for start, end in near:
                if end <= i:
                    count += start >= early
                elif start >= behind:
                    count += end - behind < qmax and (word[behind : end - 1] in inside or word[behind:end] in inside)
                else:
                    count += 1
            most = max(most, count)
    return most


def merged_grams(word: str, grams: list[tuple[int, int]], bound: int, frequent) -> list[tuple[int, int]]:
    """The first ``bound + 1`` grams in order of their rarity, equal ones from left to right.

    The grams that an edit leaves alone stand in the same order in both words, so that their first one has at most ``bound`` others before it in
    either: two words an edit apart share it, and a word of equal grams is not in a list for every place.
    """
    return sorted(grams, key=lambda g: (frequent.get(word[g[0] : g[1]], 0), word[g[0] : g[1]], g))[: bound + 1]


def _list_rows(word: str, frequent, inside, qmin: int, qmax: int):
    """(bound, signature, lists) of a word."""
    grams = decompose(word, frequent, qmin, qmax)
    bound = affected(word, grams, frequent, inside, qmin, qmax)
    sign, lists = 0, set()
    for a, b in grams:
        sign |= 1 << crc32(word[a:b].encode()) % 64
    for a, b in merged_grams(word, grams, bound, frequent):
        lists |= {"L" + word[:b], "R" + word[a:]}
    if bound >= len(grams):
        plain = decompose(word, {}, qmin, qmax)
        for a, b in merged_grams(word, plain, affected(word, plain, {}, {""}, qmin, qmax), {}):
            lists |= {"l" + word[:b], "r" + word[a:]}
    return bound, sign - (sign >> 63 << 64), lists  # as a signed number of the same bits


def gram_lists(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX, share: int = SHARE) -> DataFrame:
    """(word, bound, sign, own, longer): the lists each word is merged in, and those where it looks for words longer by one."""
    frequent = words.sparkSession.sparkContext.broadcast(gram_dictionary(words, qmin, qmax, share))

    def scan(batches):
        known = frequent.value
        inside = infixes(known, qmax)
        for batch in batches:
            names = batch.column("word").to_pylist()
            bounds, signs, own, longer, ends = [], [], [], [], [0]
            for word in names:
                bound, sign, lists = _list_rows(word, known, inside, qmin, qmax)
                bounds.append(bound)
                signs.append(sign)
                n = len(word)
                own += [xxh3_64_intdigest(x, n) for x in lists]
                longer += [xxh3_64_intdigest(x, n + 1) for x in lists]
                ends.append(len(own))
            places = pa.array(ends, pa.int32())
            lists = (pa.ListArray.from_arrays(places, pa.array(np.array(x, np.uint64).view(np.int64))) for x in (own, longer))
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(bounds, pa.int32()), pa.array(signs, pa.int64()), *lists], ["word", "bound", "sign", "own", "longer"])

    tasks = max(1, -(-words.count() // TASK_WORDS))
    return words.select("word").repartition(tasks, "word").mapInArrow(scan, "word string, bound int, sign bigint, own array<bigint>, longer array<bigint>")


def near_pairs(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX, share: int = SHARE) -> DataFrame:
    """(a, b): every pair of words exactly one edit apart once, for words of at least ``2 * qmin`` code points."""
    lists = written(gram_lists(words, qmin, qmax, share))
    two = lists.select(F.explode("own").alias("at"), F.lit(False).alias("up"), "word", "bound", "sign")
    one = two.union(lists.select(F.explode("longer"), F.lit(True), "word", "bound", "sign")).alias("x")
    kept = "bit_count(x.sign & ~y.sign) <= x.bound AND bit_count(y.sign & ~x.sign) <= y.bound AND (x.up OR x.word < y.word) AND levenshtein(x.word, y.word, 1) = 1"
    met = one.join(two.alias("y"), F.expr(f"x.at = y.at AND {kept}"))
    return met.select(F.col("x.word").alias("a"), F.col("y.word").alias("b")).distinct()


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words.

    ``form``: the near word of largest n (ties: the first in code-point order) if it has ``ratio`` times the word's n; ``root``: the end of the
    way over forms. An empty table gives an empty result.
    """
    words = written(words)
    pairs = written(near_pairs(words))
    both = pairs.union(pairs.select("b", "a")).join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
    best = both.groupBy("a").agg(F.count("*").alias("n_near"), F.max("m").alias("most"), F.min_by("b", F.struct(-F.col("m"), "b")).alias("best"))
    judged = words.join(best, words["word"] == best["a"], "left")
    is_form = F.col("most") >= ratio * F.col("n")
    judged = written(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("most")).alias("form_n")))
    # Each step doubles the way that is known; n rises tenfold on it, so that a handful of steps ends it.
    way = written(judged.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = way.select(F.col("word").alias("root"), F.col("root").alias("up"))
        step = written(way.join(further, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")))
        way = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return judged.join(way, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame) -> DataFrame:
    return variants(word_counts(docs))
