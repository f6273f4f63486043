"""Benchmark decontamination by a generalised suffix automaton of normalised test items.

All items go into one automaton over word ids. Documents stream through it: after each word the state knows the longest
run of words, ending here, that any item contains. Where that run reaches the window length its words are hit; spans and
whole documents are then removed by length and coverage limits.

Scale: documents are scanned where they lie, nothing is shuffled. The automaton is broadcast; a benchmark of more than
``ITEM_WORDS`` words is split into several automata, which the rows pass one after the other and gather their spans.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.common import small_batches, text_bytes, written

WINDOW = 10
#: Words of one automaton: at most twice as many states, some 100 MB when broadcast.
ITEM_WORDS = 300_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def normal_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return _WORD.findall(text.translate(_LOWER))


class Automaton:
    """Generalised suffix automaton of the word sequences of ``items`` ((item id, words), ...)."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window, self.ids = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(i, w) for i, w in items if w]
        ends = []
        for _, words in items:
            state, path = 0, []
            for w in words:
                state = self._extend(state, self.ids.setdefault(w, len(self.ids)))
                path.append(state)
            ends.append(path)
        self.shortest = min([window, *(len(w) for _, w in items)]) if items else window
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        # For each state: its ancestor (or itself) that holds the window ending here, and the short items that end here.
        self.at_window = array("q", [-1]) * len(self.link)
        self.owners: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, object]]] = {}
        for s in order[1:]:
            self.at_window[s] = s if self.length[self.link[s]] < window <= self.length[s] else self.at_window[self.link[s]] if self.length[s] >= window else -1
        for (item, words), path in zip(items, ends):
            for s in path[window - 1 :]:
                self.owners.setdefault(self.at_window[s], set()).add(item)
            if len(words) < window:
                s = path[-1]
                while self.length[self.link[s]] >= len(words):
                    s = self.link[s]
                self.short.setdefault(s, []).append((len(words), item))
        # The nearest ancestor (or itself) that is the state of a short item, to walk only those.
        self.short_up = array("q", [-1]) * len(self.link)
        for s in order[1:]:
            self.short_up[s] = s if s in self.short else self.short_up[self.link[s]]

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = len(link)
        nxt.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(link)
        nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged (first word, end word) spans of window occurrences, and the items they belong to."""
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        known = np.concatenate(([False], ids >= 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1])
        found, items = [], set()
        for a, b in edges.reshape(-1, 2)[np.diff(edges)[::2] >= self.shortest].tolist() if len(edges) else []:
            self._stream(ids[a:b].tolist(), a, found, items)
        return found, items

    def _stream(self, ids: list[int], at: int, found: list, items: set) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        s = n = 0
        for j, c in enumerate(ids, at + 1):
            while s and c not in nxt[s]:
                s = link[s]
                n = length[s]
            if c in nxt[s]:
                s, n = nxt[s][c], n + 1
            hit = 0
            if n >= window:
                hit = n
                items |= self.owners[self.at_window[s]]
            u = self.short_up[s]
            while u >= 0:
                for size, item in self.short[u]:
                    if size <= n:
                        hit = max(hit, size)
                        items.add(item)
                u = self.short_up[link[u]] if link[u] >= 0 else -1
            if hit:
                start = j - hit
                while found and found[-1][1] >= start:
                    start = min(start, found.pop()[0])
                found.append((start, j))


class Limits(NamedTuple):
    """Spans of at least ``span_words`` words are cut out; documents hit by more than ``coverage`` of their words go whole."""

    span_words: int = 1
    coverage: float = 0.5


def _item_groups(bench: DataFrame, item_col: str, text_col: str, limit: int):
    """Groups of items of at most ``limit`` words (a longer item stands alone), streamed from the table."""
    group, size = [], 0
    for row in bench.select(F.col(item_col), F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))).toLocalIterator():
        words = normal_words(bytes(row[1]))
        if group and size + len(words) > limit:
            yield group
            group, size = [], 0
        group.append((row[0], words))
        size += len(words)
    if group:
        yield group


_WORDS, _SPANS, _ITEMS = "_hit_words", "_hit_spans", "_hit_items"


def _union(spans: list[tuple[int, int]]) -> list[int]:
    """Merged spans as [start, end, ...]."""
    whole: list[int] = []
    for a, b in sorted(spans):
        if whole and a <= whole[-1]:
            whole[-1] = max(whole[-1], b)
        else:
            whole += [a, b]
    return whole


def _hit_scan(shared, text_col: str):
    """Count the words and add the spans and items that an automaton finds to those a row brings along; all its columns stay, in their order."""

    def scan(batches):
        automaton = shared.value
        for batch in batches:
            n, spans, items = [], [], []
            for text, before, named in zip(batch.column(text_col), batch.column(_SPANS).to_pylist(), batch.column(_ITEMS).to_pylist()):
                words = normal_words(text.as_py() or b"")
                found, owners = automaton.spans(words)
                n.append(len(words))
                spans.append(_union([*found, *zip(before[::2], before[1::2])]))
                items.append(sorted({*named, *map(str, owners)}))
            new = {_WORDS: pa.array(n, pa.int64()), _SPANS: pa.array(spans, pa.list_(pa.int64())), _ITEMS: pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], batch.schema.names)

    return scan


def _hits(rows: DataFrame, text_col: str, bench: DataFrame, item_col: str, item_text_col: str, window: int, item_words: int) -> DataFrame:
    """``rows`` (``text_col`` is binary) with the merged spans and the items of all automata, one after the other over the rows themselves: each row
    keeps what it is, whatever its id. Between two automata the rows are written, so that one at a time stands in the tasks."""
    spark = rows.sparkSession
    rows = rows.withColumns({_WORDS: F.lit(0).cast("bigint"), _SPANS: F.array().cast("array<bigint>"), _ITEMS: F.array().cast("array<string>")})
    groups, shared = _item_groups(bench, item_col, item_text_col, item_words), None
    for group in chain([next(groups, [])], groups):
        if shared is not None:
            rows = written(rows)
            shared.unpersist()
        shared = spark.sparkContext.broadcast(Automaton(group, window))
        rows = rows.mapInArrow(_hit_scan(shared, text_col), rows.schema)
    return rows


def contamination(docs: DataFrame, bench: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text", window: int = WINDOW, item_words: int = ITEM_WORDS) -> DataFrame:
    """(doc_id, n_words, spans, items): merged word spans [start, end, ...] that hold benchmark windows, and the items (as
    sorted strings), for every row. A window is ``window`` words of an item, or the whole of a shorter one. Null and empty texts and items
    have no words and never match; repeated items and rows all count, ids may be equal or null; an empty benchmark hits nothing."""
    small_batches(docs.sparkSession)
    found = _hits(text_bytes(docs, id_col, text_col), "text", bench, item_col, item_text_col, window, item_words)
    return found.select("doc_id", F.col(_WORDS).alias("n_words"), F.col(_SPANS).alias("spans"), F.col(_ITEMS).alias("items"))


def _without(raw: bytes, n: int, pairs: list[tuple[int, int]], limits: Limits) -> bytes | None:
    """The text without its hit spans; null if the whole text must go."""
    if sum(b - a for a, b in pairs) > limits.coverage * n:
        return None
    at = [m.span() for m in _WORD.finditer(raw.translate(_LOWER))]
    keep, pos = [], 0
    for a, b in pairs:
        if b - a >= limits.span_words:
            keep.append(raw[pos : at[a][0]])
            pos = at[b - 1][1]
    return b"".join([*keep, raw[pos:]])


def _clean_scan(text_col: str, names: list[str], limits: Limits):
    def scan(batches):
        for batch in batches:
            texts, keep = [], []
            for text, n, flat in zip(batch.column(text_col), batch.column(_WORDS).to_pylist(), batch.column(_SPANS).to_pylist()):
                raw = text.as_py()
                clean = _without(raw, n, list(zip(flat[::2], flat[1::2])), limits) if flat else raw
                texts.append(None if clean is None else clean.decode("utf-8", "replace"))
                keep.append(not flat or clean is not None)
            done = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(done, names).filter(pa.array(keep, pa.bool_()))

    return scan


def decontaminate(docs: DataFrame, bench: DataFrame, limits: Limits = Limits(), text_col="text", item_col="item_id", item_text_col="text", window: int = WINDOW, item_words: int = ITEM_WORDS) -> DataFrame:
    """``docs`` with every hit span cut out of the texts; a document whose hit share exceeds the coverage limit is left out.
    All columns stay; clean texts (null included) are unchanged, but for bytes that are no UTF-8, which become U+FFFD. Rows are judged
    one by one, so that ids do not matter. One scan without a shuffle; a benchmark of several automata writes the rows between them."""
    small_batches(docs.sparkSession)
    found = _hits(docs.withColumn(text_col, F.col(text_col).cast("binary")), text_col, bench, item_col, item_text_col, window, item_words)
    return found.mapInArrow(_clean_scan(text_col, docs.columns, limits), docs.schema)


def report(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """Counts per document: n_words, n_hit (words in any window), n_items, items_sha256, contaminated."""
    c = contamination(docs, bench)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: x - s)  # alternating sum: ends minus starts
    n_hit = F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("long"))
    return c.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def items_digest(items) -> str:
    """The digest of item ids as ``report`` makes it."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
