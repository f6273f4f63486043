"""Repeated word spans: brute force on texts with copies, near copies, shared passages, cycles and odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from clusterloom.llm import debruijn


def _brute(rows, window=20):
    """rows: (id, text) of different ids -> id: (n_words, n_removed, kept)."""
    seen, want = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone.update(range(i, i + window))
            seen.add(w)
        want[doc] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone).encode())
    return want


def _rows():
    rnd = random.Random(13)
    vocabulary = [f"w{k}" for k in range(300)] + ["Été", "the", "The"] * 40
    say = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passage, base, line = say(70), say(220), say(19)
    texts = [None, "", " \n\t ", "one two", " ".join(base), "\n".join(base), " ".join(base[:110] + ["zz"] + base[111:])]
    texts += [" ".join(say(15) + passage[rnd.randint(0, 20) : rnd.randint(40, 70)] + say(rnd.randint(0, 30)) + (line if k % 2 else [])) for k in range(25)]
    texts += ["a " * 90, "a b " * 40, "b a " * 30, " ".join(passage[:20]), " ".join(passage[:19]), " ".join(passage * 3), " ".join(base[100:140] + base[:60] + base[100:140])]
    texts += [" ".join(rnd.choice("xy") for _ in range(rnd.randint(10, 300))) for _ in range(12)]
    rnd.shuffle(texts)
    return [(k * 3 - 20, t) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "q", 5, None) for i, t in _rows()], "doc_id bigint, text string, bucket string, t int, first string")


def test_spans_against_brute_force(docs):
    want = _brute(_rows())
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in debruijn.dedup(docs).collect()}
    assert got == want and sum(n for _, n, _ in want.values()) > 1_000
    sums = {r.doc_id: r.kept_sha256 for r in debruijn.report(docs.repartition(7)).collect()}
    assert sums == {i: hashlib.sha256(k).hexdigest() for i, (_, _, k) in want.items()}
    short = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in debruijn.dedup(docs, window=5, gram=2).collect()}
    assert short == _brute(_rows(), 5)
    assert debruijn.report(docs.where("doc_id IS NULL")).count() == 0


def test_equal_and_missing_ids(spark):
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 99)}" for _ in range(40)]
    text, other = " ".join(base), " ".join(["x"] + base[5:35])
    rows = [(None, text), (1, other), (1, other), (1, "short"), (2, text), (2, text)]
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in debruijn.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(0, 40, 0), (1, 1, 0), (1, 31, 30), (1, 31, 30), (2, 40, 40), (2, 40, 40)]


def test_least_of_each_reach_across_blocks(monkeypatch):
    rnd = np.random.default_rng(1)
    grams = rnd.integers(0, 40, 500, dtype=np.uint64) << np.uint64(40)
    want = [i + int(np.argmin(grams[i : i + 15])) for i in range(486)]
    for block in (1 << 20, 64, 7):
        monkeypatch.setattr(debruijn, "BLOCK", block)
        assert debruijn._least(grams, 15).tolist() == want
    assert debruijn._least(grams[:10], 15).tolist() == []


def test_bytes_that_are_no_utf8(spark):
    rows = spark.sql("SELECT id AS doc_id, string(unhex(repeat('FF20', 25))) AS text FROM range(2)")
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in debruijn.dedup(rows).collect()}
    assert got == {0: (25, 24, b"\xff"), 1: (25, 25, b"")}
