"""Fill-in-middle cuts: hand-made texts, units by another route, and the exact way back."""

import hashlib
import re

import pytest
import regex

from clusterloom.llm import fill_middle as fim

TEXTS = [None, "", "a", "a\n", "\n", "\n\n\n", "one\ntwo\r\nthree", "tail without end", "x <P> y\nz", "has <M>\n", "<S", "ends in <\n<", "S> first\n<", "née\n\U0001f600 same line\n", "l\n" * 5_000, "w" * 300_000 + "\nz"]


def _brute(doc, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{doc}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 50 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "x", k) for k, t in enumerate(TEXTS * 3)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, form string, n int")


def test_cuts_and_way_back(docs):
    cuts = {r.doc_id: r for r in fim.restore(fim.fill_in_middle(docs)).collect()}
    assert len(cuts) == 3 * len(TEXTS)
    for k, t in enumerate(TEXTS * 3):
        r = cuts[k]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, bytes(r.output).decode()) == _brute(k, t)
        assert bytes(r.restored).decode() == (t or "")
    assert {r.form for r in cuts.values()} == {"plain", "psm", "spm"}
    sums = {r.doc_id: (r.output_sha256, r.restored_sha256) for r in fim.report(docs).collect()}
    assert sums[6] == tuple(hashlib.sha256(bytes(b)).hexdigest() for b in (cuts[6].output, cuts[6].restored))


def test_parameters_and_odd_rows(spark, docs):
    assert {r.form for r in fim.fill_in_middle(docs, percent=0).collect()} == {"plain"}
    words = fim.fill_in_middle(docs, unit=r"\s*+\S++|\s++", spm_percent=100).where("form <> 'plain'")
    assert {r.form for r in words.collect()} == {"spm"}
    assert all(bytes(r.restored).decode() == (TEXTS * 3)[r.doc_id] for r in fim.restore(words).collect())
    with pytest.raises(ValueError):
        fim.cut("ab", [0, 0, 0, 0], regex.compile("(a)*+"), 100, 50)
    odd = spark.createDataFrame([(None, "a\nb\n"), (None, "a\nb\n"), (1, "c\n")], "doc_id bigint, text string")
    odd = odd.union(spark.sql("SELECT 2L, string(unhex('61FF620A80'))"))  # no UTF-8
    back = fim.restore(fim.fill_in_middle(odd)).collect()
    assert sorted(bytes(r.restored) for r in back) == [b"a\nb\n", b"a\nb\n", b"a\xffb\n\x80", b"c\n"]
    assert fim.report(odd.where("doc_id < 0")).count() == 0
