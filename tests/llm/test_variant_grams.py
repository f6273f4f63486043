"""Spelling variants: the gram bound against random edits, and the whole result against every pair of words."""

import random
from collections import Counter
from zlib import crc32

import pytest

from clusterloom.llm import variant_grams as vg


def _edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word) and c != word[i]:
                yield word[:i] + c + word[i + 1 :]
        if i < len(word):
            yield word[:i] + word[i + 1 :]


@pytest.mark.parametrize("qmin, qmax, limit", [(2, 3, 20), (2, 4, 8), (3, 5, 5), (2, 3, 0)])
def test_bound_holds_for_every_edit(qmin, qmax, limit):
    rnd = random.Random(qmin * qmax)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(2 * qmin, 11))) for _ in range(60)]
    counts = Counter(w[i : i + q] for w in words for q in range(qmin, qmax + 1) for i in range(len(w) - q + 1))
    frequent = {g: c for g, c in counts.items() if c > limit}
    inside = vg.infixes(frequent, qmax)

    def parts(w):
        grams = vg.decompose(w, frequent, qmin, qmax)
        return grams, vg.affected(w, grams, frequent, inside, qmin, qmax)

    for w in words:
        grams, bound = parts(w)
        mine = Counter(w[a:b] for a, b in grams)
        for v in _edits(w, "abcd"):
            others, other_bound = parts(v)
            both = sum((mine & Counter(v[a:b] for a, b in others)).values())
            assert both >= max(len(grams) - bound, len(others) - other_bound)
            if len(v) >= 2 * qmin:
                assert vg._list_rows(w, frequent, inside, qmin, qmax)[2] & vg._list_rows(v, frequent, inside, qmin, qmax)[2]


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _brute(counts):
    near = {w: [v for v in counts if _near(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(near[w]), None if form[w] is None else counts[form[w]]) for w in counts}


def test_variants_against_every_pair(spark):
    rnd = random.Random(2)
    bases = ["".join(rnd.choice("abéz") for _ in range(rnd.randint(7, 9))) for _ in range(12)]
    counts = {}
    for b in bases:
        counts[b] = rnd.choice((2, 30, 400))
        for v in rnd.sample(list(_edits(b, "abéz")), 12):
            if len(v) >= 7:
                counts.setdefault(v, rnd.choice((2, 3, 25)))
    counts |= {"aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaaaab": 200, "aaaaaaabb": 2_000, "zzzzzzzzz": 5}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    want = _brute(counts)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in vg.variants(words).collect()} == want
    assert want["aaaaaaa"][:2] == ("aaaaaaaa", "aaaaaaabb")
    assert vg.variants(words.where("n < 0")).count() == 0


def test_words_of_texts(spark):
    rnd = random.Random(4)
    say = ["Running", "runnings", "Élégance", "élégance", "short", "x1longest2word", "combination", "COMBINATION", "a" * 40]
    texts = [None, "", "  ", *(" ".join(rnd.choice(say) for _ in range(rnd.randint(1, 80))) for _ in range(30))]
    rows = [(k, t, "clash", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, word string, n int")
    counts = Counter()
    import re

    for k, t in enumerate(texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = crc32(f"{k}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    counts = {w: n for w, n in counts.items() if n >= 2}
    assert {r.word: r.n for r in vg.word_counts(docs).collect()} == counts
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in vg.report(docs).collect()} == _brute(counts)
    assert vg.report(docs.where("doc_id < 0")).count() == 0


def test_long_words_are_in_few_lists():
    for word in ("a" * 20_000, "xy" * 10_000, "abcdefghijklmnop" * 1_000):
        counts = Counter(word[i : i + q] for q in (2, 3) for i in range(len(word) - q + 1))
        lists = [vg._list_rows(w, counts, vg.infixes(counts), 2, 3)[2] for w in (word, word[:500] + word[501:], word[:-1], word + "z", word[:700] + "é" + word[701:])]
        assert all(len(found) < 50 and found & lists[0] for found in lists)
