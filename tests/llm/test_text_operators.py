"""The text operators against brute force on small tables with null, empty, repeated and tied rows and clashing columns."""

import hashlib
import random
import re
from html.parser import HTMLParser

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clusterloom.llm import bucket_pointer, common, compression, crf_pii, ftrl, mixing, queries, suffix_automaton, templates, token_groups, url_model, warc

PROSE = "the of and a to in is was for that it with as his on be at by had are but from or have an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years much where your way down should because long each just state those people too".split()


def _texts():
    rnd = random.Random(5)
    say = lambda n: " ".join(rnd.choice(PROSE) for _ in range(n))
    base = say(120).split()
    near = [" ".join(base[:k] + ["zz%d" % k] + base[k + 1 :]) for k in (10, 60)]
    far = " ".join(w if i % 9 else "q%d" % i for i, w in enumerate(base))
    texts = [None, "", " \n\t ", "one two", "One  TWO", " ".join(base), " ".join(base), *near, far, say(90), "lead " + " ".join(base[20:100]) + " tail", "ab" * 700, "x" + "ab" * 600, say(400), "word " * 60]
    return texts + [say(rnd.randint(3, 150)) for _ in range(25)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), i, f"x{i}") for i, t in enumerate(_texts())]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, token bigint, n_words string")


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("doc_id < 0")


def test_jaccard_components(docs, nothing):
    sets = {}
    for i, t in enumerate(_texts()):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in token_groups.jaccard_components(docs).collect()}
    assert got == {i: (len(s), root[i]) for i, s in sets.items()}
    assert token_groups.jaccard_components(nothing).count() == 0


def test_components_of_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in common.components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_repeated_bytes(docs, nothing, monkeypatch):
    raw = {i: (t or "").encode() for i, t in enumerate(_texts())}
    seen = {}
    for t in raw.values():
        for k in range(len(t) - 399):
            seen[t[k : k + 400]] = seen.get(t[k : k + 400], 0) + 1
    want = {}
    for i, t in raw.items():
        cover, reach = [], 0
        for k in range(len(t)):
            if seen.get(t[k : k + 400], 0) > 1 and k + 400 <= len(t):
                reach = k + 400
            cover.append(k < reach)
        kept = bytes(b for b, c in zip(t, cover) if not c)
        want[i] = (len(t), sum(cover), sum(c and not p for c, p in zip(cover, [False, *cover])), hashlib.sha256(kept).hexdigest())
    for limit in (16 << 20, 0):  # broadcast and shuffled joins
        monkeypatch.setattr(common.small_or_shuffled, "__defaults__", (limit,))
        assert {r.doc_id: tuple(r)[1:] for r in bucket_pointer.report(docs).collect()} == want
    assert bucket_pointer.report(nothing).count() == 0


def _brute_repeats(raw):
    """(bytes, bytes removed, runs, digest of the rest) of each text."""
    seen, want = {}, {}
    for t in raw.values():
        for k in range(len(t) - 399):
            seen[t[k : k + 400]] = seen.get(t[k : k + 400], 0) + 1
    for i, t in raw.items():
        cover, reach = [], 0
        for k in range(len(t)):
            if k + 400 <= len(t) and seen[t[k : k + 400]] > 1:
                reach = k + 400
            cover.append(k < reach)
        want[i] = (len(t), sum(cover), sum(c and not p for c, p in zip(cover, [False, *cover])), hashlib.sha256(bytes(b for b, c in zip(t, cover) if not c)).hexdigest())
    return want


def test_repeated_bytes_of_cut_texts(spark, monkeypatch):
    """Texts longer than a piece lose at a cut only what repeats; each run of starts with one anchor is one row."""
    from pyspark import cloudpickle

    rnd = random.Random(11)
    say = lambda n: "".join(rnd.choice("abcdefghijklmnopqrst ") for _ in range(n))
    long = say(9_000)
    raw = {1: long, 2: say(7_000), 3: say(300) + long[480:1_300] + say(300), 4: say(5_000) + "xy" * 700, 5: say(399), 6: say(400), 7: say(501)}
    raw = {i: t.encode() for i, t in raw.items()}
    batch = pa.RecordBatch.from_pydict({"doc_id": list(raw), "text": list(raw.values())})
    rows = lambda: sorted(tuple(r.values()) for b in bucket_pointer._anchor_scan([batch]) for r in b.to_pylist())
    whole = rows()
    df = spark.createDataFrame([(i, bytearray(t)) for i, t in raw.items()], "doc_id bigint, text binary")
    cloudpickle.register_pickle_by_value(bucket_pointer)  # the workers get the smaller piece too
    try:
        for piece in (500, 777):
            monkeypatch.setattr(bucket_pointer, "PIECE", piece)
            assert rows() == whole
            assert {r.doc_id: tuple(r)[1:] for r in bucket_pointer.report(df).collect()} == _brute_repeats(raw)
    finally:
        cloudpickle.unregister_pickle_by_value(bucket_pointer)


def _brute_hits(words, items):
    hit, owners = set(), set()
    for item, w in items:
        for win in [w[k : k + 10] for k in range(len(w) - 9)] if len(w) >= 10 else [w] if w else []:
            for k in range(len(words) - len(win) + 1):
                if words[k : k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    owners.add(item)
    return hit, owners


def test_automaton_finds_every_window():
    rnd = random.Random(3)
    for _ in range(300):
        items = [(k, [rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.choice((0, 1, 3, 12, 15)))]) for k in range(rnd.randint(0, 4))]
        words = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(rnd.randint(0, 60))]
        words += items[0][1] if items else []
        spans, owners = suffix_automaton.Automaton(items).spans(words)
        hit, want = _brute_hits(words, items)
        assert {k for a, b in spans for k in range(a, b)} == hit and owners == want


def test_decontamination(spark, docs, nothing):
    base = _texts()[5].split()
    items = [(1, " ".join(base[30:45]).upper()), (2, None), (3, ""), (4, "one, two"), (5, " ".join(base[30:45]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    whole = {r.doc_id: tuple(r)[1:] for r in suffix_automaton.report(docs, bench).collect()}
    for i, t in enumerate(_texts()):
        words = suffix_automaton.normal_words((t or "").encode())
        hit, owners = _brute_hits(words, [(k, suffix_automaton.normal_words((x or "").encode())) for k, x in items])
        assert whole[i] == (len(words), len(hit), len(owners), suffix_automaton.items_digest(owners), bool(hit))
    split = suffix_automaton.contamination(docs, bench, item_words=16)  # several automata
    assert {r.doc_id: (sum(r.spans[1::2]) - sum(r.spans[::2]), len(r.items)) for r in split.collect()} == {i: (v[1], v[2]) for i, v in whole.items()}
    one, many = (suffix_automaton.decontaminate(docs, bench, **k) for k in ({}, {"item_words": 16}))
    assert sorted(one.collect()) == sorted(many.collect()) and one.columns == docs.columns
    texts = {r.doc_id: r.text for r in one.collect()}
    assert 3 not in texts and texts[0] is None and " ".join(base[30:45]) not in texts[5]
    assert suffix_automaton.report(nothing, bench).count() == 0
    assert not any(r.contaminated for r in suffix_automaton.report(docs, bench.where("item_id = 2")).collect())


def test_several_automata_leave_rows_apart(spark):
    """Rows with equal or null ids and different texts are judged by themselves, by one automaton or by many."""
    rnd = random.Random(8)
    say = lambda n: " ".join(rnd.choice(PROSE) for _ in range(n))
    items = [say(14) for _ in range(6)]
    texts = [items[0] + " " + say(60), say(50), items[3] + " " + say(50), say(20), say(30) + " " + items[5] + " " + say(9) + " " + items[1], None, say(30) + " " + items[5] + " " + say(9)]
    ids = [1, 1, None, None, 7, 7, 7]
    rows = list(zip(ids, texts, ["own"] * 7, [[9]] * 7))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string, spans array<int>")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    key = lambda df: sorted(df.collect(), key=str)
    one, many = (suffix_automaton.contamination(docs, bench, item_words=n) for n in (300_000, 10))
    assert key(one) == key(many) and one.count() == 7
    assert sorted(len(r["items"]) for r in many.collect()) == [0, 0, 0, 1, 1, 1, 2]
    clean, clean_many = (suffix_automaton.decontaminate(docs, bench, item_words=n) for n in (300_000, 10))
    assert key(clean) == key(clean_many) and clean.schema == docs.schema
    left = [r.text for r in clean_many.collect()]
    assert len(left) == 7 and texts[1] in left and texts[3] in left and not any(t and i in t for t in left for i in items)


def test_texts_that_are_no_utf8(spark):
    """Bytes that are no UTF-8 crash no scan; they count, or come back, as U+FFFD."""
    df = spark.sql("SELECT 1L AS doc_id, string(unhex('61FF20782E7940622E636F6D20626164FE')) AS text")  # a<ff> x.y@b.com bad<fe>
    found = crf_pii.report(df).first()
    assert found.n_email == 1 and found.base_sha256 == hashlib.sha256(b"email:3:12").hexdigest()
    assert crf_pii.redact(df).first().text == "a\ufffd <EMAIL> bad\ufffd"
    bench = spark.createDataFrame([(1, "x y b com")], "item_id bigint, text string")
    assert suffix_automaton.decontaminate(df, bench, suffix_automaton.Limits(1, 1.0)).first().text == "a\ufffd  bad\ufffd"


def test_viterbi_cells_are_bounded(monkeypatch):
    import numpy as np

    w, t = crf_pii.fit(None)
    rnd = np.random.default_rng(1)
    e = [rnd.normal(size=(int(n), len(crf_pii.TAGS))) for n in rnd.integers(1, 40, 60)] + [rnd.normal(size=(300, len(crf_pii.TAGS)))]
    want = crf_pii.viterbi(e, t)
    full, most = np.full, []
    monkeypatch.setattr(crf_pii, "CELLS", 100)
    monkeypatch.setattr(np, "full", lambda shape, v, *a: most.append(shape) or full(shape, v, *a))
    assert crf_pii.viterbi(e, t) == want
    assert all(s[0] == 1 or s[0] * s[1] <= 100 for s in most if len(s) == 3)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _brute_pii(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 12 <= len(d) <= 19 and crf_pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], crf_pii.KINDS.index(s[2])))


def test_base_patterns():
    rnd = random.Random(1)
    for _ in range(20_000):
        text = "".join(rnd.choice("a1.2@+ -5(3)4é") for _ in range(rnd.randint(0, 40)))
        assert crf_pii.base_spans(text) == _brute_pii(text)


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    w, t = crf_pii.fit(None)
    rnd = np.random.default_rng(0)
    for n in (1, 2, 3):
        e = rnd.normal(size=(n, len(crf_pii.TAGS)))
        tr = t + crf_pii._may_follow()
        best = max(itertools.product(range(len(crf_pii.TAGS)), repeat=n), key=lambda y: tr[0, y[0]] + sum(e[k, y[k]] for k in range(n)) + sum(tr[y[k], y[k + 1]] for k in range(n - 1)) + tr[y[-1], 0])
        assert crf_pii.viterbi([e], t)[0] == list(best)


def test_personal_data(spark, nothing):
    text = "é ask anna.b@x.example.org, call (202) 555-0147 or +1 (202) 555-0143; from 10.0.0.7 in 2024, page 12"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "no data at all " * 50)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in crf_pii.report(df).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone, got[1].n_added) == (1, 1, 0, 1, 1)
    assert got[1].base_sha256 == hashlib.sha256(crf_pii.joined(_brute_pii(text)).encode()).hexdigest()
    assert all(got[k].spans == "" for k in (2, 3, 4))
    clean = {r.doc_id: r.text for r in crf_pii.redact(df).collect()}
    assert clean[1] == "é ask <EMAIL>, call <PHONE> or <PHONE>; from <IP> in 2024, page 12" and clean[2] is None
    assert crf_pii.report(nothing).count() == 0


def test_compression_counts(docs, nothing):
    got = {r.doc_id: r for r in compression.report(docs).collect()}
    for i, t in enumerate(_texts()):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        covered = {k + j for k, r in enumerate(runs) if runs.count(r) > 1 for j in range(8)}
        assert (got[i].n_words, got[i].word_chars, got[i].n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert got[i].base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (got[i].base_failed and got[i].kept)
    assert got[14].kept and not got[12].kept
    assert compression._dup_lines(b"a\n\na\n \nb\na") == 2
    assert compression.report(nothing).count() == 0


def test_classifier_on_held_out_rows(spark, sf_dir, nothing):
    d, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    doubled = labels.union(labels.limit(3)).union(spark.createDataFrame([(None, 1, 0), (10**9, 1, 0), (1, None, None)], labels.schema))
    scored = ftrl.report(d, doubled)
    held = scored.join(labels, "doc_id").where("held_out AND quality = 1").collect()
    assert held and all(r.predicted == 1 for r in held)
    assert ftrl.score(nothing, ftrl.fit(nothing, labels.limit(0))).count() == 0


def test_classifier_tells_both_classes_apart(spark):
    """Held-out rows of two kinds of text: ranked by score, and both classes predicted."""
    rnd = random.Random(6)
    poor = "buy now cheap click here win free offer deal best price subscribe limited".split()
    text = lambda good: " ".join(rnd.choice(PROSE if good or rnd.random() < 0.5 else poor) for _ in range(rnd.randint(20, 60)))
    marks = [int(rnd.random() < 0.6) for _ in range(500)]
    docs = spark.createDataFrame([(k, text(m), "q", None) for k, m in enumerate(marks)], "doc_id bigint, text string, score string, quality int")
    labels = spark.createDataFrame([(k, m, 0) for k, m in enumerate(marks)], "doc_id bigint, quality int, toxic int")
    got = [(r.score, r.predicted, marks[r.doc_id]) for r in ftrl.report(docs, labels).collect() if r.held_out]
    good, bad = ([s for s, _, m in got if m == k] for k in (1, 0))
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert len(good) > 20 and len(bad) > 20 and auc > 0.95
    right = sum(p == m for _, p, m in got) / len(got)
    assert right > 0.9 and {p for _, p, _ in got} == {0, 1}


def test_main_text(spark):
    page = "<html><head><title>t</title></head><body><nav>menu</nav><div class='foo'>Same box</div><article><h1>Head %d</h1><p>One &amp;<b> two<br>three<p>Four<div class=share>x</div><section>Box of the site</section></article><footer>f"
    rows = [(k, f"http://A.org/{k}", page % k) for k in range(6)] + [(7, None, None), (8, "x", ""), (9, "http://b.org", "plain <b>text"), (9, "http://b.org", "plain <b>text")]
    got = sorted((r.page_id, r.text, r.n_chars) for r in templates.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect())
    assert [g[1] for g in got[:6]] == [f"Head {k}\n\nOne & two three\n\nFour" for k in range(6)]
    assert [g[1:] for g in got[6:]] == [("", 0), ("", 0), ("plain text", 10), ("plain text", 10)]


def test_deep_markup_is_read_in_one_pass():
    import time

    start = time.perf_counter()
    for source in ("<div>" * 100_000 + "</section>" * 100_000, "<article>" + "<div><h1>x</h1>" * 50_000 + "</p>" * 100_000, "<b>" * 100_000 + "</i>text</u>" * 50_000):
        templates.Page(source).main_text()
    assert time.perf_counter() - start < 12
    assert templates.Page("<article><header><div><h1>Head</h1></div></header><header>gone</header><p>t</section></p></article>").main_text() == "Head\n\nt"


def test_copies_of_pages_are_no_templates(spark):
    """Copies, whatever their url, stay whole; what recurs on different pages beside them goes."""
    article = "<body><nav>%s</nav><article><h1>Head</h1><p>Story</p><section>Own section</section><ul><li>Own list</ul></article>"
    plain = "<body><h1>Plain</h1><p>Text of it</p><div>And a box</div>"
    rows = [(k, f"http://a.org/{k}", article % k) for k in range(8)] + [(k, None, plain) for k in range(10, 18)]
    rows += [(k, f"http://b.org/{k % 3}", f"<article><h1>N{k // 2}</h1><p>Say {k // 2}</p><section>Site box</section></article>") for k in range(20, 34)]
    got = {r.page_id: r.text for r in templates.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(got[k] == "Head\n\nStory\n\nOwn section\n\nOwn list" for k in range(8))
    assert all(got[k] == "Plain\n\nText of it\n\nAnd a box" for k in range(10, 18))
    assert all(got[k] == f"N{k // 2}\n\nSay {k // 2}" for k in range(20, 34))


def test_url_rules(spark):
    urls = ["http://a.net/x", "https://b.Example.NET/en/1", "http://example.net/de", "ftp://x.example.com/de/a?b", "http://w.org/fr/", "http://worg/fr/", "net/", None, "", "http://net", "http://a.net/x"]
    got = {r.page_id: r for r in url_model.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")).collect()}
    assert [got[k].rule for k in range(len(urls))] == ["net/", "example.net/en/", "net/", "example.com/de/", "org/fr/", None, None, None, None, None, "net/"]
    assert got[1].host == "b.example.net" and got[7].host == got[6].path == "" and got[9].path == ""


def test_url_models_learn_from_every_ruled_url(spark, monkeypatch):
    rnd = random.Random(2)
    name = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 9)))
    urls = [f"http://{name()}.{('net', 'example.net', 'org', 'com')[k % 4]}/{('x', 'en', 'fr', 'de')[k % 4]}/{name()}" for k in range(600)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    learnt, train = [], url_model.train
    monkeypatch.setattr(url_model, "TRAIN_URLS", 20)
    monkeypatch.setattr(url_model, "train", lambda rows: learnt.append(rows.count()) or train(rows))
    got = url_model.filter_urls(df).collect()
    held = {k for k in range(len(urls)) if int(hashlib.md5(str(k).encode()).hexdigest()[8:16], 16) / 2**32 < 0.2}
    assert learnt == [sum(r.rule is not None and r.page_id not in held for r in got)] and learnt[0] > 300
    cut = sorted(r.score for r in got if r.page_id in held and r.rule in ("example.net/en/", "org/fr/"))
    at = (len(cut) - 1) * url_model.MISSED
    cut = cut[int(at)] + (cut[int(at) + 1] - cut[int(at)]) * (at - int(at))
    assert all((r.verdict == "allow") == (r.score >= cut) for r in got if r.rule is None and abs(r.score - cut) > 1e-9)


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a", "<html lang=de><head><title> A  b </title></head><p>x &lt; y</p><script>no</script>z"), (2, None, None), (3, "http://c", "")]
    out = warc.report(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    got = {(r.page_id, r.warc_type): r for r in out.collect()}
    assert len(got) == 6 and got[1, "conversion"].body == "x < y\nz" and "title: A b\r\nlanguage: de\r\n" in got[1, "metadata"].body
    assert got[1, "conversion"].refers_to == got[1, "metadata"].refers_to and got[2, "conversion"].body == ""
    warc.write_records(out, str(tmp_path / "w"))
    back = {r.record_id: r for r in warc.read_records(spark, str(tmp_path / "w")).collect()}
    assert all(back[r.record_id].body == r.body and back[r.record_id].whole and back[r.record_id].refers_to == r.refers_to for r in got.values())


class _Reader(HTMLParser):
    """Text of a page by a parser: no head, scripts, styles or comments; a line break at each block tag."""

    GONE = {"script", "style", "noscript", "template", "head"}
    LINES = set("address article aside blockquote br dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tr ul".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.gone = [], []

    def handle_starttag(self, tag, attrs):
        if tag in self.GONE:
            self.gone.append(tag)
        elif tag in self.LINES:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in self.GONE and tag in self.gone:
            del self.gone[self.gone.index(tag) :]
        elif tag in self.LINES:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.gone:
            self.out.append(data)


def test_plain_text_against_a_parser(spark, sf_dir):
    """Real heads with scripts before the title, unclosed elements, references of every kind; and all given pages."""
    head = "<html><head><meta charset=utf-8><script>if (a < b) t = '<title>no</title>';</script><style>p > a {}</style><title>TITLE</title><script src=x></script></head>"
    made = [head + "<body><p>It&#8217;s &#x201C;quoted&#X201d; &mdash; caf&eacute; &amp;lt; &copy; AT&T &unknown; &#0; &#55555;</p><!-- a <p>b</p> --><div>x&nbsp;y</div>", "<p>a<script>no", "<HEAD ><TITLE>t</TITLE></HEAD >b<BR/>c", "a &notit; &#1114112; &#xD800; &; &#; &#x; b &ngE;"]
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    rows = spark.createDataFrame([(-k, "u", p) for k, p in enumerate(made, 1)], pages.schema).union(pages)
    got = {(r.page_id, r.target_uri, r.warc_type): r.body for r in warc.report(rows).collect()}
    blank = lambda s: re.sub(" ?\n[ \n]*", "\n", re.sub("[ \t\r\f]+", " ", s)).strip(" \n")
    assert got[-1, "u", "conversion"] == "It\u2019s \u201cquoted\u201d \u2014 caf\u00e9 &lt; \u00a9 AT&T &unknown; \ufffd \ufffd\nx\u00a0y"
    assert [got[-k, "u", "conversion"] for k in (2, 3)] == ["a", "b\nc"]
    assert got[-4, "u", "conversion"] == "a &notit; \ufffd \ufffd &; &#; &#x; b \u2267\u0338" and "title: TITLE" in got[-1, "u", "metadata"]
    for p in pages.collect():
        reader = _Reader()
        reader.feed(p.html or "")
        reader.close()
        # a parser decodes what stands between tags before blanks are joined
        assert blank(got[p.page_id, p.url or "", "conversion"].replace("\u00a0", " ")) == blank("".join(reader.out).replace("\u00a0", " "))


def test_plain_text_is_made_once(spark, sf_dir):
    """Decoding references names its input several times; the steps before it stand once in the plan. Every named reference is found in its group."""
    rows = spark.createDataFrame([(1, "u", " ".join(f"&{name};" for name in warc.NAMES))], "page_id bigint, url string, html string")
    out = warc.report(rows)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("address|article") == 1
    body = out.where("warc_type = 'conversion'").first().body
    assert body == " ".join(warc.NAMES.values()).strip(" \n")


def test_runs_of_blanks(spark):
    made = ["a b", "a  b", "a\tb", " \ta\r\f b\f", "a \t", "\t \n a", ""]
    pattern, by = warc.TEXT_STEPS[-2]
    got = [r[0] for r in spark.createDataFrame([(m,) for m in made], "t string").select(warc.stripped(F.col("t"), warc.TEXT_STEPS[-2:-1])).collect()]
    assert got == [re.sub(pattern, by, m) for m in made]


def test_mixing(spark, sf_dir, nothing):
    cells = spark.createDataFrame([(100, 0, 50), (20, 80, 30), (60, 40, 20)], "h0 int, h1 int, tokens bigint")
    rate = mixing._rate(mixing.fit_rates(cells, [0.8, 0.2]))
    got = cells.select("*", rate.alias("r")).toPandas()
    assert (got.r >= 0).all() and abs((got.tokens * got.h0 * got.r).sum() / 10_000 - 0.8) < 1e-6 and abs((got.tokens * got.h1 * got.r).sum() / 10_000 - 0.2) < 1e-6
    d, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    out = mixing.report(d, labels).toPandas()
    error = lambda rate: sum(((out.n_tokens * out[f"p_{k}"] * rate).sum() / out.n_tokens.sum() - t) ** 2 for k, t in mixing.TARGETS.items())
    assert len(out) == d.count() and (out.rate >= 0).all() and error(out.rate) < error(1.0)
    assert mixing.report(nothing, labels).count() == 0


def test_sql_twins(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, sf_dir)
        columns = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(columns).collect()), name


def test_classifier_hashes_few_texts_at_once(monkeypatch):
    """Workers of all cores share an executor's memory: what is hashed at once stays small, and pieces change no score."""
    import numpy as np
    import pyarrow as pa

    from clusterloom.llm import ftrl

    sizes, real = [], ftrl._features
    monkeypatch.setattr(ftrl, "_features", lambda texts: sizes.append(sum(map(len, texts))) or real(texts))
    texts = [b"", *(b"word%d other " % k * 2_000 for k in range(60))]
    weights = np.random.default_rng(0).normal(size=ftrl.BUCKETS + 1)
    scores = ftrl._scores(pa.array(texts, pa.binary()), weights)
    assert max(sizes) <= 1 << 20 and len(scores) == len(texts)
    alone = [ftrl._scores(pa.array([t], pa.binary()), weights)[0] for t in texts]
    assert np.allclose(scores, alone, rtol=1e-12)


def test_classifier_weights_come_in_columns(spark, sf_dir, monkeypatch):
    """The sums of an epoch, up to 262,145 rows, reach the driver without an object for each."""
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")

    def as_rows(*_):
        raise AssertionError("weights fetched row by row")

    monkeypatch.setattr(type(docs), "toPandas", as_rows)
    weights = ftrl.fit(docs, labels)
    assert weights.shape == (ftrl.BUCKETS + 1,) and np.isfinite(weights).all() and weights.any()


def test_classifier_keeps_no_second_copy_of_its_rows():
    """A task of the training holds its rows and a few vectors of weights."""
    import tracemalloc
    from types import SimpleNamespace

    import pandas as pd

    rng = np.random.default_rng(6)
    rows = pd.DataFrame({"doc_id": range(300), "label": [k % 2 for k in range(300)]})
    rows["bucket"] = [rng.choice(ftrl.BUCKETS, 10_000, replace=False).astype(np.int32) for _ in range(300)]
    rows["value"] = [np.full(10_000, 0.01) for _ in range(300)]
    fit = ftrl._shard_fit(SimpleNamespace(value=np.zeros(ftrl.BUCKETS + 1)), ftrl.Settings(passes=1))
    tracemalloc.start()
    out = fit(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) and peak < 36_000_000  # the rows' size


def test_classifier_trains_on_views_of_its_arrow_rows():
    """Words and values of a shard are not copied, whatever batches and order its rows come in, and the weights are those of plain columns."""
    from types import SimpleNamespace

    rng = np.random.default_rng(7)
    bucket = [np.sort(rng.choice(ftrl.BUCKETS, n, replace=False)).astype(np.int32) for n in (0, 5, 700, 30, 1)]
    value = [np.full(len(b), 0.1) for b in bucket]
    plain = {"doc_id": [4, 2, 9, 1, 7], "label": [1, 0, 1, 0, 1], "bucket": bucket, "value": value}
    types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64())]
    rows = pa.table([pa.array([list(v) if np.ndim(v) else v for v in c], t) for c, t in zip(plain.values(), types)], names=list(plain))
    rows = pa.concat_tables([rows.slice(0, 2), rows.slice(2)])
    held = [v for c in ("bucket", "value") for v in (chunk.values.to_numpy() for chunk in rows[c].chunks)]
    columns = ftrl._columns(rows)
    assert all(any(np.shares_memory(v, whole) for whole in held) for c in ("bucket", "value") for v in columns[c] if len(v))
    start = SimpleNamespace(value=np.zeros(ftrl.BUCKETS + 1))
    assert ftrl._arrow_fit(start, ftrl.Settings())(rows).equals(ftrl._shard_fit(start, ftrl.Settings())(plain))
