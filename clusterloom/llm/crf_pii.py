"""Personal data: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The field tags whitespace-separated tokens by their shapes (kind of characters, digit counts, separators, the Luhn sum,
the word before). Only tokens with a digit or an ``@`` may carry a tag; every other token is fixed to O, so the chain falls apart,
exactly, into maximal runs of such tokens, and all runs of a batch are decoded together by Viterbi in NumPy.

Scale: one scan, no shuffle. The weights (some thousand numbers) are trained on the driver from a small labelled table.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.common import small_batches, text_bytes

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
CELLS = 1 << 16
FEATURES = 1 << 12
#: Largest labelled table that is trained from.
LABELLED_ROWS = 10_000
PASSES = 200

# Labelled lines: spans are marked [kind:text]. Everything else is no personal data.
LABELLED = """
write to [email:anna.berg@mail.example.org] for the list
contact: [email:j.smith99@corp.example.com], or come by
mail [email:info+news@shop.example.net]; we answer soon
(see [email:x_y-z@uni.example.edu])
send it to [email:müller@post.example.de] today
reach [email:li@localhost] on the machine
the address [email:first.last@example] was lost
follow @anna99 and @team for news
handle @user_12 posted it
server [ip:10.0.12.7] was down
from [ip:192.168.1.254], port 8080
host [ip:172.16.254.1]:443 answered
log [ip:203.0.113.45] - - GET
client [ip:2001:db8:85a3:0:0:8a2e:370:7334] joined
peer [ip:fe80:0:0:0:202:b3ff:fe1e:8329] left
version 1.2.3 and 4.0.1 are old
release 10.4.0.2024 is out
section 3.1.4 of part 2
paid with [card:4111 1111 1111 1111] in March
card [card:5500-0000-0000-0004] was declined
number [card:378282246310005] on file
visa [card:4012888888881881], expires 12/29
cards [card:6011111111111117] and [card:4222222222222] failed
both [card:4012888888881881] [card:6011111111111117] are mine
paid by [card:4111.1111.1111.1111] online
order 1234567890123456 was sent
invoice 20240017788991 is open
isbn 978-3-16-148410-0 in print
serial 9876543210987654 of the part
call [phone:+1 (202) 555-0143] now
tel. [phone:+44 20 7946 0958], evenings
phone [phone:+49 30 901820] or
phone [phone:(202) 555-0199] after nine
call [phone:202-555-0117] today
tel [phone:030 901820 44] in Berlin
mobile [phone:0171 2345678] or
call [phone:555-0134] at home
fax [phone:1-800-555-0199] any time
phone: [phone:202.555.0188]
telefon [phone:0043 1 5888 0] ask for
in 1999 and 2024 we met
on 2024-05-17 at 12:30 it
between 10 and 20 people
pages 12-18 and 33
the year 1984 or 2001
costs $19.99 or 25 euro
at 3.5 percent of 1,200,000
licensed under CC BY-NC 4.0.
license, version 3. of it
scores 3-1 and 12:0
room 12b on floor 3
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and
hash 9f86d081884c7d659a2feaa0c55ad015 of the file
key 1a2b3c4d5e6f in hex
about 100000 words, 42 lines
id 550e8400-e29b-41d4-a716-446655440000 in use
5927243074273351!! and 8 more
zip 90210 in street 17
time 12:30:45.123 in the log
ratio 16:9 of screen 4
add 12 34 56 78 to it
1 2 3 4 5 6
row 101 102 103 104
""".strip().split("\n")

_BASE_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_BASE_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_BASE_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CARRIER = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_WORD_BEFORE = re.compile(r"(\S{1,24})\s\Z")
_MARK = re.compile(r"\[(email|ip|card|phone):([^\]]*)\]")
_EDGE_LEFT, _EDGE_RIGHT = "\"'.,;:!?*#$%&<>[]{}|=~_-)", "\"'.,;:!?*#$%&<>[]{}|=~_-("


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns: leftmost, not overlapping within a kind; matches that fail their check are
    dropped. Every pattern runs in linear time."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), 0))
            free = m.end()
        else:
            free = max(free, at)
        at = text.find("@", max(at + 1, free))
    if re.search("[0-9]", text):
        out += [(*m.span(), 1) for m in _BASE_IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _BASE_CARD.finditer(text):
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((*m.span(), 2))
        if "+" in text:
            out += [(*m.span(), 3) for m in _BASE_PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return [(s, e, KINDS[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2]))]


def _hash(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


def _shape(token: str) -> str:
    """The token with letters as a or A, digits as 0, runs longer than four cut to four."""
    s = re.sub(r"[0-9]", "0", re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", token[:64]))
    return re.sub(r"(.)\1{4,}", r"\1\1\1\1", s)


def _token_features(tokens: list[str], before: str) -> list[list[int]]:
    """Feature numbers of each token of a run; ``before`` is the word in front of the run."""
    digits = [_digits(t) for t in tokens]
    whole = "".join(digits)
    run = f"run={min(len(tokens), 6)} digits={min(len(whole), 20)} luhn={12 <= len(whole) <= 19 and luhn(whole)}"
    shapes = [_shape(t.strip(_EDGE_RIGHT)) for t in tokens]
    hint = re.sub(r"[^a-z@]", "", before.lower())[:12]
    out = []
    for k, t in enumerate(tokens):
        d = digits[k]
        core = t.strip(_EDGE_RIGHT + _EDGE_LEFT)
        f = ["bias", f"s={shapes[k]}", f"d={min(len(d), 20)}", run, f"r={min(len(tokens), 6)}", f"luhn={12 <= len(d) <= 19 and luhn(d)}", f"at={'@' in core[1:-1]} dot={'.' in core.rpartition('@')[2]}", f"dots={min(core.count('.'), 4)} d={min(len(d), 20)}", f"colons={min(core.count(':'), 8)}", f"dash={min(core.count('-'), 5)} d={min(len(d), 20)}", f"plus={t.startswith('+')}", f"alpha={any(c.isalpha() for c in core)}", f"pos={min(k, 3)}", f"hint={hint}", f"hint={hint} digits={len(whole) // 4}"]
        f.append(f"p={shapes[k - 1] if k else '^'}")
        f.append(f"n={shapes[k + 1] if k + 1 < len(tokens) else '$'}")
        out.append([_hash(x) for x in f])
    return out


def _runs(text: str):
    """Maximal runs of carrier tokens: lists of (start, end), with the word before."""
    run: list[tuple[int, int]] = []
    for m in _CARRIER.finditer(text):
        if run and m.start() != run[-1][1] + 1:
            yield run, _before(text, run[0][0])
            run = []
        run.append(m.span())
    if run:
        yield run, _before(text, run[0][0])


def _before(text: str, at: int) -> str:
    m = _WORD_BEFORE.search(text[max(0, at - 25) : at])
    return m[1] if m else ""


def _emissions(features: list[list[int]], w: np.ndarray) -> np.ndarray:
    return w[np.array(features)].sum(axis=1)


def _may_follow() -> np.ndarray:
    """0 where tag j may follow tag i, else minus infinity: I-k only after B-k or I-k."""
    ok = np.zeros((len(TAGS), len(TAGS)))
    for i, a in enumerate(TAGS):
        for j, b in enumerate(TAGS):
            if b[0] == "I" and a[2:] != b[2:]:
                ok[i, j] = -1e9
    return ok


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def train(examples: list[tuple[list[list[int]], list[int]]], passes: int = PASSES, rate: float = 0.3, l2: float = 0.003):
    """(emission weights, transitions) that maximise the penalised likelihood of the tagged runs (Adagrad, full batch)."""
    k = len(TAGS)
    w, t, gw2, gt2 = np.zeros((FEATURES, k)), np.zeros((k, k)), np.full((FEATURES, k), 1e-6), np.full((k, k), 1e-6)
    ban = _may_follow()
    by_length: dict[int, list] = {}
    for f, y in examples:
        by_length.setdefault(len(f), []).append((f, y))
    for _ in range(passes):
        gw, gt = l2 * w, l2 * t
        for n, group in by_length.items():
            f, y = np.array([x for x, _ in group]), np.array([x for _, x in group])
            e, tr = w[f].sum(axis=2), t + ban
            alpha, beta = np.empty_like(e), np.zeros_like(e)
            alpha[:, 0] = e[:, 0] + tr[0]
            for i in range(1, n):
                alpha[:, i] = e[:, i] + _logsum(alpha[:, i - 1, :, None] + tr, 1)
            beta[:, -1] = tr[:, 0]
            for i in range(n - 2, -1, -1):
                beta[:, i] = _logsum(tr + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
            z = _logsum(alpha[:, -1] + tr[:, 0], 1)
            p = np.exp(alpha + beta - z[:, None, None])
            for i in range(n):
                d = p[:, i].copy()
                d[np.arange(len(group)), y[:, i]] -= 1
                np.add.at(gw, f[:, i], d[:, None, :])
                if i:
                    gt += np.exp(alpha[:, i - 1, :, None] + tr + (e[:, i] + beta[:, i])[:, None, :] - z[:, None, None]).sum(axis=0)
                    np.subtract.at(gt, (y[:, i - 1], y[:, i]), 1)
            gt[0] += p[:, 0].sum(axis=0)
            gt[:, 0] += p[:, -1].sum(axis=0)
            np.subtract.at(gt, (0, y[:, 0]), 1)
            np.subtract.at(gt, (y[:, -1], 0), 1)
        gw2 += gw * gw
        gt2 += gt * gt
        w -= rate * gw / np.sqrt(gw2)
        t -= rate * gt / np.sqrt(gt2)
    return w, t


def tagged_runs(marked: str):
    """(features, tags) of each run of a line with marked spans."""
    text, spans, pos = "", [], 0
    for m in _MARK.finditer(marked):
        text += marked[pos : m.start()]
        spans.append((len(text), len(text) + len(m[2]), m[1]))
        text, pos = text + m[2], m.end()
    text += marked[pos:]
    for run, before in _runs(text):
        tags, last = [], None
        for a, b in run:
            s = next((s for s in spans if s[0] < b and a < s[1]), None)
            tags.append(0 if s is None else TAGS.index(f"{'I' if s is last else 'B'}-{s[2]}"))
            last = s
        yield _token_features([text[a:b] for a, b in run], before), tags


def viterbi(emissions: list[np.ndarray], transitions: np.ndarray) -> list[list[int]]:
    """Best tags of each run; runs of similar length are decoded together, ``CELLS`` tokens at once (a longer run stands alone)."""
    tr, out = transitions + _may_follow(), [[] for _ in emissions]
    order = sorted(range(len(emissions)), key=lambda i: len(emissions[i]))
    lo = 0
    while lo < len(order):
        hi, most = lo + 1, len(emissions[order[lo]]) * 2 + 2
        while hi < len(order) and len(emissions[order[hi]]) <= most and (hi - lo + 1) * len(emissions[order[hi]]) <= CELLS:
            hi += 1
        ids = order[lo:hi]
        n = len(emissions[ids[-1]])
        e = np.full((len(ids), n, len(TAGS)), -1e6)
        e[:, :, 0] = 0.0  # padding stays O
        for r, i in enumerate(ids):
            e[r, : len(emissions[i])] = emissions[i]
        best, back = e[:, 0] + tr[0], np.zeros((len(ids), n, len(TAGS)), np.int8)
        for k in range(1, n):
            step = best[:, :, None] + tr
            back[:, k] = step.argmax(axis=1)
            best = step.max(axis=1) + e[:, k]
        tag = (best + tr[:, 0]).argmax(axis=1)
        path = np.zeros((len(ids), n), np.int8)
        for k in range(n - 1, -1, -1):
            path[:, k] = tag
            tag = back[np.arange(len(ids)), k, tag]
        for r, i in enumerate(ids):
            out[i] = path[r, : len(emissions[i])].tolist()
        lo = hi
    return out


def _tag_spans(text: str, run, tags):
    """Spans of the tagged tokens of a run, without punctuation around them."""
    k = 0
    while k < len(run):
        if tags[k]:
            j = k + 1
            while j < len(run) and tags[j] == tags[k] + 1 and TAGS[tags[k]][0] == "B":
                j += 1
            a, b = run[k][0], run[j - 1][1]
            while a < b and text[a] in _EDGE_LEFT:
                a += 1
            while b > a and text[b - 1] in _EDGE_RIGHT:
                b -= 1
            if a < b:
                yield a, b, TAGS[tags[k]][2:]
            k = j
        else:
            k += 1


def find(texts: list[str], model) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; the field's spans that touch a base span are left out."""
    w, t = model
    base, places, emissions = [base_spans(x) for x in texts], [], []
    for i, text in enumerate(texts):
        for run, before in _runs(text):
            places.append((i, run))
            emissions.append(_emissions(_token_features([text[a:b] for a, b in run], before), w))
    every = [list(b) for b in base]
    for (i, run), tags in zip(places, viterbi(emissions, t)):
        if any(tags):
            every[i] += [s for s in _tag_spans(texts[i], run, tags) if not any(s[0] < e and b < s[1] for b, e, _ in base[i])]
    rank = {k: n for n, k in enumerate(KINDS)}
    return [(b, sorted(e, key=lambda s: (s[0], rank[s[2]], s[1]))) for b, e in zip(base, every)]


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def fit(spark, labelled: DataFrame | None = None):
    """Train from a labelled table (column ``marked``: lines with [kind:text] marks; null lines are skipped), by default the
    built-in lines. A table above ``LABELLED_ROWS`` rows is refused."""
    lines = LABELLED
    if labelled is not None:
        rows = labelled.select("marked").where("marked IS NOT NULL").limit(LABELLED_ROWS + 1).collect()
        if len(rows) > LABELLED_ROWS:
            raise ValueError(f"the labelled table has more than {LABELLED_ROWS} rows")
        lines = [r.marked for r in rows]
    return train([x for line in lines for x in tagged_runs(line)])


def _report_scan(shared):
    def scan(batches):
        for batch in batches:
            found = find([(x.as_py() or b"").decode("utf-8", "replace") for x in batch.column("text")], shared.value)
            counts = [[sum(k == kind for _, _, k in base) for base, _ in found] for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found]), pa.array([joined(e) for _, e in found], pa.string()), pa.array([len(e) - len(b) for b, e in found], pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    return scan


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the fixed patterns), spans (all), n_added (by the field).

    Offsets are code points; each stretch of bytes that is no UTF-8 counts as U+FFFD. Null and empty texts have no spans; equal rows get equal
    results; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(fit(spark, labelled))
    return text_bytes(docs, id_col, text_col).mapInArrow(_report_scan(shared), "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint")


def _redact_scan(shared, text_col: str):
    def scan(batches):
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            raw = [None if x is None else x.decode("utf-8", "replace") for x in batch.column(k).cast(pa.binary()).to_pylist()]
            out = []
            for text, (_, spans) in zip(raw, find([x or "" for x in raw], shared.value)):
                if spans:
                    keep, pos = [], 0
                    for a, b, kind in spans:
                        if a >= pos:
                            keep += [text[pos:a], f"<{kind.upper()}>"]
                        pos = max(pos, b)
                    text = "".join([*keep, text[pos:]])
                out.append(text)
            yield batch.set_column(k, batch.schema.field(k), pa.array(out, batch.schema.field(k).type))

    return scan


def redact(docs: DataFrame, text_col: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with each span replaced by <KIND>; overlapping spans become the first one's kind. Null texts stay null;
    bytes that are no UTF-8 become U+FFFD."""
    spark = docs.sparkSession
    small_batches(spark)
    return docs.mapInArrow(_redact_scan(spark.sparkContext.broadcast(fit(spark, labelled)), text_col), docs.schema)
