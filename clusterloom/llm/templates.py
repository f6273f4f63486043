"""Main text of web pages with site template removal.

A first scan hashes element subtrees; Spark counts them per host, once per distinct text, and subtrees that recur on many pages of a host are
its templates. A second scan reads the text, without what by its element, role or class is no article, and deletes template subtrees.

Scale: two scans. Only hashes of subtrees that could reach the text are shuffled, with map-side counts, so a hot host is many keys. The
templates (one row per host) are broadcast if their counted size allows it; else a join by host that adaptive execution can split.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.common import small_batches, small_or_shuffled, written

#: A template stands on at least so many pages of its host, and on at least this share of them.
LEAST_PAGES = 5
LEAST_SHARE = 0.3

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea xmp noembed noframes title".split())
DROPPED = frozenset("nav footer aside header form menu dialog button select option fieldset head object svg canvas audio video map math applet".split()) | RAW
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CELLS = frozenset(("td", "th", "br"))
#: Elements that may be templates inside an article; paragraphs, headings and list items there are content.
BOXES = frozenset("aside center details dl div figure ol section span table ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words of class and id that mark what is no article.
MARKS = frozenset(
    (
        "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar widget nav navbar navigation menu breadcrumb breadcrumbs "
        "header masthead footer cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing "
        "social related recommended recommendations comment comments disqus respond replies pagination pager toolbar skip copyright disclaimer"
    ).split()
)
#: Opening one of the first closes an open one of the second.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",)}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[A-Za-z][^>]*\Z", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


class _Open:
    __slots__ = ("tag", "dropped", "article", "main", "blocks", "text", "name", "parts", "h1", "soft")


def _marked(tag: str, attrs: str) -> tuple[bool, bool, str]:
    """(is it no article, is it the main part, class and id)"""
    name, drop, main = "", tag in DROPPED, tag == "main"
    if attrs and not attrs.isspace():
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or key == "aria-hidden" and value == "true":
                drop = True
            elif key == "role":
                drop |= value.lower() in ROLES
                main |= value.lower() == "main"
            elif key in ("class", "id"):
                name += value + " "
                drop |= any(w.lower() in MARKS for w in _SPLIT.split(value))
    return drop and tag not in ("html", "body"), main, name


class Page:
    """One pass over a page: ``blocks`` of (text, in article, in main) in page order, and ``subtrees`` of (digest, in article, in
    main, tag). Subtrees whose digest is in ``templates`` leave no text. Never fails, whatever the markup."""

    def __init__(self, source: str, templates=frozenset()):
        self.blocks: list[tuple[str, bool, bool]] = []
        self.subtrees: list[tuple[int, bool, bool, str]] = []
        self.text: list[str] = []
        self.templates = templates
        self.open: dict[str, int] = {}  # elements of each name on the stack
        self.h1 = 0
        root = self._frame("", "", None)
        self.stack = [root]
        pos = 0
        while True:
            m = _TAG.search(source, pos)
            if not m:
                self._put(source[pos:])
                break
            if m.start() > pos:
                self._put(source[pos : m.start()])
            pos = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._end(tag)
                continue
            attrs = m[3] or m[6] or ""
            self._start(tag, attrs)
            if tag in RAW:
                end = re.compile(f"</{tag}\\b", re.I).search(source, pos)
                pos = end.start() if end else len(source)
            elif attrs.endswith("/") and tag not in BLOCKS and tag not in VOID:
                self._end(tag)
        while len(self.stack) > 1:
            self._close()
        self._flush()

    def _frame(self, tag, attrs, parent):
        f = _Open()
        drop, main, f.name = _marked(tag, attrs)
        f.tag, f.h1 = tag, self.h1
        # A header, by name or element, inside an article may hold its heading: it goes only if it has none.
        f.soft = drop and tag in ("header", "div", "hgroup", "section") and parent is not None and (parent.article or parent.main) and not parent.dropped and (tag == "header" or "header" in f.name.lower())
        f.dropped = (drop and not f.soft) or (parent is not None and parent.dropped)
        f.article = not f.dropped and (tag == "article" or (parent is not None and parent.article))
        f.main = not f.dropped and (main or (parent is not None and parent.main))
        f.blocks, f.text, f.parts = len(self.blocks), len(self.text), []
        return f

    def _put(self, raw: str):
        top = self.stack[-1]
        if not top.dropped and raw:
            text = html.unescape(raw) if "&" in raw else raw
            self.text.append(text)
            if not text.isspace():
                top.parts.append(text.strip())

    def _flush(self):
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            self.text.clear()
            if text:
                self.blocks.append((text, self.stack[-1].article, self.stack[-1].main))

    def _start(self, tag, attrs):
        if tag in BLOCKS:
            for k in range(len(self.stack) - 1, 0, -1):  # a paragraph ends where a block begins
                at = self.stack[k].tag
                if at == "p":
                    while len(self.stack) > k:
                        self._close()
                    break
                if at in BLOCKS:
                    break
            for k in range(len(self.stack) - 1, 0, -1):
                at = self.stack[k].tag
                if at in CLOSES.get(tag, ()):
                    while len(self.stack) > k:
                        self._close()
                    break
                if at in ("ul", "ol", "dl", "table", "select") or tag not in CLOSES:
                    break
            self._flush()
        elif tag in CELLS:
            self._put(" ")
        if tag == "h1":
            self.h1 += 1
        if tag not in VOID:
            self.stack.append(self._frame(tag, attrs, self.stack[-1]))
            self.open[tag] = self.open.get(tag, 0) + 1

    def _end(self, tag):
        if not self.open.get(tag):
            return
        inline = tag not in BLOCKS and tag not in RAW
        for k in range(len(self.stack) - 1, 0, -1):
            at = self.stack[k].tag
            if at == tag:
                while len(self.stack) > k:
                    self._close()
                return
            if inline and at in BLOCKS or tag == "p" and at in ("article", "main", "body", "div", "section", "td"):
                return

    def _close(self):
        f = self.stack[-1]
        if f.tag in BLOCKS:
            self._flush()
        self.stack.pop()
        self.open[f.tag] -= 1
        if f.dropped:
            return
        digest = 0
        if f.parts:
            digest = _hash("\x01".join([f.tag, f.name, *f.parts]))
            self.stack[-1].parts.append(str(digest))
        if f.soft and f.h1 == self.h1 or digest in self.templates:
            del self.blocks[f.blocks :]
            if f.tag not in BLOCKS:
                del self.text[f.text :]
        elif digest and f.tag not in ("article", "main", "body", "html"):
            self.subtrees.append((digest, f.article, f.main, f.tag))

    def level(self) -> int:
        """Where the article is: 1 in article elements, 2 in the main part, 3 anywhere."""
        return 1 if any(a for _, a, _ in self.blocks) else 2 if any(m for *_, m in self.blocks) else 3

    def main_text(self) -> str:
        level = self.level()
        return "\n\n".join(t for t, a, m in self.blocks if level == 3 or (a if level == 1 else m))

    def candidates(self) -> set[int]:
        """Digests of the subtrees that could be templates within the text."""
        level = self.level()
        return {d for d, a, m, tag in self.subtrees if level == 3 or ((a if level == 1 else m) and tag in BOXES)}


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - 2**63


def _host(url):
    """Host of a url: between the first :// and the next /, ? or #, in lower case."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[^/?#]*?://([^/?#]*)", 1))


def _digest_scan(batches):
    """A row per page without digest, and a row per candidate; ``page`` hashes the text, so that copies count once."""
    for batch in batches:
        host, digest, page = [], [], []
        for h, source in zip(batch.column("host").to_pylist(), batch.column("html")):
            read = Page(source.as_py() or "")
            found = [None, *read.candidates()]
            host += [h] * len(found)
            digest += found
            page += [_hash(read.main_text())] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(digest, pa.int64()), pa.array(page, pa.int64())], ["host", "digest", "page"])


def host_templates(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(host, digests): the subtrees that recur on at least ``LEAST_PAGES`` pages and ``LEAST_SHARE`` of the pages of a host; pages
    with the same text count as one."""
    base = pages.select(_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    rows = written(base.mapInArrow(_digest_scan, "host string, digest bigint, page bigint"))
    counts = rows.where("digest IS NOT NULL").groupBy("host", "digest").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= LEAST_PAGES)
    sizes = rows.where("digest IS NULL").groupBy("host").agg(F.count_distinct("page").alias("pages"))
    return counts.join(sizes, "host").where(F.col("n") >= LEAST_SHARE * F.col("pages")).groupBy("host").agg(F.collect_list("digest").alias("digests"))


def _text_scan(batches):
    for batch in batches:
        out = [Page(source.as_py() or "", frozenset(t or ())).main_text() for source, t in zip(batch.column("html"), batch.column("digests").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, html_col: str = "html", url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """(page_id, url, text, n_chars): blocks of the article joined by two newlines.

    Null or empty html gives an empty text; pages without a host share the empty host; repeated rows are each extracted; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    templates = written(host_templates(pages, html_col, url_col))
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), _host(F.col(url_col)).alias("host"))
    joined = base.join(small_or_shuffled(templates, F.size("digests") * 8 + 64), "host", "left").select("page_id", "url", "html", "digests")
    return joined.mapInArrow(_text_scan, "page_id bigint, url string, text string, n_chars bigint")
