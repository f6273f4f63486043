"""WARC derivatives: metadata and plain-text conversion records of response records.

Every response gives two records that refer to it by its record id and carry its target uri, date, digests and content type. Built-in column
functions only, no shuffle: one scan. ``write_records`` and ``read_records`` store records as WARC/1.1 text files.
"""

from __future__ import annotations

import json
import zlib
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"

# Fixed steps from html to text: (pattern, replacement), in this order; elements without text go one kind after the other, each up to its own end
# tag (or to the end of the page). The blanks are written out, so that every regex engine agrees.
TEXT_STEPS = (
    ("(?s)<!--.*?(?:-->|\\z)", ""),
    *((f"(?is)<{tag}(?:[ \t\r\n/][^>]*)?>.*?(?:</{tag}[ \t\r\n]*>|\\z)", "") for tag in ("script", "style", "noscript", "template", "head")),
    ("(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|tr|ul)(?:[ \t\r\n/][^>]*)?>", "\n"),
    ("<[A-Za-z/!?][^>]*>", ""),
    ("[ \t\r\f]+", " "),
    (" ?\n[ \n]*", "\n"),
)
#: The same without matches that would be replaced by themselves: most blanks stand alone.
SPARING = {"[ \t\r\f]+": "[ \t\r\f](?:(?<=[\t\r\f])[ \t\r\f]*|[ \t\r\f]+)"}
#: The first of them: comments, scripts and styles, in which a title is none.
UNSHOWN = TEXT_STEPS[:3]
#: Named character references (those that end in a semicolon) and what they stand for.
NAMES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
LONGEST_NAME = max(map(len, NAMES))
NAME_GROUPS = 1024  # by a hash of the name: a map is searched from its beginning


def references(text: Column) -> Column:
    """Character references decoded once, from left to right: ``&#8217;``, ``&#x2019;`` and all named ones with a semicolon. Numbers that are no
    character become U+FFFD; what is no reference stays."""
    groups = [{} for _ in range(NAME_GROUPS)]
    for name, stands_for in NAMES.items():
        groups[zlib.crc32(name.encode()) % NAME_GROUPS][name] = stands_for
    names = F.from_json(F.lit(json.dumps(groups)), "array<map<string,string>>")

    def decoded(part: Column, i: Column) -> Column:
        ref = F.regexp_extract(part, "^(#[0-9]{1,9}|#[xX][0-9A-Fa-f]{1,8}|[A-Za-z][A-Za-z0-9]{0,%d});" % (LONGEST_NAME - 1), 1)
        number = F.when(F.lower(F.substring(ref, 2, 1)) == "x", F.conv(F.substring(ref, 3, 8), 16, 10)).otherwise(F.substring(ref, 2, 9)).cast("bigint")
        real = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(real, number).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")
        to = F.when(ref == "", F.lit(None)).when(ref.startswith("#"), char).otherwise(F.element_at(names[(F.crc32(ref.cast("binary")) % NAME_GROUPS).cast("int")], ref))
        rest = F.substring(part, F.length(ref) + 2, F.length(part))
        return F.when(i == 0, part).otherwise(F.coalesce(F.concat(to, rest), F.concat(F.lit("&"), part)))

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&"), decoded), "")).otherwise(text)


def record_id(*parts: Column) -> Column:
    """A urn:uuid from the md5 of the parts."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def size(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def stripped(html: Column, steps=TEXT_STEPS) -> Column:
    for pattern, by in steps:
        html = F.regexp_replace(html, SPARING.get(pattern, pattern), by)
    return html


def shown_text(text: Column) -> Column:
    """Text without markup, references decoded and trimmed. ``text`` should be a column of a table: it is named several times, and what is behind it
    would be evaluated as often."""
    return F.regexp_replace(F.regexp_replace(references(text), "^[ \n]+", ""), "[ \n]+$", "")


def plain_text(html: Column, steps=TEXT_STEPS) -> Column:
    return F.transform(F.array(stripped(html, steps)), shown_text)[0]


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """Pages as response records: (source_id, record_id, target_uri, date, http_headers, payload, payload_digest, block_digest). Null html and
    urls are empty; equal rows get equal ids."""
    df = pages.select(F.col(id_col).alias("source_id"), F.coalesce(F.col(url_col), F.lit("")).alias("target_uri"), F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    df = df.withColumn("http_headers", F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size(F.col("payload")).cast("string"), F.lit(CRLF + CRLF)))
    df = df.withColumn("payload_digest", digest(F.col("payload"))).withColumn("date", F.lit(date))
    return df.withColumn("block_digest", digest(F.concat("http_headers", "payload"))).withColumn("record_id", record_id(F.lit("response"), F.coalesce(F.col("source_id").cast("string"), F.lit("")), F.col("target_uri"), F.col("payload_digest")))


def derive(resp: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response.

    (source_id, warc_type, record_id, refers_to, target_uri, date, content_type, content_length, block_digest, source_payload_digest,
    source_block_digest, source_headers, body). Empty payloads give an empty conversion; responses without a title an empty title.
    """
    html = F.col("payload")
    resp = resp.withColumn("_shown", stripped(html, UNSHOWN))  # columns of their own, since they are used more than once
    resp = resp.withColumn("_text", stripped(F.col("_shown"), TEXT_STEPS[len(UNSHOWN) :]))
    title = F.trim(F.regexp_replace(F.regexp_extract("_shown", "(?is)<title(?:[ \t\r\n][^>]*)?>(.*?)</title", 1), "[ \t\r\n]+", " "))
    lang = F.regexp_extract(html, "(?i)<html[^>]*[ \t\r\n]lang=[\"']?([A-Za-z0-9-]+)", 1)
    links = F.regexp_count(html, F.lit("(?i)<a[ \t\r\n][^>]*href"))
    fields = {"title": title, "language": lang, "outlinks": links.cast("string"), "source-payload-digest": F.col("payload_digest"), "source-block-digest": F.col("block_digest")}
    info = F.concat(*(x for name, value in fields.items() for x in (F.lit(f"{name}: "), value, F.lit(CRLF))))
    body = F.explode(F.array(F.struct(F.lit("metadata").alias("t"), F.lit("application/warc-fields").alias("c"), info.alias("b")), F.struct(F.lit("conversion").alias("t"), F.lit("text/plain; charset=utf-8").alias("c"), shown_text(F.col("_text")).alias("b"))))
    rows = resp.withColumn("d", body)
    return rows.select(
        "source_id", F.col("d.t").alias("warc_type"), record_id(F.col("d.t"), F.col("record_id")).alias("record_id"), F.col("record_id").alias("refers_to"), "target_uri", "date",
        F.col("d.c").alias("content_type"), size(F.col("d.b")).alias("content_length"), digest(F.col("d.b")).alias("block_digest"),
        F.col("payload_digest").alias("source_payload_digest"), F.col("block_digest").alias("source_block_digest"), F.col("http_headers").alias("source_headers"), F.col("d.b").alias("body"),
    )


_FIELDS = {"WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to", "WARC-Target-URI": "target_uri", "WARC-Date": "date", "WARC-Block-Digest": "block_digest", "Content-Type": "content_type", "Content-Length": "content_length"}


def write_records(records: DataFrame, path: str) -> None:
    """Store derived records as WARC/1.1 text, one file per partition. ``path`` must be shared by all executors."""
    heads = []
    for name, c in _FIELDS.items():
        value = F.col(c).cast("string")
        heads += [F.lit(f"{name}: "), F.concat(F.lit("<"), value, F.lit(">")) if c in ("record_id", "refers_to") else value, F.lit(CRLF)]
    records.select(F.concat(F.lit(VERSION + CRLF), *heads, F.lit(CRLF), "body").alias("value")).write.option("lineSep", CRLF + CRLF).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC/1.1 text files: the fields that ``write_records`` writes, ``body`` and ``whole`` (false where the body holds
    fewer bytes than declared, as when it contains a version line)."""
    rows = spark.read.option("lineSep", VERSION + CRLF).text(path).where("value <> ''")
    at = F.instr("value", CRLF + CRLF)
    head = F.concat(F.lit(CRLF), F.substring("value", F.lit(1), at - 1), F.lit(CRLF))
    length = F.regexp_extract(head, "\r\nContent-Length: ([0-9]+)\r\n", 1).cast("long")
    rest = F.substring("value", at + 4, F.length("value")).cast("binary")
    fields = [F.regexp_replace(F.regexp_extract(head, f"\r\n{name}: ([^\r\n]*)\r\n", 1), "^<|>$" if c in ("record_id", "refers_to") else "^$", "").alias(c) for name, c in _FIELDS.items() if c != "content_length"]
    body = F.substring(rest, F.lit(1), length.cast("int"))
    return rows.select(*fields, length.alias("content_length"), body.cast("string").alias("body"), (F.octet_length(body) == length).alias("whole"))


def report(pages: DataFrame) -> DataFrame:
    return derive(responses(pages)).withColumnRenamed("source_id", "page_id")
