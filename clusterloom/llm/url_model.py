"""URL filter: host and path rules, and for urls without a rule a character language-model ratio.

Two smoothed variable-order Markov models, of accepted and of rejected urls, predict each character from the longest context under which it was
seen; a url passes if the mean difference of the log-likelihoods reaches a threshold calibrated on held-out accepted urls. Built-in column
functions only.

Scale: every ruled url outside the held-out fold is counted, grams combine map-side, and the threshold is an exact order statistic of all
held-out accepted urls, found by narrowing; the models grow with the variety of the urls. Scoring explodes urls to characters inside the scan, joins the models by
broadcast (if their counted size allows it) and adds up with map-side combination; one row per url is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.common import small_or_shuffled, written
from clusterloom.operators.selection import order_statistics

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
TRAIN_URLS = 20_000  # only the SQL twin stops here: it agrees up to so many ruled urls a class
ORDER = 4  # longest context
LEAST_CONTEXT = 4
SMOOTH = 2.0
#: Share of held-out accepted urls that may be rejected.
MISSED = 0.05

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = after_scheme(url)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _draw(key: Column, first: int) -> Column:
    """A number in 0..1 from eight hex digits of the md5 of a key."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), first, 8), 16, 10).cast("double") / float(2**32)


def _characters(df: DataFrame) -> DataFrame:
    """One row per character of ``^`` + url + ``$``, with the grams of each order that end there."""
    text = df.withColumn("t", F.concat(F.lit("^"), F.translate(after_scheme(F.col("url")), UPPER, LOWER), F.lit("$")))
    rows = text.withColumn("i", F.explode(F.sequence(F.lit(2), F.length("t"))))
    return rows.select(*df.columns, "i", *(F.when(F.col("i") > k, F.substring("t", F.col("i") - k, F.lit(k + 1))).alias(f"g{k}") for k in range(ORDER + 1)))


def train(urls: DataFrame) -> list[DataFrame]:
    """For each order (gram, llr): log P(accepted) - log P(rejected) of the gram's last character after its context.

    ``urls``: (url, accepted boolean). P of order k is (n(context, c) + SMOOTH * P of order k - 1) / (n(context) + SMOOTH); contexts seen
    fewer than ``LEAST_CONTEXT`` times are left to shorter ones.
    """
    rows = _characters(urls.select("url", "accepted"))
    grams = rows.select("accepted", F.explode(F.array(*(f"g{k}" for k in range(ORDER + 1)))).alias("gram")).where("gram IS NOT NULL")
    counts = written(grams.groupBy("gram").agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r")).withColumn("m", F.length("gram")))
    out, lower = [], None
    for m in range(1, ORDER + 2):
        own = counts.where(F.col("m") == m).withColumn("context", F.substring("gram", 1, m - 1))
        totals = own.groupBy("context").agg(F.sum("a").alias("na"), F.sum("r").alias("nr")).where(F.col("na") + F.col("nr") >= (LEAST_CONTEXT if m > 1 else 0))
        own = own.join(totals, "context")
        if lower is None:
            own = own.withColumn("la", F.lit(1 / 256)).withColumn("lr", F.lit(1 / 256))
        else:
            own = own.withColumn("suffix", F.substring("gram", 2, m - 1)).join(lower.select(F.col("gram").alias("suffix"), F.col("pa").alias("la"), F.col("pr").alias("lr")), "suffix")
        lower = written(own.select("gram", ((F.col("a") + SMOOTH * F.col("la")) / (F.col("na") + SMOOTH)).alias("pa"), ((F.col("r") + SMOOTH * F.col("lr")) / (F.col("nr") + SMOOTH)).alias("pr")))
        out.append(lower.select("gram", (F.log("pa") - F.log("pr")).alias("llr")))
    return out


def score(urls: DataFrame, model: list[DataFrame]) -> DataFrame:
    """The columns of ``urls`` and ``score``: the mean of the characters' differences; characters no model knows count 0. Repeated rows
    stay repeated."""
    rows = _characters(urls)
    for k, grams in enumerate(model):
        rows = rows.join(small_or_shuffled(grams.select(F.col("gram").alias(f"g{k}"), F.col("llr").alias(f"l{k}")), 64), f"g{k}", "left")
    best = F.coalesce(*(f"l{k}" for k in range(ORDER, -1, -1)), F.lit(0.0))
    summed = rows.groupBy(*urls.columns).agg(F.round(F.sum(best) / F.count("*"), 9).alias("score"), F.count_if(F.col("i") == 2).cast("int").alias("copies"))
    return summed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")


def _percentile(df: DataFrame, column: str, share: float) -> float:
    """The exact percentile, interpolated between its two ranks, in 9 decimals; 0 without rows."""
    n = df.count()
    if not n:
        return 0.0
    at = (n - 1) * share
    low, high = math.floor(at), math.ceil(at)
    found = order_statistics(df, column, [low, high])
    return round(found[low].value + (found[high].value - found[low].value) * (at - low), 9)


def filter_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row.

    Urls that are null or hold no ``://`` have an empty host and path and get the model's verdict on an empty string. Without accepted or
    rejected urls to learn from every score is 0 and passes.
    """
    host, path = host_and_path(F.col(url_col))
    base = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    base = base.select("*", rule.alias("rule"), verdict.alias("ruled"))
    classes = base.where("ruled IS NOT NULL").select("ruled").distinct().count()
    held = _draw(F.col("page_id"), 9) < 0.2
    model = train(base.where(F.col("ruled").isNotNull() & ~held).select("url", (F.col("ruled") == "allow").alias("accepted"))) if classes == 2 else []
    scored = written(score(base, model) if model else base.withColumn("score", F.lit(0.0)))
    cut = _percentile(scored.where(held & (F.col("ruled") == "allow")), "score", MISSED)
    by_model = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score")
