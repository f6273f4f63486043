"""Mixing to target weights: soft domain membership, and nonnegative document rates by projected-gradient least squares.

A naive Bayes classifier trained on a labelled table predicts each document's posterior over domains. The rates are the nonnegative
numbers nearest to 1 (the iteration starts there) that bring the expected tokens of every domain, sum of tokens x posterior x rate,
to their targets. Built-in column functions only.

Scale: posteriors are kept in hundredths, and documents with equal posteriors have equal rates, so the fit runs on a table of posterior
cells whose size depends on the number of domains alone. A gradient step is one aggregation of that table; the driver sees one sum per domain.
Documents are read once for training (at most about ``TRAIN_DOCS``) and once for scoring; the word model is broadcast, at most ``WORDS`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.common import small_or_shuffled, written

TRAIN_DOCS = 12_000
WORDS = 4096
WORD_LENGTH = 24
#: Least chi-square statistic of a word against the domains.
LEAST_CHI = 30.0
#: Words beyond so many informative ones weigh in as their mean.
FULL_WORDS = 20
STEPS = 30
TARGETS = {"good": 0.90, "good_toxic": 0.04, "poor": 0.05, "poor_toxic": 0.01}


def draw(key: Column) -> Column:
    """A number in 0..1 from the md5 of a key."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / float(2**32)


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the label table; rows with a missing label have no domain."""
    quality = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    toxic = F.when(F.col("toxic") == 1, "_toxic").when(F.col("toxic") == 0, "")
    return labels.select("doc_id", F.concat(quality, toxic).alias("domain")).where("domain IS NOT NULL")


def _words(docs: DataFrame, *keep: str) -> DataFrame:
    """A row per word; a document without words has one row with a null word."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return docs.select(*keep, F.explode_outer(words).alias("w")).select(*keep, F.substring("w", 1, WORD_LENGTH).alias("w"))


def _each(names: list[str], f) -> list[Column]:
    return [f(k, d).alias(f"v{k}") for k, d in enumerate(names)]


def word_model(docs: DataFrame, labelled: DataFrame, names: list[str]) -> tuple[DataFrame, list[float]]:
    """((w, v0, v1, ...): log-likelihoods of informative words, log priors), from a sample of the labelled documents chosen by id."""
    labelled = labelled.where(F.col("domain").isin(names))
    total = labelled.count()
    chosen = written(labelled.where(draw(F.col("doc_id")) < TRAIN_DOCS / max(total, 1)))
    sizes = {r.domain: r.n for r in chosen.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = [sizes.get(d, 0) for d in names]
    rows = _words(docs.join(small_or_shuffled(chosen, 40), "doc_id"), "doc_id", "domain").where("w IS NOT NULL")
    per_doc = rows.groupBy("doc_id", "domain", "w").agg(F.count("*").alias("c"))
    counts = per_doc.groupBy("w").agg(
        *(F.count_if(F.col("domain") == d).alias(f"d{k}") for k, d in enumerate(names)), *(F.sum(F.when(F.col("domain") == d, F.col("c")).otherwise(0)).alias(f"c{k}") for k, d in enumerate(names))
    )
    seen = sum((F.col(f"d{k}") for k in range(len(names))), F.lit(0))
    chi = F.lit(0.0)
    for k in range(len(names)):
        if n[k]:
            expected = seen * (n[k] / sum(n))
            chi = chi + (F.col(f"d{k}") - expected) * (F.col(f"d{k}") - expected) / expected
    best = written(counts.withColumn("chi", F.round(chi, 6)).where(F.col("chi") >= LEAST_CHI).orderBy(F.desc("chi"), "w").limit(WORDS))
    sums = best.agg(*_each(names, lambda k, d: F.coalesce(F.sum(f"c{k}"), F.lit(0))), F.count("*").alias("m")).first()
    model = best.select("w", *_each(names, lambda k, d: F.log((F.col(f"c{k}") + 1.0) / float(sums[f"v{k}"] + sums["m"]))))
    return model, [(n[k] + 1) / (sum(n) + len(names)) for k in range(len(names))]


def posteriors(docs: DataFrame, labelled: DataFrame, names: list[str]) -> DataFrame:
    """(doc_id, n_tokens, h0, h1, ...): posterior of each domain in hundredths that add up to 100; rounding favours the first domain."""
    model, priors = word_model(docs, labelled, names)
    scored = _words(docs, "doc_id").join(F.broadcast(model), "w", "left").groupBy("doc_id").agg(F.count("w").alias("n_tokens"), F.count("v0").alias("m"), *_each(names, lambda k, d: F.coalesce(F.sum(f"v{k}"), F.lit(0.0))))
    damp = F.least(F.lit(1.0), F.lit(float(FULL_WORDS)) / F.greatest("m", F.lit(1)))
    z = scored.select("doc_id", "n_tokens", *_each(names, lambda k, d: F.log(F.lit(priors[k])) + F.col(f"v{k}") * damp))
    top = F.greatest(*(f"v{k}" for k in range(len(names)))) if len(names) > 1 else F.col("v0")
    e = z.select("doc_id", "n_tokens", *_each(names, lambda k, d: F.exp(F.col(f"v{k}") - top)))
    total = sum((F.col(f"v{k}") for k in range(1, len(names))), F.col("v0"))
    h = [F.floor(100 * F.col(f"v{k}") / total + 1e-6).cast("int").alias(f"h{k}") for k in range(1, len(names))]
    parts = e.select("doc_id", "n_tokens", *h)
    return parts.withColumn("h0", F.lit(100) - sum((F.col(f"h{k}") for k in range(1, len(names))), F.lit(0)))


def _rate(steps: list[list[float]]) -> Column:
    """The rate of a posterior after the gradient steps so far: one fold over an array of them, whatever their number."""
    if not steps:
        return F.lit(1.0)
    taken = F.array(*(F.array(*map(F.lit, g)) for g in steps))
    return F.aggregate(taken, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - sum((F.col(f"h{k}") / 100 * g[k] for k in range(1, len(steps[0]))), F.col("h0") / 100 * g[0])))


def fit_rates(cells: DataFrame, targets: list[float], steps: int = STEPS) -> list[list[float]]:
    """Gradient steps for cells (h0, h1, ..., tokens): least squares of the domains' shares of all tokens against the targets, each
    error weighted by the domain's present share, projected to nonnegative rates after every step."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    taken: list[list[float]] = []
    weights: list[float] = []
    for _ in range(steps if total else 0):
        r = _rate(taken)
        shares = cells.agg(*(F.sum(F.col("tokens") * (F.col(f"h{k}") / 100) * r) for k in range(len(targets)))).first()
        shares = [x / total for x in shares]
        weights = weights or [1 / max(s, 1e-6) for s in shares]
        taken.append([w * (s - t) for w, s, t in zip(weights, shares, targets)])
    return taken


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>..., rate, n_copies): expected domain tokens at these rates have the target shares of all
    tokens. n_copies rounds the rate up or down by a draw from the id, so that its mean is the rate.

    Rows with the same id count as one document. Documents without words have 0 tokens and the rate of the prior. Without labels the
    posterior is uniform; an empty table gives an empty result.
    """
    names = list(targets)
    post = written(posteriors(docs.select("doc_id", "text"), labelled, names))
    cells = written(post.groupBy(*(f"h{k}" for k in range(len(names)))).agg(F.sum("n_tokens").alias("tokens")))
    rate = F.round(_rate(fit_rates(cells, [targets[d] for d in names])), 6)
    out = post.select("doc_id", "n_tokens", *((F.col(f"h{k}") / 100).alias(f"p_{d}") for k, d in enumerate(names)), rate.alias("rate"))
    return out.withColumn("n_copies", F.floor(F.col("rate") + draw(F.col("doc_id"))).cast("int"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return mix(docs, label_domains(labels))
