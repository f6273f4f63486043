"""The corpus pipeline: documents in, a cleaned and weighted corpus out, stage by stage through written tables.

Every stage works on all that its predecessor kept and returns the columns of documents; the last adds rates. Texts that a stage
changes get a new n_chars. Null texts pass every stage as empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterloom.llm import crf_pii, ftrl, mixing, suffix_automaton, token_groups
from clusterloom.llm.common import small_or_shuffled, table, written

#: Shares of the tokens that the mixed corpus should have.
TARGETS = {"good": 0.95, "good_toxic": 0.04, "poor": 0.008, "poor_toxic": 0.002}


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return ftrl.keep_good(docs, ftrl.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates: the document with the least id of each group of linked documents stays, whole."""
    extra = written(token_groups.jaccard_components(docs).where("doc_id <> component_id").select("doc_id"))
    return docs.join(small_or_shuffled(extra, 16), "doc_id", "left_anti").select(docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: hit spans are cut out; documents hit by more than half of their words go."""
    return _counted(suffix_automaton.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; no document goes."""
    return _counted(crf_pii.redact(docs))


def with_every_clean(rates: DataFrame, clean: str = "good") -> DataFrame:
    """Rates and copies by which no clean document goes; clean is a document whose likeliest domain is ``clean``.

    If the rate at the highest posterior of ``clean`` is below 1, all rates are scaled so that it is 1, which leaves the mix as it is. Clean documents
    that are still below 1, for a part posterior on another domain, are raised to one copy.
    """
    others = [f"p_{d}" for d in TARGETS if d != clean]
    is_clean = F.col(f"p_{clean}") >= F.greatest(*others)
    top = rates.where(is_clean).agg(F.max(F.struct(f"p_{clean}", "rate")).alias("top")).first()["top"]
    scale = 1 / top["rate"] if top and 0 < top["rate"] < 1 else 1.0
    rate = F.round(F.col("rate") * scale, 6)
    out = rates.withColumn("rate", F.when(is_clean, F.greatest(rate, F.lit(1.0))).otherwise(rate))
    return out.withColumn("n_copies", F.floor(F.col("rate") + mixing.draw(F.col("doc_id"))).cast("int"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: rate and n_copies of each document that is taken at least once; every clean one is."""
    rates = written(mixing.mix(docs, mixing.label_domains(table(spark, sf_dir, "labels")), TARGETS))
    taken = with_every_clean(rates).where("n_copies > 0").select("doc_id", "rate", "n_copies")
    return docs.join(small_or_shuffled(taken, 40), "doc_id").select(*docs.columns, "rate", "n_copies")


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmarks),
    ("personal data", without_personal_data),
    ("mixing sources to target weights", mixed),
]

#: Trained models and span decoding have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
