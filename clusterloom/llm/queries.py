"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from clusterloom.llm import bucket_pointer, compression, crf_pii, debruijn, fill_middle, ftrl, mixing, suffix_automaton, templates, token_groups, url_model, variant_grams, warc
from clusterloom.llm.oracle import ORACLES  # noqa: F401
from clusterloom.llm.common import table


def op5_jaccard_join(spark, sf_dir):
    return token_groups.jaccard_components(table(spark, sf_dir, "documents"))


def op3_decontamination(spark, sf_dir):
    return suffix_automaton.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_classifier(spark, sf_dir):
    return ftrl.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii(spark, sf_dir):
    return crf_pii.report(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark, sf_dir):
    return bucket_pointer.report(table(spark, sf_dir, "documents"))


def op8_compression_bands(spark, sf_dir):
    return compression.report(table(spark, sf_dir, "documents"))


def op10_main_text(spark, sf_dir):
    return templates.extract(table(spark, sf_dir, "pages"))


def op1_mixing(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark, sf_dir):
    return url_model.filter_urls(table(spark, sf_dir, "pages"))


def op7_warc_derivatives(spark, sf_dir):
    return warc.report(table(spark, sf_dir, "pages"))


def op11_fill_middle(spark, sf_dir):
    return fill_middle.report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark, sf_dir):
    return variant_grams.report(table(spark, sf_dir, "documents"))


def op13_word_spans(spark, sf_dir):
    return debruijn.report(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_mixing, op2_pii, op3_decontamination, op4_suffix_dedup, op5_jaccard_join, op6_url_filter, op7_warc_derivatives, op8_compression_bands, op9_quality_classifier, op10_main_text, op11_fill_middle, op12_spelling_variants, op13_word_spans)
}
