"""The pipeline: every stage keeps its contract on the small table."""

import corpus_pipeline
from clusterloom.llm import crf_pii, mixing, suffix_automaton, token_groups
from clusterloom.llm.common import table, written


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir))
        seen[name] = docs
        assert docs.columns[: len(columns)] == columns and docs.count() <= before.count()
    near = seen["n-gram Jaccard join"]
    assert token_groups.jaccard_components(near).where("doc_id <> component_id").count() == 0
    assert suffix_automaton.report(seen["benchmark decontamination"], table(spark, sf_dir, "benchmark")).where("contaminated").count() == 0
    private = seen["personal data"]
    assert private.count() == seen["benchmark decontamination"].count()
    assert crf_pii.report(private).where("spans <> ''").count() == 0
    assert docs.where("n_copies < 1 OR rate <= 0 OR n_chars <> length(text)").count() == 0


def test_mixing_keeps_every_clean_document(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rates = written(mixing.mix(docs, mixing.label_domains(table(spark, sf_dir, "labels")), corpus_pipeline.TARGETS))
    clean = rates.where("p_good >= greatest(p_good_toxic, p_poor, p_poor_toxic)").select("doc_id")
    assert clean.join(corpus_pipeline.mixed(spark, docs, sf_dir), "doc_id", "left_anti").count() == 0
    rows = [(k, 1.0, 0.0, 0.0, 0.0, 0.8) for k in range(50)] + [(50, 0.6, 0.4, 0.0, 0.0, 0.0), (51, 0.1, 0.9, 0.0, 0.0, 0.0), (52, 0.0, 0.0, 1.0, 0.0, 2.0)]
    fixed = spark.createDataFrame(rows, "doc_id bigint, p_good double, p_good_toxic double, p_poor double, p_poor_toxic double, rate double")
    got = {r.doc_id: (r.rate, r.n_copies) for r in corpus_pipeline.with_every_clean(fixed).collect()}
    assert all(got[k] == (1.0, 1) for k in range(51)) and got[51] == (0.0, 0) and got[52][0] == 2.5
    assert corpus_pipeline.with_every_clean(fixed.where("doc_id < 0")).count() == 0
