"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from llm_documents import CLASHING, FOLDER, TEXTS, documents, labels
from pyspark.sql import functions as F

from wardlens.llm import decision_list, mixing, pii, queries, simhash_trie


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "SimHash near-dedup",
        "PII",
        "mixing sources to target weights",
        "SentencePiece encoding and decoding",
    ]


def test_run_on_the_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    steps = []
    for place, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{place}")
        docs = spark.read.parquet(f"{tmp_path}/{place}")
        steps.append(docs)
    rules, single, masked, mixed, coded = steps
    assert all(step.columns == columns for step in steps[:4])

    verdicts = queries.QUERIES["op5_decision_list"](spark, FOLDER).where("kept")
    assert sorted(r.doc_id for r in rules.collect()) == sorted(r.doc_id for r in verdicts.collect())
    groups = simhash_trie.simhash_components(rules).select("component_id").distinct()
    assert sorted(r.doc_id for r in single.collect()) == sorted(r[0] for r in groups.collect())
    assert masked.count() == single.count()
    spans = pii.pii_report(single).where("spans <> ''").count()
    changed = masked.alias("m").join(single.alias("s"), "doc_id").where("m.text <> s.text")
    assert changed.count() == spans > 0
    report = mixing.mix_report(masked).where("copies > 0")
    assert mixed.count() == report.agg(F.sum("copies")).first()[0]
    assert coded.count() == mixed.count() and coded.where("not round_trip").count() == 0

    whole = corpus_pipeline.run(spark, FOLDER)
    key = [F.col("doc_id"), F.col("n_ids"), F.col("decoded_sha256")]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(
        map(tuple, coded.select(*key).collect())
    )


def test_stages_on_awkward_and_empty_documents(spark, tmp_path):
    labels(spark, [(5, 1, 0), (14, 0, 0)]).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (documents(spark), documents(spark).limit(0)):
        n = docs.count()
        for place, (_, step) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{n}-{place}"
            step(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            if place < 4:
                assert set(CLASHING.split()) <= set(docs.columns)
        assert (docs.count() > 0) == (n > 0)


def test_kept_rules_are_those_of_the_report(spark):
    docs = documents(spark)
    known = labels(spark)
    kept = decision_list.passing(docs, known)
    report = decision_list.quality_report(docs, known).where("kept")
    assert kept.count() == report.count() and kept.count() < len(TEXTS)
