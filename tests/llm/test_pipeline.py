"""The pipeline, stage by stage, against plain re-statements."""

import corpus_pipeline
from tests.llm import brute

from tidemark.llm import langid

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    rows = {r.doc_id: r for r in docs.collect()}

    model = langid.learn(docs)
    kept = {i for i, r in rows.items() if model.predict(r.text, {})[1] >= 0.5}
    first = stages["language ID"](spark, docs, SF)
    assert first.columns == docs.columns
    assert {r.doc_id for r in first.collect()} == kept

    deduped = brute.line_dedup(sorted((i, rows[i].text) for i in kept))
    deduped = {i: t for i, t in deduped.items() if t != "" or rows[i].text == ""}
    second = stages["line dedup"](spark, first, SF)
    assert second.columns == docs.columns
    got = second.collect()
    assert {r.doc_id: r.text for r in got} == deduped
    assert all(r.n_chars == len(r.text) for r in got)

    classes = brute.jaccard(list(deduped.items()))
    unique = {i for i in deduped if classes[i][0] == i}
    third = stages["n-gram Jaccard join"](spark, second, SF)
    assert third.columns == docs.columns
    assert sorted(r.doc_id for r in third.collect()) == sorted(unique)

    clean = {i for i in unique if not (lambda n, hit, _: hit and 20 * hit >= n)(*brute.contamination(deduped[i], items))}
    fourth = stages["benchmark decontamination"](spark, third, SF)
    assert fourth.columns == docs.columns
    assert {r.doc_id for r in fourth.collect()} == clean

    sizes = [(i, rows[i].source, len(brute.ASCII_WORD.findall(deduped[i]))) for i in clean]
    want = brute.mix(sizes)
    assert {r.doc_id: r.taken for r in stages["mixing sources to target weights"](spark, fourth, SF).collect()} == want
    assert {r.doc_id: r.taken for r in corpus_pipeline.run(spark, SF).collect()} == want
