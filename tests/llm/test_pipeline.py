"""The pipeline's stages, each on what its predecessor kept."""

import hashlib

import corpus_pipeline
from campaignry.llm import exact, jaccard, queries


def test_stages_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = given = queries.table(spark, folder, "documents").cache()
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == given.columns
        kept.append({r[0] for r in docs.select("doc_id").collect()})
    assert 0 < len(kept[2]) <= len(kept[1]) <= len(kept[0]) < given.count()
    labels = {r["doc_id"]: r["quality"] for r in queries.table(spark, folder, "labels").collect()}
    judged = queries.queries()["op10_quality_rules"](spark, folder).filter("kept").select("doc_id").collect()
    assert kept[0] == {r[0] for r in judged} and sum(labels.get(i) == 0 for i in kept[0]) <= 1
    good = given.filter(given.doc_id.isin(sorted(kept[0])))
    assert kept[1] == {r["doc_id"] for r in exact.exact_duplicates(good).filter("kept").collect()}
    once = given.filter(given.doc_id.isin(sorted(kept[1])))
    assert kept[2] == {r["component_id"] for r in jaccard.near_duplicates(once).collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    assert len(last) == docs.count() and all(r["lossless"] and r["text_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in last)
