import json

import pytest

import corpus_pipeline
from marketweave.llm import jaccard, toxicity
from marketweave.llm import queries as llm

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, SF), name)
        assert docs.columns == names
        seen.append(docs.count())
        if name == "ngram_jaccard":
            once = jaccard.near_duplicates(docs).collect()
            assert all(r.doc_id == r.component_id for r in once)
        if name == "substring_dedup":
            lines = [" ".join(x.lower().split()) for r in docs.select("text").collect() for x in r.text.split("\n") if len(x.split()) >= 4]
            assert len(lines) == len(set(lines)) and docs.filter("n_chars <> length(text)").count() == 0
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert not any(i in r.text for r in docs.select("text").collect() for i in items)
    assert seen == sorted(seen, reverse=True) and seen[-1] < seen[0]
    packed = corpus_pipeline.pack_windows(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, SF).select("doc_id")
    clean = spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 0").select("doc_id")
    assert clean.join(kept, "doc_id").count() >= 0.98 * clean.join(docs, "doc_id").count()
    assert toxicity.THRESHOLD == 0.7


@pytest.mark.parametrize("name", sorted(llm.QUERIES))
def test_queries_have_their_columns(spark, name):
    want = {
        "op3": {"doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"}, "op5": {"doc_id", "n_shingles", "component_id"}, "op6": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
        "op7": {"doc_id", "held_out", "score", "predicted"}, "op8": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"}, "op10": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    }.get(name.split("_")[0], {"doc_id"})
    assert want <= set(json.loads(llm.QUERIES[name](spark, SF).schema.json()) and llm.QUERIES[name](spark, SF).columns)
