import corpus_pipeline
from marketweave.llm import queries as llm

from test_operators import brute_lines, brute_sentences, rows_of

SF = "/root/testdata/sf0.001"


def test_query_removes_short_lines_and_sentences(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = llm.op2_line_dedup(spark, SF)
    assert rows_of(out.select("doc_id", "text")) == brute_lines(rows, brute_sentences) != brute_lines(rows)


def test_stage_removes_short_lines(spark):
    docs = spark.createDataFrame([(1, "All rights reserved.\nles\n\nbody", "en", "x", 0), (2, "all  rights reserved.\nLES\n\nother", "en", "x", 0)], "doc_id long, text string, lang string, source string, n_chars int")
    assert {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()} == {1: ("All rights reserved.\nles\n\nbody", 30), 2: ("\nother", 6)}
