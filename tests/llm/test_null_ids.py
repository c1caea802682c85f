import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_rows_without_doc_id_have_their_own_verdict(spark):
    item = max((r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=len)
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b), (7, c), (None, c), (8, d), (8, d), (3, c), (None, None), (9, item), (None, item)]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int").repartition(3)
    seen = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    assert seen(corpus_pipeline.drop_near_duplicates(spark, docs, SF)) == sorted([(None, a), (None, b), (3, c), (8, d), (None, None), (9, item)], key=str)
    assert seen(corpus_pipeline.drop_contaminated(spark, docs, SF)) == sorted(rows[:9], key=str)
