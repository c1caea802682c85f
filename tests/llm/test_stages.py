"""Each stage on rows with nulls, copies, repeated rows, long texts, clashing columns, and on none, against what must stay."""

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars int, id int, row string, n_removed map<string,int>, `a.b` int"


@pytest.fixture(scope="module")
def item(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 60").orderBy("item_id").first().text


@pytest.fixture(scope="module")
def docs(spark, item):
    body = " ".join(f"word{i}" for i in range(60))
    passage = "Here is a passage that is long enough to be one. And it has a second sentence as well as that."
    texts = [
        (1, body), (2, body + " more"), (2, body + " more"), (None, body), (3, f"These are my own words at first. {passage}"), (4, f"Other words before it here now. {passage} Then own words end it all."), (5, None), (5, None), (6, ""),
        (7, f"before {item} behind"), (None, f"again {item}"), (8, " ".join(f"long{i}" for i in range(40_000))), (9, "quite alone"), (None, "quite alone here"), (None, None),
    ]
    rows = [(d, t, "en", "s", len(t or ""), i, f"r{i}", {"k": i}, i) for i, (d, t) in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS)


def kept(df):
    return sorted(r["a.b"] for r in df.collect())


def test_stages_keep_columns_and_whole_rows(spark, docs):
    before = {r["a.b"]: r for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        for r in out.collect():
            was = before[r["a.b"]]
            assert all(r[c] == was[c] for c in docs.columns if name != "substring_dedup" or c not in ("text", "n_chars")), name


def test_near_duplicates_keep_one_of_each_group(spark, docs):
    got = kept(pipeline.drop_near_duplicates(spark, docs, SF))
    assert set(got) - {6, 7} == {0, 4, 5, 8, 9, 11, 12, 13, 14} and len(set(got) & {6, 7}) == 1


def test_repeated_sentences_go_once(spark, docs):
    out = {r["a.b"]: r for r in pipeline.drop_repeated_lines(spark, docs, SF).collect()}
    assert len(out) == docs.count() and all(r.n_chars == len(r.text or "") for r in out.values())
    assert out[5].text == "Other words before it here now. Then own words end it all." and out[1].text == out[2].text == " ".join(f"word{i}" for i in range(60)) + " more"
    assert out[3].text == "" and out[6].text is None and out[11].n_chars > 300_000


def test_contaminated_rows_go_with_or_without_a_doc_id(spark, docs):
    assert kept(pipeline.drop_contaminated(spark, docs, SF)) == [i for i in range(15) if i not in (9, 10)]


def test_toxic_rows_go(spark, docs):
    labelled = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    more = labelled.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("int").alias("n_chars"), F.lit(0).alias("id"), F.lit("x").alias("row"), F.lit(None).cast("map<string,int>").alias("n_removed"), (100 + F.col("doc_id")).cast("int").alias("a.b"))
    got = kept(pipeline.drop_toxic(spark, docs.unionByName(more), SF))
    assert [x for x in got if x < 100] == list(range(15))
    clean = {100 + r.doc_id for r in labelled.filter("toxic = 0").collect()}
    assert len(clean - set(got)) <= 0.02 * len(clean)


def test_packing_takes_every_row(spark, docs):
    out = pipeline.pack_windows(spark, docs, SF)
    assert out.filter("start = 0").count() == docs.count()


def test_empty_tables(spark, docs):
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.filter("false"), SF).count() == 0, name
