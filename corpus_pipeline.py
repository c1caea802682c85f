"""Corpus pipeline: toxicity, n-gram Jaccard join, substring dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last return the columns
that came in, whatever further ones there are and whatever they are called. Null texts count as empty, and stay; texts of
any length are taken whole; an empty table gives an empty one. Between stages the rows are Parquet in the folder that driver
and executors share.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketweave.llm import decontam, jaccard, line_dedup, packing, toxicity
from marketweave.llm.common import join_checked, settle

#: SQL has no trained classifier, edit-distance search or tokenizer.
ORACLE_SQL = None


def _plain(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` out of ``row``, some of them changed."""
    return rows.select(*[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns])


def _whole(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _keyed(docs: DataFrame) -> DataFrame:
    """Whole rows as ``row``, their doc_id as ``id``, a hash of doc_id and text as ``doc_id``, and text: each row has its own verdict, with or without a doc_id, and rows equal in both have one."""
    return docs.select(_whole(docs), F.col("doc_id").alias("id"), F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.coalesce("text", F.lit(""))).alias("doc_id"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold; the model is learnt from their labels, held-out ones apart. Equal texts have equal scores; repeated rows all stay or all go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity.score_column(docs, model) < toxicity.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component, null ones last, ties by a hash; of rows equal in doc_id and text one. Texts without words link with none and stay."""
    keyed = _keyed(docs)
    found = jaccard.near_duplicates(keyed.select("doc_id", "text")).select("doc_id", "component_id").join(keyed.select("doc_id", "id"), "doc_id")
    first = F.struct(F.col("id").isNull().alias("last"), "id", "doc_id")
    kept = settle(found.groupBy("component_id").agg(F.min(first)["doc_id"].alias("doc_id")).select("doc_id").distinct(), "kept")
    again = settle(keyed.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "again")
    rows = keyed.join(kept, "doc_id", "left_semi")
    # only rows that are there more than once are dealt out whole
    out = join_checked(rows, again, ["doc_id"], how="left_anti").unionByName(join_checked(rows, again, ["doc_id"], how="left_semi").dropDuplicates(["doc_id"]))
    return _plain(out, docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the sentences and lines that an earlier document, or an earlier place of theirs, has; n_chars follows. No row goes; rows equal in doc_id and text repeat nothing of each other; null doc_ids are the last."""
    cut = line_dedup.remove_repeats(docs.select(_whole(docs), "doc_id", "text"))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return _plain(cut, docs, **changed)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; repeated rows all stay or all go."""
    keyed = _keyed(docs)
    found = settle(decontam.hits(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct(), "leaks")
    return _plain(join_checked(keyed, found, ["doc_id"], how="left_anti"), docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, repeated rows and those without text or doc_id too, as pieces of sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("substring_dedup", drop_repeated_lines),
    ("decontamination", drop_contaminated),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
