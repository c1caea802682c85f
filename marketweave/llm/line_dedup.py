"""Exact removal of repeated lines, paragraphs, or sentences within lines.

A unit is a line, a paragraph between empty lines, or (``sentence``) a part of a line: lines are cut behind sentence ends,
but only where the part so far has ``min_words`` words, and a shorter rest joins the part before it; so every word is in a
unit, a short line is one by itself, and a passage copied into the middle of a line still shares its inner units. Units are
normalised: lower case, runs of white space become one blank, none at the ends; empty ones do not count. Of all units with
one digest in all documents, the one with the smallest (doc_id, place) stays; the others are removed. Offsets of what is
removed are character offsets in the original text.

One pass over the unit keys: a task keeps, of the units that it has of one digest, only the first for the shuffle; the others
are known to go. What is shuffled are these firsts, once a task and digest, however often a unit occurs; of those that meet,
the first stays and the others go. The texts move once, to meet the list of what to remove.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, passes
from .hashing import mix

MIN_WORDS = 6
_BREAK = {"line": re.compile(r"\n"), "sentence": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r]*\n\s*")}
_SENTENCE_END = re.compile(r"[.!?\u2026\u3002]+[\"')\]\u00bb\u201d\u2019]*\s+")


def _sentences(text: str, start: int, end: int, min_words: int) -> Iterator[tuple[int, int]]:
    parts, first, words, at = [], start, 0, start
    for m in _SENTENCE_END.finditer(text, start, end):
        words += len(text[at : m.end()].split())
        at = m.end()
        if words >= min_words:
            parts.append((first, at))
            first, words = at, 0
    if parts and words + len(text[at:end].split()) < min_words:
        first = parts.pop()[0]
    return iter([*parts, (first, end)])


def spans_of(text: str, unit: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """Number of the line or paragraph, start and end of every unit, in order; separators belong to none."""
    blocks, at = [], 0
    for m in _BREAK[unit].finditer(text):
        blocks.append((at, m.start()))
        at = m.end()
    blocks.append((at, len(text)))
    if unit != "sentence":
        return [(k, a, b) for k, (a, b) in enumerate(blocks)]
    return [(k, *part) for k, (a, b) in enumerate(blocks) for part in _sentences(text, a, b, min_words)]


#: Units that a task combines before it sends them.
CHUNK = 200_000
_ROW = [("doc_id", pa.int64()), ("_key", pa.int64()), ("unit", pa.int32()), ("known", pa.bool_()), ("high", pa.int64()), ("low", pa.int64())]


def _combined(docs: list[int | None], keys: list[int], units: list[int], digests: list[bytes]) -> pa.RecordBatch:
    """The first unit of each digest, and those that are known to go: their digest is only a place to be dealt to."""
    null = np.array([d is None for d in docs])
    doc = np.array([d or 0 for d in docs], dtype=np.int64)
    key, unit = np.array(keys, dtype=np.int64), np.array(units, dtype=np.int32)
    digest = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
    order = np.lexsort((unit, key, doc, null, digest[:, 1], digest[:, 0]))
    null, doc, key, unit, digest = null[order], doc[order], key[order], unit[order], digest[order]
    new = np.append(True, (digest[1:] != digest[:-1]).any(axis=1))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    same = (null == null[first]) & (doc == doc[first]) & (key == key[first]) & (unit == unit[first])  # another row of the document
    keep = new | ~same
    known = ~new[keep]
    spread = mix(key[keep].view(np.uint64) + unit[keep].astype(np.uint64)).view(np.int64)
    columns = [pa.array(doc[keep], mask=null[keep]), pa.array(key[keep]), pa.array(unit[keep]), pa.array(known), pa.array(np.where(known, spread, digest[keep, 0])), pa.array(np.where(known, 0, digest[keep, 1]))]
    return pa.RecordBatch.from_arrays(columns, schema=pa.schema(_ROW))


def _units(unit: str, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, keys, units, digests = [], [], [], []
        for batch, texts in passes(batches, "text"):
            for doc, key, text in zip(column(batch, "doc_id").to_pylist(), column(batch, "_key").to_pylist(), texts.to_pylist(), strict=True):
                for k, (_, start, end) in enumerate(spans_of(text, unit, min_words)):
                    if plain := " ".join(text[start:end].lower().split()):
                        docs.append(doc)
                        keys.append(key)
                        units.append(k)
                        digests.append(hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            if len(docs) >= CHUNK:
                yield _combined(docs, keys, units, digests)
                docs, keys, units, digests = [], [], [], []
        if docs:
            yield _combined(docs, keys, units, digests)

    return run


def cut_spans(text: str, spans: list[tuple[int, int, int]], drop: set[int]) -> str:
    """The text without the units in ``drop``; a line or paragraph of which nothing is left goes with its separator."""
    separators, out, at = [], [], 0
    while at < len(spans):
        block, first = spans[at][0], at
        while at < len(spans) and spans[at][0] == block:
            at += 1
        kept = [k for k in range(first, at) if k not in drop]
        if kept:
            if out:
                separators.append(text[spans[first - 1][2] : spans[first][1]])
            out.append("".join(text[spans[k][1] : spans[k][2]] for k in kept))
    return "".join(x for pair in zip(out, [*separators, ""], strict=True) for x in pair) if out else ""


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and a hash of the text: rows that share all three are treated alike, without an extra shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_key"))


def repeated_units(documents: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per unit to remove: doc_id, _key, unit."""
    units = keyed(documents).mapInArrow(_units(unit, min_words), "doc_id long, _key long, unit int, known boolean, high long, low long")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_key", "unit")
    met = units.repartition("high", "low").withColumn("first", F.min(rank).over(Window.partitionBy("known", "high", "low")))
    return met.filter(F.col("known") | (rank != F.col("first"))).select("doc_id", "_key", "unit")


def remove_repeats(documents: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``documents`` with ``text`` less its repeated units, and n_units, n_removed, removed_chars (int) and removed_spans (text: start-end of each removed unit, parted by commas).

    What is kept stands in its order with the separators it had before it; a text that loses nothing stays as it is, null
    included. Ties do not occur: places differ. Rows equal in doc_id and text are one document: they repeat nothing of each
    other. Null doc_ids rank last. Texts of any length are taken whole, one at a time. The four new columns replace columns
    of the same names. An empty table gives an empty one.
    """
    gone = repeated_units(documents, unit, min_words)
    lists = gone.groupBy("doc_id", "_key").agg(F.collect_set("unit").alias("gone"))
    # whole rows as one struct: their own column names cannot clash
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("key"))
    joined = whole.join(lists, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("_key")), "left").select("row", "gone")

    @F.pandas_udf("text string, n_units int, n_removed int, removed_chars int, removed_spans string")
    def cut(texts, gone):
        import pandas as pd

        out = []
        for text, lost in zip(texts, gone, strict=True):
            spans = spans_of(text or "", unit, min_words)
            drop = sorted(int(k) for k in lost) if lost is not None else []
            gone_spans = [spans[k][1:] for k in drop]
            kept = cut_spans(text, spans, set(drop)) if drop else text
            out.append((kept, len(spans), len(drop), sum(b - a for a, b in gone_spans), ",".join(f"{a}-{b}" for a, b in gone_spans)))
        return pd.DataFrame(out, columns=["text", "n_units", "n_removed", "removed_chars", "removed_spans"])

    names = [c for c in documents.columns if c not in ("text", "n_units", "n_removed", "removed_chars", "removed_spans")]
    return joined.select("row", cut("row.text", "gone").alias("cut")).select(*[F.col("row")[c].alias(c) for c in names], "cut.*")
