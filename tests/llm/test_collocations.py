"""Collocations against counting in plain Python, and against their SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketweave.llm import collocations as co
from marketweave.llm import queries

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=100, first=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    often = {p: a for p, a in f.items() if a >= least}
    inside = Counter()
    for (lang, *p), a in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, *p[i : i + k]] = max(inside[lang, *p[i : i + k]], a)
    out = {}
    for (lang, *p), a in often.items():
        if len(p) > 1 and not 100 * inside[lang, *p] >= 100 * a:
            score, k = min((1000 * a * n[lang] // (f[lang, *p[:k]] * f[lang, *p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, *p[:k]], f[lang, *p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, x in out.items() for i, (s, a, p, left, right) in enumerate(sorted(x)[:first]))


def plain(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Été", "日本", "X-1", "(a)"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "; ", "!", "?\r", "\x0b", "\x0c", ":"]
    return [("".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(rng.randrange(60))), rng.choice(["en", "en", "en", "de", None, "und"])) for _ in range(n)]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = plain(queries.op13_collocations(spark, sf))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
        sql = con.sql(queries.ORACLE["op13_collocations"])
        at = [sql.columns.index(c) for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
        assert got and got == sorted(tuple(r[i] for i in at) for r in sql.fetchall())


@pytest.mark.parametrize("seed", [1, 2])
def test_made_texts(spark, monkeypatch, seed):
    """Few words, so that phrases of all lengths repeat, cuts and scores tie and longer phrases subsume shorter ones."""
    monkeypatch.setattr(co, "LEAST", 3)
    monkeypatch.setattr(co, "FIRST", 20 if seed == 2 else 2000)
    rows = made(seed, 150, 3 * seed) + [("q r s t u v, " * 5, "en")] * 3 + [("a a a a a a a a", "de")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7).selectExpr("*", "1 AS a", "'p' AS prefix", "text AS word", "2 AS n", "'x' AS phrase", "3 AS slice")
    want = brute(rows, 3, co.FIRST)
    assert {len(r[2].split()) for r in want} == {2, 3, 4, 5}
    assert plain(co.collocations(docs)) == want


def test_nothing_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(co, "LEAST", 2)
    for rows in ([], [(None, None), ("", "en"), (" \t.\n", "de")], [("a b. a b", None), ("A B", "und"), (None, "en")], [("one " * 300_000 + "two", "en")]):
        assert plain(co.collocations(spark.createDataFrame(rows, "text string, lang string"))) == brute(rows, 2)


def test_filter_that_lets_all_through(spark, monkeypatch):
    """A filter far too small for its phrases changes nothing but the work."""
    monkeypatch.setattr(co, "LEAST", 3)
    monkeypatch.setattr(co, "PROBES", 1)
    monkeypatch.setattr(co, "MOST_BITS", 64)
    rows = made(5, 120, 4)
    assert plain(co.collocations(spark.createDataFrame(rows, "text string, lang string"))) == brute(rows, 3)


def test_hot_prefixes_are_cut_alike(spark, monkeypatch):
    """Stripes of frequent prefixes in slices have the same sums."""
    monkeypatch.setattr(co, "LEAST", 3)
    monkeypatch.setattr(co, "HOT_EACH", 5)
    rows = made(9, 120, 4)
    assert plain(co.collocations(spark.createDataFrame(rows, "text string, lang string").repartition(5))) == brute(rows, 3)


def test_stripes_sent_early(monkeypatch):
    """A task that may hold few entries sends more stripes with the same sums."""
    rows = made(7, 80, 20)
    batch = pa.RecordBatch.from_pydict({"lang": [x or "und" for _, x in rows], "text": [t for t, _ in rows]})
    sums = []
    for held in (1, 1_000_000):
        monkeypatch.setattr(co, "HELD", held)
        total = Counter()
        for out in co._mapper(0, 64)([batch.slice(i, 10) for i in range(0, 80, 10)]):
            for r in out.to_pylist():
                for lines in zip(*[r[c].split("\n") for c in ("prefixes", "words", "counts")], strict=True):
                    total.update({(r["lang"], r["bundle"], lines[0], w): int(c) for w, c in zip(lines[1].split(" "), lines[2].split(" "), strict=True)})
        sums.append(total)
    assert sums[0] == sums[1] and sum(sums[0].values()) > 1000


def test_bundles_are_added_whole(monkeypatch):
    """However few bytes are added at a time, a bundle that goes on over batches is added once."""
    rows = [("en", b, "p", f"a b{i}", "1 2") for b in range(5) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32() if i == 1 else pa.string()) for i in range(5)], names=["lang", "bundle", "prefixes", "words", "counts"])
    for most in (1, 16 << 20):
        monkeypatch.setattr(co, "MERGED_BYTES", most)
        out = [r for x in co._adder(40)([batch.slice(i, 7) for i in range(0, 200, 7)]) for r in x.to_pylist()]
        assert sum(r["a"] for r in out if r["word"] is None) == 600
        assert sum(r["a"] for r in out if r["word"] == "a") == 200 and all(r["a"] % 40 == 0 for r in out if r["word"] == "a")


def test_keys_of_tasks_and_of_phrases_agree():
    words = co._Words(pa.array(["One  two\tthree. four"], type=pa.large_string()))
    keys = words.keys(np.array([co._language("en")], dtype=np.uint64), 3)
    made_of = pa.RecordBatch.from_pydict({"lang": ["en"] * 3, "phrase": ["one", "one two", "one two three"]})
    got = next(iter(co._phrase_keys([made_of]))).column(0).to_numpy().view(np.uint64)
    assert list(got) == [keys[0][0], keys[1][0], keys[2][0]] and keys[1][2] == 0


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**13 + 7, 10**15 + 3, 10**13 + 9, 10**14 + 1)], "a long, n long, l long, r long")
    got = row.select(co._score(*[F.col(c) for c in "anlr"]).alias("s")).first()["s"]
    assert got == 1000 * (10**13 + 7) * (10**15 + 3) // ((10**13 + 9) * (10**14 + 1))
