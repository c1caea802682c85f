"""Fingerprints against vectors summed in plain Python, edits against whole recomputation, likeness against counted units."""

import hashlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from marketweave.llm import fingerprints as fp
from marketweave.llm import queries

SF = "/root/testdata/sf0.001"
MASK = (1 << 32) - 1


def hash64(k, *parts):
    h = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), 42)
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), h)
    return h


def units(text):
    out = []
    for p in text.split("\n"):
        out.append(tuple(hash64(k, p) for k in range(2)))
        w = p.split(" ")
        out += [tuple(hash64(k + 2, *w[i : i + 3]) for k in range(2)) for i in range(len(w) - 2)]
    return out


def brute(text):
    exact, got = [0] * 16, units(text)
    for p in text.split("\n"):
        d = hashlib.sha512(p.encode()).hexdigest()
        exact = [(x + int(d[8 * i : 8 * i + 8], 16)) & MASK for i, x in enumerate(exact)]
    bits = [sum(u[k] >> j & 1 for u in got) for k in range(2) for j in range(64)]
    pairs = [bits[64 * k + j] + (bits[64 * k + j + 32] << 32) for k in range(2) for j in range(32)]
    return "".join(f"{x:016X}" for x in [*exact, len(got), *pairs])


def signed(text):
    got = units(text)
    return [2 * sum(u[k] >> j & 1 for u in got) - len(got) for k in range(2) for j in range(64)]


def like(a, b):
    if brute(a) == brute(b):
        return 1.0
    x, y = signed(a), signed(b)
    both = sum(v * v for v in x) + sum(v * v for v in y)
    return max(0.0, 1 - sum((v - w) ** 2 for v, w in zip(x, y, strict=True)) / both) if both else 0.0


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(rows):
        follows, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        e = t[: len(t) - half] + follows[:half]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), brute(t), brute(e), round(like(t, e), 9), round(like(t, follows), 9)))
    return out


def plain(df):
    rows = df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op11_fingerprint(spark, SF)
    assert plain(got) == expected([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert "Python" not in got._jdf.queryExecution().toString()


SMALL = {
    "empty table": [],
    "one document is its own next": [(7, "Ab cd ef gh\nIj")],
    "nulls and empty texts": [(None, "x y z"), (1, None), (2, ""), (3, "\n"), (4, "\n\n a  b c\n"), (5, "é" * 9)],
    "characters beyond 16 bits": [(-5, "😀 a\n😀"), (4, "日本 語\n\nxx 😀😀😀"), (9, "z")],
    "long text": [(1, "word other\n" * 3000 + "last one here"), (2, "w " * 20000)],
}


@pytest.mark.parametrize("name", SMALL)
def test_small(spark, name):
    docs = spark.createDataFrame(SMALL[name], "doc_id long, text string").selectExpr("*", "1 AS range", "'x' AS fingerprint", "text AS next", "2 AS at", "true AS guest")
    assert plain(fp.edited(docs)) == expected(SMALL[name])


def test_repeated_rows_and_ids(spark):
    got = fp.edited(spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (1, "e f"), (2, "g")], "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 1, 1, 2]
    assert len({r["fingerprint"] for r in got}) == 3


def test_ranges_meet(spark):
    """Every document's next is right across all borders of ranges, whatever their number."""
    docs = spark.range(5000).selectExpr("id * 7 - 900 AS doc_id", "concat('t', id) AS text").orderBy(F.rand(3))
    rows = sorted((r["doc_id"], r["text"], r["next"]) for r in fp.with_next(docs).filter("NOT guest").collect())
    assert len(rows) == 5000 and all(rows[i][2] == rows[(i + 1) % 5000][1] for i in range(5000))


def test_insert_and_delete(spark):
    a, b = "one two three\nfour five six seven", "eight nine ten\nfour five six seven\n\nmore"
    docs = spark.createDataFrame([(1, a, b, f"{b}\n{a}")], "doc_id long, a string, b string, c string")
    lanes = {c: fp.fingerprints(docs, c).first()["fingerprint"] for c in "abc"}
    row = spark.createDataFrame([lanes], "a string, b string, c string")
    x, y, z = (fp.read(F.col(c)) for c in "abc")
    got = row.select(fp.written(fp.plus(x, y)).alias("sum"), fp.written(fp.minus(z, y)).alias("less")).first()
    assert got["sum"] == lanes["c"] == brute(f"{a}\n{b}") and got["less"] == lanes["a"]


def test_likeness_follows_common_units(spark):
    rows = queries.op11_fingerprint(spark, SF).collect()
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    after = {i: docs[(k + 1) % len(docs)][1] for k, (i, _) in enumerate(docs)}
    text, wrong = dict(docs), []
    for r in rows:
        t = text[r["doc_id"]]
        e = t[: len(t) - len(t) // 2] + after[r["doc_id"]][: len(t) // 2]
        x, y = Counter(units(t)), Counter(units(e))
        a, b = sum(v * v for v in x.values()), sum(v * v for v in y.values())
        wrong.append(abs(r["near_edited"] - 2 * sum(v * y[u] for u, v in x.items()) / (a + b)))
    assert sum(wrong) / len(wrong) < 0.07 and max(wrong) < 0.4
    assert sum(r["near_edited"] for r in rows) / len(rows) > 0.35 > 0.2 > sum(r["near_next"] for r in rows) / len(rows)
