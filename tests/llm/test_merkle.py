"""The manifest against a tree built in plain Python, and against its SQL."""

import hashlib
import zlib

import duckdb
import pytest

from marketweave.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def digest(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return digest(*[field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([digest(*x[i : i + 8]) for i in range(0, len(x), 8)])
    return levels


def ascend(levels, i, h):
    proof = []
    for x in levels[:-1]:
        run, k = x[i // 8 * 8 : i // 8 * 8 + 8], i % 8
        proof += run[:k] + run[k + 1 :]
        h, i = digest(*run[:k], h, *run[k + 1 :]), i // 8
    return proof, h


def brute(rows):
    langs, out = {}, []
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in order:
        mine = sorted(langs[x], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[x] = mine, tree([leaf(r, r["text"]) for r in mine])
    top = tree([trees[x][1][-1][0] for x in order]) if order else []
    for j, x in enumerate(order):
        mine, levels = trees[x]
        for i, r in enumerate(mine):
            h = leaf(r, r["text"])
            start = h
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                start = leaf(r, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"]))
            proof, folded = ascend(levels, i, start)
            more, folded = ascend(top, j, folded)
            out.append((r["doc_id"], h, levels[-1][0], top[-1][0], digest(*proof, *more), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def plain(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = plain(queries.op12_merkle(spark, SF))
    assert got == brute([r.asDict() for r in docs.collect()])
    assert 0 < sum(r[-1] for r in got) < len(got)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        sql = con.sql(queries.ORACLE["op12_merkle"])
        at = [sql.columns.index(c) for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")]
        assert got == sorted((tuple(r[i] for i in at) for r in sql.fetchall()), key=str)


CASES = {
    "empty": [],
    "one leaf is the root": [(1, "A", "en", None, 1)],
    "all null, and repeated rows": [(None, None, None, None, None), (1, "Ab", None, "x", 2), (1, "Ab", None, "x", 2)],
    "many languages, lone leaves": [(i, f"T{i}", f"l{i % 11}", "s", 3) for i in range(60)] + [(5, "x", "l99", None, None)],
    "nine leaves": [(i, "Ü" * i, "en", "s", 3) for i in range(9)],
    "ties, empty and long texts": [(3, "", "en", "s", 0), (3, None, "en", "s", 0), (3, "Word " * 200_000, "en", "s", 0), (9, "A\n", "", "", 1)],
}


@pytest.mark.parametrize("name", CASES)
def test_small(spark, name):
    docs = spark.createDataFrame(CASES[name], SCHEMA)
    extra = docs.selectExpr("*", "'mine' AS tree", "1 AS idx", "2 AS digest", "text AS leaf", "3 AS n")
    assert plain(merkle.manifest(extra)) == brute([r.asDict() for r in docs.collect()])


def test_bound_of_recursion_is_put_back(spark):
    was = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.manifest(spark.createDataFrame(CASES["nine leaves"], SCHEMA))
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == was


def test_copies_of_runs_keep_keys_small(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_A_COPY", 1)  # copies from the second level on
    docs = spark.createDataFrame([(i, f"T{i}", "en" if i % 3 else None, "s", 3) for i in range(700)], SCHEMA)
    assert plain(merkle.manifest(docs)) == brute([r.asDict() for r in docs.collect()])
