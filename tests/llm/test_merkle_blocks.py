"""Climbing rows stand for 64 leaves and meet small runs without a shuffle; large runs are met in copies, with the same proofs."""

import pytest
from test_merkle import SCHEMA, brute, plain

from marketweave.llm import common, merkle


def table(spark, sizes):
    rows = [(i, f"T{i} Word", lang, "s", i) for lang, n in sizes for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("most", [24_000_000, 0])
def test_blocks_of_all_sizes(spark, monkeypatch, most):
    monkeypatch.setattr(common, "BROADCAST_BYTES", most)
    monkeypatch.setattr(merkle, "ROWS_A_COPY", 1)
    docs = table(spark, [(None, 1), ("", 2), ("a", 7), ("b", 8), ("c", 9), ("d", 63), ("e", 64), ("f", 65), ("g", 129), ("h", 1500)])
    assert plain(merkle.manifest(docs)) == brute([r.asDict() for r in docs.collect()])


def test_climbing_rows_and_runs(spark, monkeypatch):
    seen, climb = {}, merkle._climb

    def counted(anchor, runs, *small):
        seen.update(anchor=anchor.count(), runs=runs.count(), small=small)
        return climb(anchor, runs, *small)

    monkeypatch.setattr(merkle, "_climb", counted)
    docs = table(spark, [("a", 1000), ("b", 3)])
    assert merkle.manifest(docs).count() == 1003
    # 16 blocks and one; runs of 16 and 2 digests, and one of subroots
    assert seen == {"anchor": 17, "runs": 2 + 1 + 1, "small": (True,)}
