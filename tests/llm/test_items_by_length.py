"""Benchmark items of every length are found by one rule, and as often as asked."""

import logging
import random

import numpy as np
from marketweave.llm import decontam

from test_operators import docs, edits, frame, levenshtein  # noqa: F401


def test_whole_words_near_are_exact():
    rnd = random.Random(4)
    for _ in range(1500):
        p, t = bytes(rnd.choices(b"abc ", k=rnd.randrange(1, 12))).strip() or b"a", bytes(rnd.choices(b"abc ", k=rnd.randrange(0, 25)))
        most, opens, closes = rnd.randrange(6), rnd.random() < 0.5, rnd.random() < 0.5
        starts = [i for i in range(len(t)) if t[i] != 32 and (t[i - 1] == 32 if i else opens)]
        ends = [j for j in range(1, len(t) + 1) if t[j - 1] != 32 and (t[j] == 32 if j < len(t) else closes)]
        want = min(((levenshtein(p, t[i:j]), j, i) for i in starts for j in ends if j > i), default=(99,))
        assert decontam.words_near(p, t, most, opens, closes) == (want if want[0] <= most else None)


def test_items_of_all_lengths_are_whole_words(spark):
    """From 20 to 44 bytes: within other words an item counts only if its whole words are near; nothing depends on a size."""
    rows, items = [], []
    for n in range(20, 45):
        item = "small grey owls sleep near every old barn wall"[:n].rstrip()
        items.append((n, item))
        rows += [(100 * n, f"we say {item} again"), (100 * n + 1, f"we say {'z' * 12}{item}{'z' * 12} again"), (100 * n + 2, f"we say {item[:-1]}q again")]
    for n, item in items:
        found = {r.doc_id for r in decontam.hits(frame(spark, [r for r in rows if r[0] // 100 == n]), spark.createDataFrame([(n, item)], "item_id long, text string")).collect()}
        assert found == {100 * n, 100 * n + 2}, n


def test_recall_of_each_length_in_texts(spark, docs):
    """With 14 % of edits nine of ten are found, of the items under 100 bytes and of those above."""
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    items += [(10_000 * n + i, t[:n].rsplit(" ", 1)[0]) for n in (48, 72, 96) for i, (_, t) in enumerate(items)]
    clean = [t for _, t in docs if t and len(t) > 200][:50]
    planted = [(i, f"{clean[i % 50][:150]} {edits(t, 14 * len(t) // 100, 7 + i)} {clean[i % 50][-150:]}", k) for i, (k, t) in enumerate(items)]
    found = {(r.doc_id, r.item_id) for r in decontam.hits(frame(spark, [p[:2] for p in planted]), spark.createDataFrame(items, "item_id long, text string")).collect()}
    size = {k: len(t) for k, t in items}
    for lo, hi in ((32, 64), (64, 100), (100, 1000)):
        want = {(d, k) for d, _, k in planted if lo <= size[k] < hi}
        assert len(want) > 20 and len(found & want) >= 0.9 * len(want), (lo, len(found & want), len(want))


def test_missed_recall_is_told(caplog):
    with caplog.at_level(logging.WARNING):
        items = decontam.Items([(i, f"wo{i} be{i * 7}") for i in range(60)], recall=1.01)
    assert "items found by" in caplog.text and items.recall and all(0 <= x <= 1 for x in items.recall.values())
    assert not decontam.Items([], recall=1.01).groups
    assert np.all([g.walks.walks > decontam.PATIENCE for g in items.groups])
