"""Merges whose work is that of the delivery, and the daily update of stored trees."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketweave.operators import merge


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_existing_rows_are_not_sorted(spark, tmp_path):
    """Of stored rows that are read neither a sort nor a shuffle is made: they pass by a broadcast of the delivery's keys."""
    spark.range(1000).selectExpr("cast(id as string) AS k", "id AS v", "'t1' AS retrieved_at").write.parquet(str(tmp_path / "old"))
    old, new = spark.read.parquet(str(tmp_path / "old")), spark.range(900, 1100).selectExpr("cast(id as string) AS k", "0L AS v", "'t2' AS retrieved_at")
    for f in (merge.upsert, merge.upsert_keep_first_seen, merge.strict_upsert):
        out = f(old, new, ["k"])
        text = plan(out)
        assert "SortAggregate" not in text and not re.search(r"\bSort \[", text) and "LeftAnti" in text, f.__name__
        assert "Exchange hashpartitioning" not in text, f.__name__
        assert out.count() == 1100


def test_sides_with_repeats_nulls_and_other_columns(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("a", 2, "w"), ("b", 1, "y"), (None, 5, "n"), ("d", 1, None)], "k string, v int, only_old string")
    new = spark.createDataFrame([("b", 7, 1.0), ("b", 8, 0.5), (None, 6, 2.0), ("c", 3, None)], "k string, v int, only_new double")
    want = [("a", 2, "w", None), ("b", 8, None, 0.5), ("c", 3, None, None), ("d", 1, None, None), (None, 6, None, 2.0)]
    assert rows(merge.upsert(old, new, ["k"]), "k", "v", "only_old", "only_new") == sorted(want, key=str)
    by = merge.upsert(old, new, ["k"], order=[-F.col("v")])
    assert rows(by.filter("k in ('a', 'b')"), "k", "v") == [("a", 1), ("b", 7)]
    assert merge.upsert(old.select("k"), new.select("k"), ["k"]).count() == 5
    assert merge.upsert(old.filter("false"), new, ["k"]).count() == 3 and merge.upsert(old, new.filter("false"), ["k"]).count() == 4


def test_first_seen(spark):
    old = spark.createDataFrame([("a", 1, "t3"), ("a", 2, "t1"), ("b", 1, "t2"), (None, 1, "t0"), ("z", 9, "t9")], "k string, v int, retrieved_at string")
    new = spark.createDataFrame([("a", 5, "t8"), ("c", 5, "t8"), (None, 2, "t8")], "k string, v int, retrieved_at string")
    got = rows(merge.upsert_keep_first_seen(old, new, ["k"]), "k", "v", "retrieved_at")
    assert got == sorted([("a", 5, "t1"), ("b", 1, "t2"), ("c", 5, "t8"), (None, 2, "t0"), ("z", 9, "t9")], key=str)
    again = rows(merge.upsert_keep_first_seen(old, new.filter("k = 'c'"), ["k"]).filter("k = 'a'"), "k", "v", "retrieved_at")
    assert again == [("a", 2, "t1")]


def test_a_delivery_beyond_the_broadcast(spark, monkeypatch):
    old, new = spark.range(1000).selectExpr("id AS k", "0 AS v"), spark.range(900, 1100).selectExpr("id AS k", "1 AS v")
    small = rows(merge.upsert(old, new, ["k"]), "k", "v")
    monkeypatch.setattr(merge, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = merge.upsert(old, new, ["k"], unique=True)
        assert "ShuffledHashJoin" in plan(large) and rows(large, "k", "v") == small and len(small) == 1100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_strict_keys(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    assert merge.strict_upsert(old, spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int"), ["k"]).first()["v"] == 3
    for bad_old, bad_new in ((old.unionByName(old), old), (old, spark.createDataFrame([("", 1)], "k string, v int"))):
        with pytest.raises(merge.InvalidKeys):
            merge.strict_upsert(bad_old, bad_new, ["k"])


def stamps(root):
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in Path(root).rglob("*.parquet")}


def day(spark, days, symbols=("000001.SZ", "600000.SH"), close=1.0):
    data = [(s[-2:], dt.date(2026, 7, d), s, close, "qfq") for d in days for s in symbols]
    return spark.createDataFrame(data, "exchange string, date date, symbol string, close double, adjust string")


def test_only_touched_partitions_are_written(spark, tmp_path):
    profile, history = str(tmp_path / "profile"), str(tmp_path / "history")
    update = lambda rows, end, start="2026-07-01": merge.update_daily_files(spark, profile, history, rows, end, 1, start)
    assert update(day(spark, [20, 21, 22, 25]), "2026-07-22").count() == 6  # the 25th is behind the end
    before = stamps(tmp_path)
    # SZ only: the 20th is before the window of one day back from the 22nd
    touched = update(day(spark, [20, 22, 23], ("000001.SZ",), 2.0), "2026-07-23")
    assert {(r.exchange, r.date.day) for r in touched.collect()} == {("SZ", 22), ("SZ", 23)}
    after = stamps(tmp_path)
    same = {f for f in before if after.get(f) == before[f]}
    assert len(same) == 5 + 1 and all("SH" in f or "date=2026-07-2" in f and "-22" not in f for f in same)
    stored = spark.read.parquet(profile)
    assert rows(stored.filter("exchange = 'SZ'").withColumn("d", F.dayofmonth("date")), "d", "close") == [(20, 1.0), (21, 1.0), (22, 2.0), (23, 2.0)]
    own = spark.read.parquet(history).withColumn("d", F.dayofmonth("date"))
    assert rows(own.filter("symbol = '000001.SZ'"), "d", "close") == [(20, 1.0), (21, 1.0), (22, 2.0), (23, 2.0)]
    assert rows(own.filter("symbol = '600000.SH'"), "d", "close") == [(20, 1.0), (21, 1.0), (22, 1.0)]
    # the same again changes no row; nothing new writes no file
    update(day(spark, [22, 23], ("000001.SZ",), 2.0), "2026-07-23")
    assert spark.read.parquet(profile).count() == 7 and spark.read.parquet(history).count() == 7
    last = stamps(tmp_path)
    assert update(day(spark, [1]), "2026-07-23").count() == 0 and stamps(tmp_path) == last
    # the trees say what update_daily says of tables
    table, _, _ = merge.update_daily(day(spark, [20, 21, 22]), day(spark, [20, 21, 22]), day(spark, [20, 22, 23], ("000001.SZ",), 2.0), "2026-07-23", 1, "2026-07-01")
    assert rows(table, "exchange", "date", "symbol", "close") == rows(spark.read.parquet(profile), "exchange", "date", "symbol", "close")
