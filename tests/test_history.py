"""A history that is stopped and gone on with, pages by cursor, and files whose bytes depend on rows alone."""

import datetime as dt
import hashlib
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketweave.functions.scalars import session_grid
from marketweave.operators import minute_history as history
from marketweave.operators import search
from marketweave.sources import sinks


def minutes(spark, year, days=2, symbols=("600000.SH", "000001.SZ")):
    rows = [(s, dt.datetime(year, 1, 4 + d, m // 60, m % 60), 10.0, 11.0, 9.0, 10.0, 5, 50.0) for s in symbols for d in range(days) for m in session_grid(1)]
    return spark.createDataFrame(rows, "symbol string, trade_time timestamp, open double, high double, low double, close double, volume long, amount double")


def test_a_run_goes_on_where_it_stopped(spark, tmp_path):
    root, calls = str(tmp_path / "h"), []

    def source(year, broken=()):
        calls.append(year)
        if year in broken:
            raise OSError("no archive")
        return minutes(spark, year)

    with pytest.raises(history.Failed, match="2011, attempt 1"):
        history.run(spark, root, 2010, 2012, lambda y: source(y, (2011,)))
    assert {y: (s["status"], s["attempt"]) for y, s in history.states(spark, root).items()} == {2010: ("validated", 1), 2011: ("failed", 1)}
    found, rolled = history.audit(spark, root)
    assert {(r.check, r.scope) for r in found.collect()} == {("missing_year", "2011"), ("missing_year", "2012"), ("year_status", "2011"), ("year_status", "2012")}
    assert [(r.year, r.status, r.errors) for r in rolled.orderBy("year").collect()] == [(2010, "validated", 0), (2011, "failed", 2), (2012, "missing", 2)]
    done = history.run(spark, root, 2011, 2012, source)
    assert calls == [2010, 2011, 2011, 2012] and {y: (s["status"], s["attempt"]) for y, s in done.items()} == {2010: ("validated", 1), 2011: ("validated", 2), 2012: ("validated", 1)}
    assert history.years(spark, root) == (2010, 2012) and history.audit(spark, root)[0].count() == 0
    assert [(r.year, r.attempt, r.status) for r in history.ledger(spark, root).orderBy("number").collect()][:5] == [(2010, 1, "building"), (2010, 1, "built"), (2010, 1, "validated"), (2011, 1, "building"), (2011, 1, "failed")]
    assert history.read(spark, root).filter("frequency = 1").count() == 3 * 2 * 2 * 241
    assert history.read(spark, root, 2012).agg(F.min("trade_date")).first()[0].year == 2012
    # a year that was built is only validated, and its findings fail it
    tree = tmp_path / "h" / done[2012]["folder"]
    history._commit(spark, root, year=2012, attempt=1, status="built", folder=done[2012]["folder"])
    part = tree / "frequency=5/exchange=sh/trade_date=2012-01-05"
    spark.read.parquet(str(part)).withColumn("close", F.col("close") + 1).coalesce(1).write.parquet(str(tmp_path / "other"))
    [f.unlink() for f in part.iterdir()]
    [f.rename(part / f.name) for f in (tmp_path / "other").iterdir() if f.name.startswith("part-")]
    with pytest.raises(history.Failed):
        history.run(spark, root, 2012, 2012, source)
    checks = {(r.year, r.check) for r in history.audit(spark, root)[0].collect()}
    assert calls == [2010, 2011, 2011, 2012] and {(2012, "derived_close_mismatch"), (2012, "codec_mismatch"), (None, "year_status")} <= checks


def test_pages_by_cursor(spark, tmp_path):
    spark.range(5000).selectExpr("id % 700 AS a", "CASE WHEN id % 11 = 0 THEN NULL ELSE id % 5 END AS b", "id").repartitionByRange(20, "a").sortWithinPartitions("a").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    for order in ([("a", False), ("b", True), ("id", False)], [("b", False), ("a", True), ("id", True)]):
        got, after = [], None
        while page := search.page_after(rows, order, 900, after).collect():
            got += [tuple(r) for r in page]
            after = page[-1].asDict()
        assert got == [tuple(r) for r in rows.orderBy(*[F.desc(c) if d else F.asc(c) for c, d in order]).collect()]
    late = search.page_after(rows, [("a", False), ("id", False)], 10, {"a": 690, "id": 690})
    text = late._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(a,690\)", text)
    assert late.count() == 10


def test_equal_rows_have_equal_bytes(spark, tmp_path):
    rows = spark.range(2000).selectExpr("concat('S', id % 3) AS symbol", "date_add(date'2020-01-01', cast(id % 50 as int)) AS date", "id * 0.5 AS close")
    digests = lambda p: {f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in Path(p).iterdir() if not f.name.startswith((".", "_"))}
    for form, end in (("csv", "csv.gz"), ("parquet", "parquet")):
        a, b = str(tmp_path / f"a-{form}"), str(tmp_path / f"b-{form}")
        sinks.symbol_files(rows, a, ["date"], form)
        sinks.symbol_files(rows.orderBy(F.rand(5)).repartition(7), b, ["date"], form)
        first = digests(a)
        assert sorted(first) == [f"S{i}.{end}" for i in range(3)] and first == digests(b)
        sinks.symbol_files(rows.filter("symbol = 'S1'").withColumn("close", F.col("close") + 1), a, ["date"], form)
        again = digests(a)
        assert again["S1." + end] != first["S1." + end] and sorted(n for n in first if first[n] == again[n]) == [f"S0.{end}", f"S2.{end}"]
    assert spark.read.option("header", True).csv(str(tmp_path / "a-csv")).count() == 2000
