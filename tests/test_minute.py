import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketweave import schemas
from marketweave.functions import scalars as S
from marketweave.operators import bars, minute, quality
from marketweave.streaming.bars import minute_bars


def at(hour, minute_, day=4):
    return dt.datetime(2010, 1, day, hour, minute_)


def sample(spark, symbol="600519.SH", **change):
    rows = []
    values = dict(open=[10, 10, 11, 12, 11, 13], high=[10, 11, 12, 12, 13, 14], low=[10, 10, 11, 11, 11, 13], close=[10, 11, 12, 11, 13, 14])
    for i in range(6):
        row = {k: float(v[i]) for k, v in values.items()} | {"volume": i + 1, "amount": float([10, 21, 35, 46, 60, 80][i])}
        rows.append((symbol, at(9, 30 + i), row["open"], row["high"], row["low"], row["close"], row["volume"], row["amount"]))
    for (i, field), v in change.get("cells", {}).items():
        r = list(rows[i])
        r[["symbol", "trade_time", "open", "high", "low", "close", "volume", "amount"].index(field)] = v
        rows[i] = tuple(r)
    return spark.createDataFrame(rows, schemas.MINUTE_BAR)


def test_five_minute_roll_up_keeps_the_first_bar_apart(spark):
    got = bars.session_rollup(sample(spark), (5,)).orderBy("trade_time").collect()
    assert [r.trade_time for r in got] == [at(9, 30), at(9, 35)]
    assert (got[1].open, got[1].close, got[1].high, got[1].low, got[1].volume) == (10, 14, 14, 10, 20)


def test_bj_post_close_labels(spark):
    rows = [("430047.BJ", at(15, 0), 1.0, 1.0, 1.0, 1.0, 1, 1.0)] + [("430047.BJ", at(15, i), 1.0, 1.0, 1.0, 1.0, 100 if i == 30 else 0, 1.0) for i in range(1, 31)]
    got = bars.session_rollup(spark.createDataFrame(rows, schemas.MINUTE_BAR), (5,)).orderBy("trade_time").collect()
    assert [r.trade_time.minute for r in got] == [0, 5, 10, 15, 20, 25, 30] and got[0].volume == 1 and got[-1].volume == 100


@pytest.mark.parametrize("exchange,counts", [("", [241, 49, 17, 9, 5]), ("BJ", [271, 55, 19, 10, 6])])
def test_grids(spark, exchange, counts):
    assert [len(S.session_grid(f, exchange)) for f in (1, 5, 15, 30, 60)] == counts
    every = spark.range(1440).select(F.col("id").cast("int").alias("m"))
    for f, n in zip((1, 5, 15, 30, 60), counts):
        assert every.filter(S.on_grid("m", f, F.lit(exchange))).count() == n
        assert spark.range(1).select(S.bars_per_day(F.lit(f), F.lit(exchange))).first()[0] == n


def test_registered_low_and_structural_repairs(spark):
    one = spark.createDataFrame([("601005.SH", dt.datetime(2011, 4, 26, 10, 31), 4.9, 5.0, 0.0, 4.95, 1, 1.0)], schemas.MINUTE_BAR)
    fixed = minute.repair(one, minute.low_registry(spark)).first()
    assert fixed.low == 4.87 and [c.inferred for c in fixed.corrections] == [False] and not fixed.conflict
    got = minute.repair(sample(spark, cells={(1, "low"): 0.0})).filter("size(corrections) > 0").collect()
    assert [(r.low, r.corrections[0].evidence) for r in got] == [(10.0, "structural_ohlc_lower_bound")]
    got = minute.repair(sample(spark, cells={(3, "low"): 11.5, (3, "close"): 9.0, (2, "high"): 18459.89})).orderBy("trade_time").collect()
    assert got[3].low == 9.0 and got[2].high == 12.0 and all(c.inferred for r in got for c in r.corrections)
    moved = minute.repair(one.withColumn("low", F.lit(4.8)), minute.low_registry(spark)).first()
    assert moved.conflict and moved.low == 4.8


def test_zero_day_is_excluded_with_audit(spark):
    zero = sample(spark).select("symbol", (F.col("trade_time") + F.expr("interval 1 day")).alias("trade_time"), *[F.lit(0).cast(t).alias(c) for c, t in sample(spark).dtypes[2:]])
    kept, out = minute.split_zero_days(sample(spark).unionByName(zero))
    assert kept.count() == 6 and [(r.symbol, r.dates, r.rows) for r in out.collect()] == [("600519.SH", [dt.date(2010, 1, 5)], 6)]


def test_validation_findings(spark):
    assert minute.validate(sample(spark)).count() == 0
    bad = sample(spark, cells={(0, "low"): 11.0, (1, "volume"): -1, (2, "amount"): None}).unionByName(sample(spark).limit(1))
    assert {r.check for r in minute.validate(bad).collect()} == {"invalid_ohlc", "negative_activity", "null_value", "duplicate_key"}
    late = spark.createDataFrame([("430047.BJ", at(15, 30), 1.0, 1.0, 1.0, 1.0, -100, -500.0)], schemas.MINUTE_BAR)
    assert minute.validate(late).count() == 0 and minute.post_close_adjustments(late).count() == 1
    assert minute.validate(late.withColumn("trade_time", F.lit(at(15, 0)))).count() == 1


def test_build_leaves_bad_symbols_out(spark):
    bad = sample(spark, "000001.SZ", cells={(1, "open"): -1.0, (1, "low"): -1.0})
    built = minute.build(sample(spark).unionByName(bad))
    assert [r.symbol for r in built["unresolved"].collect()] == ["000001.SZ"]
    counts = {r.frequency: r.rows for r in minute.build_statistics(built["bars"]).collect()}
    assert counts == {1: 6, 5: 2, 15: 2, 30: 2, 60: 2}
    assert all(r.missing == 0 and r.extra == 0 for r in minute.partition_differences(built["bars"]).collect())
    assert minute.build(sample(spark).filter("false"))["bars"].count() == 0


def test_raw_checks(spark):
    raw = sample(spark, cells={(0, "low"): 11.0, (1, "volume"): -1}).select(F.col("symbol").alias("ts_code"), F.lit("1min").alias("freq"), "trade_time", "open", "close", "high", "low", F.col("volume").alias("vol"), "amount", F.lit("600519.SH").alias("member"))
    found = {r.check for r in minute.raw_findings(raw, 1).collect()}
    assert found == {"invalid_ohlc", "negative_volume", "unexpected_bars_per_day"}


def test_normalize_rejects(spark):
    raw = spark.createDataFrame([("600519.SH", "1min", at(9, 30), 1.0, 1.0, 1.0, 1.0, 1, 1.0), ("600518.SH", "1min", at(9, 30), 1.0, 1.0, 1.0, 1.0, 1, 1.0), ("600519.SH", "5min", at(9, 30), 1.0, 1.0, 1.0, 1.0, 1, 1.0), ("600519.SH", "1min", at(9, 31), float("inf"), 1.0, 1.0, 1.0, 1, 1.0)], schemas.VENDOR_MINUTE)
    assert [r.reject for r in minute.normalize(raw, "600519.sh", 1).collect()] == [None, "symbol_mismatch", "frequency_tag_mismatch", "bad_number"]


def test_compare_reports_first_key(spark):
    a = bars.session_rollup(sample(spark), (5,))
    b = a.withColumn("close", F.col("close") + 1)
    got = {r.field: r for r in quality.outer_compare(a, b, ["symbol", "trade_time"], ["open", "close"]).collect()}
    assert got["close"].mismatches == 2 and got["close"].max_abs_diff == 1.0 and "09:30" in got["close"].example and got["open"].mismatches == 0


def test_stream_form_equals_batch(spark, tmp_path):
    ticks = spark.createDataFrame([("a", at(9, 30), i, float(i), i, 1.0) for i in range(5)], "symbol string, ts timestamp, seq long, price double, volume long, amount double")
    ticks.write.parquet(str(tmp_path / "in"))
    stream = minute_bars(spark.readStream.schema(ticks.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("bars_out").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("bars_out").collect() == minute_bars(ticks).collect()
