"""Registered queries over the driver's tables: each applies library operators to whole tables, with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import bars, concepts, financials, merge, minute, pit, quality, reference, returns, search, snapshot
from . import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_P = ", ".join(f"{c}::DOUBLE AS {c}" for c in ("open", "high", "low", "close", "volume", "amount"))
_BAR = "arg_min(open, date)::DOUBLE AS open, max(high)::DOUBLE AS high, min(low)::DOUBLE AS low, arg_max(close, date)::DOUBLE AS close, sum(volume)::DOUBLE AS volume, sum(amount)::DOUBLE AS amount"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


# -- bars


@query(f"WITH {V.DAILY} SELECT symbol, date, {_P} FROM daily")
def bars_daily_ohlcv(spark, sf):
    return V.doubles(V.daily(spark, sf))


@query(f"WITH {V.DAILY} SELECT symbol, max(date) AS date, {_BAR} FROM daily GROUP BY symbol, isoyear(date), week(date)")
def bars_week_ohlcv(spark, sf):
    return V.doubles(bars.calendar_rollup(V.daily(spark, sf), "1w"))


@query(f"WITH {V.DAILY} SELECT symbol, max(date) AS date, {_BAR} FROM daily GROUP BY symbol, date_trunc('month', date)")
def bars_month_ohlcv(spark, sf):
    return V.doubles(bars.calendar_rollup(V.daily(spark, sf), "1mo"))


@query(f"WITH {V.DAILY}, n AS (SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY date) - 1) // 5 AS b FROM daily) SELECT symbol, max(date) AS date, {_BAR} FROM n GROUP BY symbol, b")
def bars_5session_ohlcv(spark, sf):
    return V.doubles(bars.calendar_rollup(V.daily(spark, sf), "5d"))


_BUCKET = "CASE WHEN m > 570 AND m <= 690 THEN 570 + ceil((m - 570) / f)::INT * f WHEN m > 780 AND m <= 900 THEN 780 + ceil((m - 780) / f)::INT * f ELSE m END"
_ROLLED = f"""{V.MINUTES}, f AS (SELECT *, trade_time::DATE AS d, extract(hour FROM trade_time) * 60 + extract(minute FROM trade_time) AS m, unnest([5, 15, 30, 60]) AS f FROM minutes),
g AS (SELECT *, {_BUCKET} AS b FROM f),
rolled AS (SELECT symbol, f AS frequency, d + to_minutes(b::BIGINT) AS trade_time, arg_min(open, trade_time)::DOUBLE AS open, max(high)::DOUBLE AS high, min(low)::DOUBLE AS low, arg_max(close, trade_time)::DOUBLE AS close, sum(volume)::DOUBLE AS volume, sum(amount)::DOUBLE AS amount FROM g GROUP BY symbol, f, d, b)"""


def _volume(df: DataFrame) -> DataFrame:
    return V.doubles(df).withColumn("volume", F.col("volume").cast("double"))


@query(f"WITH {_ROLLED} SELECT * FROM rolled")
def bars_session_rollup(spark, sf):
    return _volume(bars.session_rollup(V.minutes(spark, sf)))


@query(f"WITH {V.MINUTES} SELECT symbol, trade_time::DATE AS date, arg_min(open, trade_time)::DOUBLE AS open, max(high)::DOUBLE AS high, min(low)::DOUBLE AS low, arg_max(close, trade_time)::DOUBLE AS close, sum(volume)::DOUBLE AS volume, sum(amount)::DOUBLE AS amount FROM minutes GROUP BY 1, 2")
def bars_minute_to_daily(spark, sf):
    return _volume(bars.daily_rollup(V.minutes(spark, sf)))


_QUOTE = """SELECT symbol, date, close::DOUBLE AS close, previous::DOUBLE AS previous, (close - previous)::DOUBLE AS change, round((close::DOUBLE / previous::DOUBLE - 1) * 100, 6) AS change_pct, peak::DOUBLE AS peak, round(close::DOUBLE / peak::DOUBLE - 1, 8) AS drawdown
FROM (SELECT *, lag(close) OVER w AS previous, max(high) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS peak, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r FROM {} WINDOW w AS (PARTITION BY symbol ORDER BY date)) WHERE r = 1"""


@query(f"WITH {V.DAILY} " + _QUOTE.format("daily"))
def bars_quote(spark, sf):
    return V.doubles(bars.quote(V.daily(spark, sf)))


@query(f"WITH {V.DAILY}, weekly AS (SELECT symbol, max(date) AS date, {_BAR} FROM daily GROUP BY symbol, isoyear(date), week(date)) " + _QUOTE.format("weekly"))
def bars_week_quote(spark, sf):
    return bars.quote(V.doubles(bars.calendar_rollup(V.daily(spark, sf), "1w")))


@query(f"WITH {V.MINUTES}, p AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trade_time) AS previous FROM minutes) SELECT symbol, max(trade_time) AS trade_time, arg_max(close, trade_time)::DOUBLE AS close, arg_max(previous, trade_time)::DOUBLE AS previous, max(high)::DOUBLE AS peak, count(*) FILTER (volume = 0) AS zero_volume_rows, count(*) AS rows FROM p GROUP BY symbol")
def bars_minute_quote(spark, sf):
    return V.doubles(bars.minute_quote(V.minutes(spark, sf)))


_MA = ", ".join(f"CASE WHEN count(close) OVER w{n} = {n} THEN round((sum(close) OVER w{n})::DOUBLE / {n}, 6) END AS ma{n}" for n in (5, 10, 20))


@query(f"WITH {V.DAILY} SELECT symbol, date, close::DOUBLE AS close, {_MA} FROM daily WINDOW " + ", ".join(f"w{n} AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (5, 10, 20)))
def bars_moving_average(spark, sf):
    out = bars.moving_averages(V.doubles(V.daily(spark, sf)))
    return out.select("symbol", "date", F.col("close").cast("double").alias("close"), *[F.round(F.col(f"ma{n}"), 6).alias(f"ma{n}") for n in (5, 10, 20)])


@query(f"WITH {V.PROFILE} SELECT exchange, date, count(*) AS rows, count(*) FILTER (trade_status = 1) AS traded, sum(amount)::DOUBLE AS amount, count(*) FILTER (is_st = 1) AS st_count FROM profile GROUP BY exchange, date")
def bars_market_summary(spark, sf):
    return V.doubles(bars.market_summary(V.profile(spark, sf)))


@query(f"WITH {V.PROFILE}, v AS (SELECT exchange, symbol || '.' || exchange AS symbol, date, close::DOUBLE AS close, volume::DOUBLE AS volume, row_number() OVER (PARTITION BY symbol, exchange ORDER BY date DESC) AS r FROM profile WHERE trade_status = 1 AND low > 0 AND date >= DATE '1996-01-01') SELECT * EXCLUDE (r) FROM v WHERE r <= 20")
def bars_valid_last_n(spark, sf):
    rows = bars.valid_bars(V.profile(spark, sf).withColumn("symbol", F.concat_ws(".", "symbol", "exchange")), "cn")
    return V.doubles(bars.date_range(rows, start="1996-01-01", last=20).select("exchange", "symbol", "date", "close", "volume"))


@query(f"WITH {V.US_BARS} SELECT asset_type, symbol, date, dividend, split_factor, adj_open AS open, adj_high AS high, adj_low AS low, adj_close AS close, adj_volume AS volume FROM us_bars WHERE low > 0")
def bars_price_mode(spark, sf):
    return bars.price_mode(bars.valid_bars(V.us_bars(spark, sf), "us"), "adjusted").select("asset_type", "symbol", "date", "dividend", "split_factor", "open", "high", "low", "close", "volume")


# -- minute bars


def _broken(spark, sf) -> DataFrame:
    """Minute bars with faults that follow from their place: zero lows, lows and highs outside the envelope, spikes, zero days."""
    m = V.doubles(V.minutes(spark, sf)).withColumn("volume", F.col("volume").cast("double"))
    k = F.minute("trade_time") % 10
    zero = F.dayofmonth("trade_time") == 7
    z = lambda c: F.when(zero, 0.0).otherwise(c)
    low = F.when(k == 1, 0.0).when(k == 2, F.greatest("open", "close") + 1).otherwise(F.col("low"))
    high = F.when(k == 3, F.least("open", "close") / 2).when(k == 4, F.greatest("open", "close") * 3).otherwise(F.col("high"))
    return m.select("symbol", "trade_time", z(F.col("open")).alias("open"), z(high).alias("high"), z(low).alias("low"), z(F.col("close")).alias("close"), z(F.col("volume")).alias("volume"), z(F.col("amount")).alias("amount"))


_BROKEN = f"""{V.MINUTES}, d AS (SELECT symbol, trade_time, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close, volume::DOUBLE AS volume, amount::DOUBLE AS amount, extract(minute FROM trade_time) % 10 AS k, day(trade_time) = 7 AS z FROM minutes),
broken AS (SELECT symbol, trade_time, CASE WHEN z THEN 0 ELSE open END AS open, CASE WHEN z THEN 0 WHEN k = 3 THEN least(open, close) / 2 WHEN k = 4 THEN greatest(open, close) * 3 ELSE high END AS high,
  CASE WHEN z THEN 0 WHEN k = 1 THEN 0 WHEN k = 2 THEN greatest(open, close) + 1 ELSE low END AS low, CASE WHEN z THEN 0 ELSE close END AS close, CASE WHEN z THEN 0 ELSE volume END AS volume, CASE WHEN z THEN 0 ELSE amount END AS amount FROM d)"""
_REPAIRED = f"""{_BROKEN}, l1 AS (SELECT *, low AS low0, high AS high0, CASE WHEN low = 0 AND open > 0 AND high > 0 AND close > 0 AND high >= greatest(open, close) THEN least(open, close) ELSE low END AS lowb FROM broken),
l2 AS (SELECT *, open > 0 AND high > 0 AND lowb > 0 AND close > 0 AS pos FROM l1),
l3 AS (SELECT *, CASE WHEN pos AND lowb > least(open, close) THEN least(open, close) ELSE lowb END AS lowc, CASE WHEN pos AND high < greatest(open, close) THEN greatest(open, close) ELSE high END AS highd FROM l2),
l4 AS (SELECT *, CASE WHEN pos AND highd > 2 * greatest(open, close) THEN greatest(open, close) ELSE highd END AS highe FROM l3)"""


@query(f"WITH {_REPAIRED} SELECT symbol, trade_time, open, highe AS high, lowc AS low, close, (lowb <> low0)::INT + (lowc <> lowb)::INT + (highd <> high0)::INT + (highe <> highd)::INT AS corrections FROM l4")
def min_repair_ohlc(spark, sf):
    return minute.repair(_broken(spark, sf)).select("symbol", "trade_time", "open", "high", "low", "close", F.size("corrections").alias("corrections"))


@query(
    f"WITH {_REPAIRED} SELECT * FROM (SELECT symbol, trade_time, 'low' AS field, low0 AS original_value, lowb AS corrected_value, 'structural_ohlc_lower_bound' AS evidence FROM l4 WHERE lowb <> low0 UNION ALL SELECT symbol, trade_time, 'low', lowb, lowc, 'structural_ohlc_envelope' FROM l4 WHERE lowc <> lowb UNION ALL SELECT symbol, trade_time, 'high', high0, highd, 'structural_ohlc_envelope' FROM l4 WHERE highd <> high0 UNION ALL SELECT symbol, trade_time, 'high', highd, highe, 'extreme_intraminute_spike_guard' FROM l4 WHERE highe <> highd)"
)
def min_repair_audit(spark, sf):
    return minute.audit(minute.repair(_broken(spark, sf))).drop("inferred")


@query(f"WITH {_BROKEN}, days AS (SELECT symbol, trade_time::DATE AS date, count(*) AS n FROM broken GROUP BY 1, 2 HAVING bool_and(open = 0 AND high = 0 AND low = 0 AND close = 0 AND volume = 0 AND amount = 0)) SELECT symbol, string_agg(date::VARCHAR, ',' ORDER BY date) AS dates, sum(n)::BIGINT AS rows FROM days GROUP BY symbol")
def min_zero_day_exclusion(spark, sf):
    return minute.split_zero_days(_broken(spark, sf))[1].select("symbol", F.array_join(F.transform("dates", lambda d: d.cast("string")), ",").alias("dates"), "rows")


@query(
    f"""WITH {_BROKEN}, c AS (SELECT symbol AS scope, count(*) AS total, count(*) FILTER (low > least(open, close) OR high < greatest(open, close) OR low > high OR least(open, high, low, close) <= 0) AS a FROM broken GROUP BY symbol)
SELECT 'error' AS severity, 'invalid_ohlc' AS "check", scope, a AS count, total FROM c WHERE a > 0"""
)
def min_validate(spark, sf):
    return minute.validate(_broken(spark, sf)).select("severity", "check", "scope", "count", "total")


@query(f"WITH {V.MINUTES} SELECT symbol, trade_time::DATE AS date, count(*) AS bars, 241 AS expected FROM minutes GROUP BY 1, 2 HAVING count(*) <> 241")
def min_incomplete_sessions(spark, sf):
    return minute.incomplete_sessions(V.minutes(spark, sf))


def _built(spark, sf) -> DataFrame:
    """1-minute bars and their roll-ups with exchange (by symbol) and trade_date; 15-minute bars of one day are left out."""
    m = V.minutes(spark, sf)
    all_of = m.withColumn("frequency", F.lit(1)).unionByName(bars.session_rollup(m))
    out = all_of.withColumn("exchange", F.when(F.col("symbol") < "m", "sz").otherwise("sh")).withColumn("trade_date", F.to_date("trade_time"))
    return out.filter(~((F.col("frequency") == 15) & (F.dayofmonth("trade_date") == 9)))


_BUILT = f"""{_ROLLED}, built AS (SELECT *, CASE WHEN symbol < 'm' THEN 'sz' ELSE 'sh' END AS exchange, trade_time::DATE AS trade_date FROM (SELECT symbol, frequency, trade_time FROM rolled UNION ALL SELECT symbol, 1, trade_time FROM minutes) WHERE NOT (frequency = 15 AND day(trade_time) = 9))"""


@query(f"WITH {_BUILT} SELECT frequency, count(DISTINCT (exchange, trade_date)) AS partitions, count(*) AS rows, min(trade_date) AS first_date, max(trade_date) AS last_date FROM built GROUP BY frequency")
def min_build_stats(spark, sf):
    return minute.build_statistics(_built(spark, sf))


@query(f"WITH {_BUILT}, p AS (SELECT DISTINCT frequency, exchange, trade_date FROM built), w AS (SELECT exchange, trade_date, unnest([5, 15, 30, 60]) AS frequency FROM p WHERE frequency = 1) SELECT coalesce(w.frequency, p.frequency) AS frequency, count(*) FILTER (p.exchange IS NULL) AS missing, count(*) FILTER (w.exchange IS NULL) AS extra FROM w FULL JOIN (SELECT * FROM p WHERE frequency <> 1) p ON w.frequency = p.frequency AND w.exchange = p.exchange AND w.trade_date = p.trade_date GROUP BY 1")
def min_partition_diff(spark, sf):
    return minute.partition_differences(_built(spark, sf))


def _stored(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Recomputed 30-minute bars and a stored copy with faults."""
    want = _volume(bars.session_rollup(V.minutes(spark, sf), (30,)))
    k = F.dayofmonth("trade_time")
    have = want.filter(k != 3).withColumn("close", F.when(k == 5, F.col("close") + 0.25).otherwise(F.col("close"))).withColumn("volume", F.when(k == 6, F.col("volume") + 1).otherwise(F.col("volume")))
    return want, have


_STORED = f"""{_ROLLED}, want AS (SELECT * FROM rolled WHERE frequency = 30), have AS (SELECT symbol, frequency, trade_time, open, high, low, CASE WHEN day(trade_time) = 5 THEN close + 0.25 ELSE close END AS close, CASE WHEN day(trade_time) = 6 THEN volume + 1 ELSE volume END AS volume, amount FROM want WHERE day(trade_time) <> 3),
j AS (SELECT w.symbol AS ws, h.symbol AS hs, w.trade_time AS t, w.symbol AS s, abs(w.close - h.close) AS dc, abs(w.volume - h.volume) AS dv, h.close AS hc FROM want w FULL JOIN have h ON w.symbol = h.symbol AND w.trade_time = h.trade_time)"""


@query(f"""WITH {_STORED}, c AS (SELECT count(*) AS total, count(*) FILTER (hs IS NULL) AS m, count(*) FILTER (dc > 1e-9 + 1e-12 * abs(hc)) AS c, max(dc) FILTER (dc > 1e-9 + 1e-12 * abs(hc)) AS mc, count(*) FILTER (dv > 0) AS v, max(dv) FILTER (dv > 0) AS mv FROM j)
SELECT * FROM (SELECT 'missing_key' AS "check", m AS count, total, NULL::DOUBLE AS max_abs_diff FROM c UNION ALL SELECT 'close_mismatch', c, total, round(mc, 6) FROM c UNION ALL SELECT 'volume_mismatch', v, total, round(mv, 6) FROM c) WHERE count > 0""")
def min_derived_compare(spark, sf):
    want, have = _stored(spark, sf)
    return quality.derived_compare(want, have, ["symbol", "trade_time"], ["open", "high", "low", "close", "volume", "amount"]).select("check", "count", "total", F.round("max_abs_diff", 6).alias("max_abs_diff"))


@query(f"WITH {V.MINUTES}, y AS (SELECT year(trade_time::DATE)::INT AS year, count(DISTINCT (symbol, trade_time::DATE)) AS partitions, min(trade_time::DATE) AS first_date, max(trade_time::DATE) AS last_date FROM minutes GROUP BY 1) SELECT r::INT AS year, coalesce(partitions, 0) AS partitions, first_date, last_date, partitions IS NULL AS missing FROM range(2022, 2026) t(r) LEFT JOIN y ON y.year = r")
def min_year_audit(spark, sf):
    parts = V.minutes(spark, sf).select(F.col("symbol").alias("exchange"), F.to_date("trade_time").alias("trade_date"))
    return minute.year_audit(parts, 2022, 2025)


# -- quality


def _reference(spark, sf) -> DataFrame:
    p = V.doubles(V.profile(spark, sf))
    return p.filter(F.dayofmonth("date") != 2).select("date", "exchange", "symbol", F.lit("ref").alias("source"), "open", "high", "low", F.when(F.dayofmonth("date") == 4, F.col("close") + 0.5).otherwise(F.col("close")).alias("close"))


@query(f"WITH {V.PROFILE} SELECT date, exchange, upper(symbol) AS symbol, round(CASE WHEN day(date) = 4 THEN -0.5 ELSE 0 END, 6)::DOUBLE AS close_diff, CASE WHEN day(date) = 4 THEN 'mismatch' ELSE 'ok' END AS status FROM profile WHERE day(date) <> 2")
def qc_ohlc_check(spark, sf):
    return quality.ohlc_check(V.doubles(V.profile(spark, sf)), _reference(spark, sf)).select("date", "exchange", "symbol", F.round("close_diff", 6).alias("close_diff"), "status")


@query(f"WITH {V.PROFILE} SELECT count(*) FILTER (day(date) <> 2) AS checked, count(*) FILTER (day(date) = 4) AS mismatched, count(*) FILTER (day(date) = 2) AS missing_reference FROM profile")
def qc_ohlc_summary(spark, sf):
    return quality.ohlc_check_summary(V.doubles(V.profile(spark, sf)), _reference(spark, sf))


@query(f"""WITH {_STORED.replace('h.close AS hc', 'h.close AS hc, w.close AS wc, w.volume AS wv')}, c AS (SELECT count(*) FILTER (hs IS NOT NULL AND ws IS NOT NULL) AS matched, count(*) FILTER (hs IS NULL) AS missing_target, count(*) FILTER (ws IS NULL) AS extra_target, count(*) FILTER (dc > 0.005) AS nc, max(dc) AS mc, count(*) FILTER (dv > greatest(10, 1e-8 * abs(wv))) AS nv, max(dv) AS mv FROM j)
SELECT matched, missing_target, extra_target, 'close' AS field, nc AS mismatches, round(mc, 6) AS max_abs_diff FROM c UNION ALL SELECT matched, missing_target, extra_target, 'volume', nv, round(mv, 6) FROM c""")
def qc_outer_compare(spark, sf):
    want, have = _stored(spark, sf)
    return quality.outer_compare(want, have, ["symbol", "trade_time"], ["close", "volume"]).select("matched", "missing_target", "extra_target", "field", "mismatches", F.round("max_abs_diff", 6).alias("max_abs_diff"))


_CROSS = f"""{V.BRANDED}, cross0 AS (SELECT exchange, date, symbol, price AS open, price AS high, CASE WHEN l_linenumber = 7 THEN 0 ELSE price END AS low, price AS close FROM branded),
health AS (SELECT exchange, date, sum(n)::BIGINT AS rows, sum(n - 1)::BIGINT AS duplicates, sum(b)::BIGINT AS nonpositive_rows FROM (SELECT exchange, date, symbol, count(*) AS n, count(*) FILTER (low <= 0 OR open <= 0) AS b FROM cross0 GROUP BY 1, 2, 3) GROUP BY 1, 2)"""


def _cross(spark, sf) -> DataFrame:
    """A raw cross-section with repeated symbols and zero lows."""
    p = F.col("price").cast("double")
    return V.branded(spark, sf).select("exchange", "date", "symbol", p.alias("open"), p.alias("high"), F.when(F.col("l_linenumber") == 7, 0.0).otherwise(p).alias("low"), p.alias("close"))


@query(f"WITH {_CROSS} SELECT * FROM health")
def qc_partition_health(spark, sf):
    return quality.partition_health(_cross(spark, sf)).drop("missing_columns")


@query(f"WITH {_CROSS} SELECT exchange, date, rows, greatest(5, floor(m * 0.85)::BIGINT) AS row_floor, rows < greatest(5, floor(m * 0.85)::BIGINT) AS low_rows FROM health JOIN (SELECT exchange, median(rows) AS m FROM health GROUP BY exchange) USING (exchange)")
def qc_row_floor(spark, sf):
    return quality.row_floor(quality.partition_health(_cross(spark, sf)), least=5).select("exchange", "date", "rows", "row_floor", "low_rows")


@query(
    f"""WITH {_CROSS}, fl AS (SELECT exchange, greatest(5, floor(median(rows) * 0.85)::BIGINT) AS row_floor FROM health GROUP BY exchange),
grid AS (SELECT date, unnest(['sz', 'sh', 'bj']) AS exchange FROM (SELECT DISTINCT date FROM cross0)), j AS (SELECT g.exchange, g.date, rows, duplicates, nonpositive_rows, row_floor FROM grid g LEFT JOIN (health JOIN fl USING (exchange)) h ON g.exchange = h.exchange AND g.date = h.date)
SELECT exchange, date, coalesce(rows, 0) AS rows, array_to_string(list_filter([CASE WHEN rows IS NULL THEN 'missing' END, CASE WHEN rows < row_floor THEN 'low_rows' END, CASE WHEN duplicates > 0 THEN 'duplicate_symbols' END, CASE WHEN nonpositive_rows > 0 THEN 'nonpositive_ohlc' END], lambda x: x IS NOT NULL), ',') AS issues FROM j"""
)
def qc_profile_health(spark, sf):
    rows = _cross(spark, sf)
    return quality.profile_health(rows, ["sz", "sh", "bj"], rows.select("date").distinct(), least=5).select("exchange", "date", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.array_join("issues", ",").alias("issues"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def qc_duplicate_keys(spark, sf):
    return quality.duplicate_keys(V.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _us_broken(spark, sf) -> DataFrame:
    b = V.us_bars(spark, sf)
    d = F.dayofmonth("date")
    return b.withColumn("high", F.when(d == 3, F.lit(0.01)).otherwise(F.col("high"))).withColumn("dividend", F.when(d == 4, -1.0).otherwise(F.col("dividend"))).withColumn("split_factor", F.when(d == 5, 0.0).otherwise(F.col("split_factor")))


@query(
    f"""WITH {V.US_BARS}, c AS (SELECT asset_type || '/' || symbol AS scope, count(*) AS total, count(*) FILTER (day(date) = 3) AS o, count(*) FILTER (day(date) = 4) AS d, count(*) FILTER (day(date) = 5) AS s FROM us_bars GROUP BY 1)
SELECT * FROM (SELECT scope, 'raw_ohlc' AS "check", o AS count, total FROM c UNION ALL SELECT scope, 'negative_dividend', d, total FROM c UNION ALL SELECT scope, 'split_factor', s, total FROM c
  UNION ALL SELECT asset_type || '/' || symbol, 'missing_source', count(*) FILTER (day(date) = 6), count(*) FROM us_bars GROUP BY 1
  UNION ALL SELECT scope, 'date_order', count(*) FILTER (before > date), count(*) FROM (SELECT asset_type || '/' || symbol AS scope, date, lag(date) OVER (PARTITION BY asset_type, symbol ORDER BY date - CASE WHEN day(date) = 7 THEN 40 ELSE 0 END, date) AS before FROM us_bars) GROUP BY 1
  UNION ALL SELECT 'etf/' || s_name, 'no_rows', 1, 1 FROM supplier) WHERE count > 0"""
)
def qc_us_findings(spark, sf):
    """Also rows of the sixth without a source, those of the seventh 40 days too early in the file, and assets of the universe without rows."""
    b = _us_broken(spark, sf)
    d = F.dayofmonth("date")
    late = F.date_sub("date", F.when(d == 7, 40).otherwise(0))
    placed = b.withColumn("source", F.when(d == 6, F.lit(" ")).otherwise(F.lit("tiingo"))).withColumn("place", F.row_number().over(Window.partitionBy("asset_type", "symbol").orderBy(late, "date")))
    universe = b.select("asset_type", "symbol").distinct().unionByName(V.table(spark, sf, "supplier").select(F.lit("etf").alias("asset_type"), F.col("s_name").alias("symbol")))
    return quality.us_daily_findings(placed, universe).select("scope", "check", "count", "total")


@query("SELECT l_partkey || '-' || l_suppkey AS symbol, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS present FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) < (SELECT count(DISTINCT l_returnflag) FROM lineitem)")
def qc_symbol_set_diff(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("symbol"), "l_returnflag")
    return quality.set_differences(rows, "symbol", "l_returnflag").select("symbol", F.array_join("present", ",").alias("present"))


@query("WITH have AS (SELECT DISTINCT l_partkey AS symbol, date_trunc('month', l_shipdate)::DATE AS month FROM lineitem) SELECT s.symbol, m.month::DATE AS month FROM (SELECT DISTINCT symbol FROM have) s, (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS month) m WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.symbol = s.symbol AND h.month = m.month)")
def qc_missing_months(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("symbol"), F.to_date("l_shipdate").alias("month")).distinct()
    return quality.missing_months(rows, "symbol", "1995-01-15", "2001-12-15")


# -- merge


def _sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    d = V.doubles(V.daily(spark, sf)).select("symbol", "date", "close", "volume")
    old = d.filter(F.dayofmonth("date") <= 20).withColumn("retrieved_at", F.lit("old"))
    new = d.filter(F.dayofmonth("date") >= 15).withColumn("close", F.col("close") + 1).withColumn("retrieved_at", F.lit("new"))
    return old, new


_SIDES = f"{V.DAILY}, sides AS (SELECT symbol, date, close::DOUBLE + CASE WHEN day(date) >= 15 THEN 1 ELSE 0 END AS close, volume::DOUBLE AS volume FROM daily)"


@query(f"WITH {_SIDES} SELECT *, CASE WHEN day(date) >= 15 THEN 'new' ELSE 'old' END AS retrieved_at FROM sides")
def merge_upsert(spark, sf):
    return merge.upsert(*_sides(spark, sf), ["symbol", "date"])


@query(f"WITH {_SIDES} SELECT *, CASE WHEN day(date) <= 20 THEN 'old' ELSE 'new' END AS retrieved_at FROM sides")
def merge_keep_first_seen(spark, sf):
    return merge.upsert_keep_first_seen(*_sides(spark, sf), ["symbol", "date"])


@query(f"WITH {V.US_BARS} SELECT DISTINCT asset_type, symbol FROM us_bars WHERE day(date) = 15")
def merge_changed_actions(spark, sf):
    b = V.us_bars(spark, sf)
    later = b.withColumn("dividend", F.when(F.dayofmonth("date") == 15, 0.75).otherwise(F.col("dividend")))
    return merge.changed_actions(b, later)


@query("SELECT symbol, first(name ORDER BY side) AS name, first(source ORDER BY side) AS source FROM (SELECT s_name AS symbol, 'supplier ' || s_suppkey AS name, 'meta' AS source, 0 AS side FROM supplier UNION ALL SELECT 'Supplier#' || right(c_name, 9), NULL, 'files', 1 FROM customer UNION ALL SELECT 'Supplier#' || lpad(p_partkey::VARCHAR, 9, '0'), NULL, 'archive', 2 FROM part) GROUP BY symbol")
def merge_union_first(spark, sf):
    s, c, p = (V.table(spark, sf, t) for t in ("supplier", "customer", "part"))
    none = F.lit(None).cast("string").alias("name")
    meta = s.select(F.col("s_name").alias("symbol"), F.concat(F.lit("supplier "), F.col("s_suppkey").cast("string")).alias("name"), F.lit("meta").alias("source"))
    files = c.select(F.concat(F.lit("Supplier#"), F.right("c_name", F.lit(9))).alias("symbol"), none, F.lit("files").alias("source"))
    archive = p.select(F.concat(F.lit("Supplier#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("symbol"), none, F.lit("archive").alias("source"))
    return merge.union_first([meta, files, archive], ["symbol"])


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'new' ELSE 'old' END AS name, c_nationkey AS nation FROM customer")
def merge_fill_blanks(spark, sf):
    c = V.table(spark, sf, "customer")
    old = c.select(F.col("c_custkey").alias("id"), F.lit("old").alias("name"), F.col("c_nationkey").alias("nation"))
    new = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 6 == 0, "new").otherwise("").alias("name"))
    return merge.fill_blanks(old, new, ["id"])


@query(f"WITH {V.PERIODS} SELECT symbol, report_period, arg_min(value, available_date) FILTER (value > 300000)::DOUBLE AS big, arg_min(value, available_date) FILTER (value <= 300000)::DOUBLE AS small, string_agg(DISTINCT right(accession, 1), ',' ORDER BY right(accession, 1)) AS flags FROM periods GROUP BY 1, 2")
def merge_versions(spark, sf):
    p = V.periods(spark, sf)
    rows = p.withColumn("big", F.when(F.col("value") > 300000, F.col("value"))).withColumn("small", F.when(F.col("value") <= 300000, F.col("value"))).withColumn("flags", F.array(F.right("accession", F.lit(1))))
    return V.doubles(merge.merge_versions(rows, ["symbol", "report_period"], ["big", "small"], "available_date", "flags").withColumn("flags", F.array_join("flags", ",")))


@query("WITH seen AS (SELECT DISTINCT o_custkey AS symbol, year(o_orderdate)::INT AS year, quarter(o_orderdate)::INT AS quarter FROM orders) SELECT u.c_custkey AS symbol, y::INT AS year, q::INT AS quarter FROM customer u, range(1995, 1997) a(y), range(1, 5) b(q) WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.symbol = u.c_custkey AND s.year = y AND s.quarter = q)")
def merge_period_gaps(spark, sf):
    seen = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"))
    return merge.period_gaps(V.table(spark, sf, "customer").select(F.col("c_custkey").alias("symbol")), seen, 1995, 1996)


@query("WITH last AS (SELECT o_custkey, max(o_orderdate::DATE) AS d FROM orders GROUP BY 1) SELECT c_custkey AS symbol, d AS last_date, CASE WHEN c_custkey % 4 = 0 THEN DATE '1997-06-30' ELSE DATE '1998-01-31' END AS required_date, coalesce(d >= CASE WHEN c_custkey % 4 = 0 THEN DATE '1997-06-30' ELSE DATE '1998-01-31' END, false) AS covered FROM customer LEFT JOIN last ON o_custkey = c_custkey")
def merge_coverage(spark, sf):
    u = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("symbol"), F.when(F.col("c_custkey") % 4 == 0, F.lit("1997-06-30").cast("date")).alias("delisting_date"))
    return merge.coverage(u, V.table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date")), "1998-01-31")


@query(f"WITH {V.PERIODS} SELECT symbol, report_period, max(accession) AS accession, arg_max(value, accession)::DOUBLE AS value FROM periods GROUP BY 1, 2")
def merge_latest_version(spark, sf):
    return V.doubles(merge.latest_by(V.periods(spark, sf), ["symbol", "report_period"], pit.VERSION).select("symbol", "report_period", "accession", "value"))


@query(f"WITH {V.PERIODS} SELECT symbol, report_period, min(accession) AS accession, arg_min(value, accession)::DOUBLE AS value FROM periods GROUP BY 1, 2")
def merge_earliest_version(spark, sf):
    return V.doubles(merge.earliest_by(V.periods(spark, sf), ["symbol", "report_period"], pit.VERSION).select("symbol", "report_period", "accession", "value"))


@query("SELECT DISTINCT o_custkey AS symbol FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def merge_unknown_selectors(spark, sf):
    have = V.table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("symbol"))
    return merge.unknown(V.table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol")), have, ["symbol"])


# -- returns


_SPLIT = f"{V.US_BARS}, adjusted AS (SELECT *, close / coalesce(product(split_factor) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1) AS split_close FROM us_bars)"


@query(f"WITH {_SPLIT} SELECT symbol, date, close, split_close FROM adjusted")
def ret_split_adjusted(spark, sf):
    return returns.split_adjusted(V.us_bars(spark, sf)).select("symbol", "date", "close", "split_close")


@query(
    f"""WITH {_SPLIT}, n AS (SELECT *, row_number() OVER w AS n, max(split_close) OVER (w ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS h1, max(split_close) OVER (w ROWS BETWEEN 755 PRECEDING AND CURRENT ROW) AS h3 FROM adjusted WINDOW w AS (PARTITION BY symbol ORDER BY date)),
t AS (SELECT symbol, max(date) AS date, arg_max(split_close, date) AS close, arg_max(h1, date) AS h1, arg_max(h3, date) AS h3, max(split_close) AS ath, arg_max(adj_close, date) AS a, max(adj_close) AS ta, max(n) AS n FROM n GROUP BY symbol)
SELECT 'stock' AS asset_type, t.symbol, t.date, t.close, ath, x.date AS ath_date, t.n - x.n AS sessions_since_ath, round(t.close / ath - 1, 8) AS drawdown, round(t.close / t.h1 - 1, 8) AS drawdown_252, round(t.close / t.h3 - 1, 8) AS drawdown_756, round(a / ta - 1, 8) AS total_return_drawdown
FROM t JOIN (SELECT symbol, split_close, max(date) AS date, max(n) AS n FROM n GROUP BY 1, 2) x ON x.symbol = t.symbol AND x.split_close = t.ath"""
)
def ret_drawdown(spark, sf):
    return returns.drawdowns(V.us_bars(spark, sf))


# -- point in time


@query(f"WITH {V.PERIODS}, v AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY report_period DESC, available_date DESC, accession DESC) AS r FROM periods WHERE available_date <= DATE '1997-03-15') SELECT symbol, report_period, accession, value::DOUBLE AS value, (DATE '1997-03-15' - report_period)::INT AS age_days, DATE '1997-03-15' - report_period > 60 AS stale FROM v WHERE r = 1")
def pit_latest_as_of(spark, sf):
    return V.doubles(pit.latest_as_of(V.periods(spark, sf), "1997-03-15", stale_days=60).select("symbol", "report_period", "accession", "value", "age_days", "stale"))


def _asks(spark, sf, name: str) -> DataFrame:
    return V.periods(spark, sf).select("symbol", F.date_add("report_period", 45).alias(name)).distinct()


@query(f"WITH {V.PERIODS}, asks AS (SELECT DISTINCT symbol, (report_period + 45)::DATE AS as_of FROM periods), j AS (SELECT a.symbol, a.as_of, p.report_period, p.accession, row_number() OVER (PARTITION BY a.symbol, a.as_of ORDER BY report_period DESC, available_date DESC, accession DESC) AS r FROM asks a JOIN periods p ON p.symbol = a.symbol AND p.available_date <= a.as_of) SELECT symbol, as_of, report_period, accession FROM j WHERE r = 1")
def pit_latest_as_of_dates(spark, sf):
    return pit.latest_as_of_dates(V.periods(spark, sf), _asks(spark, sf, "as_of")).select("symbol", "as_of", "report_period", "accession")


@query("WITH obs AS (SELECT DISTINCT o_custkey AS symbol, o_orderdate::DATE AS observed_date FROM orders), asks AS (SELECT c_custkey AS symbol, unnest([DATE '1996-06-30', DATE '1997-12-31']) AS decision_date FROM customer) SELECT a.symbol, decision_date, max(observed_date) AS observed_date FROM asks a JOIN obs o ON o.symbol = a.symbol AND observed_date <= decision_date GROUP BY 1, 2")
def pit_as_of_join(spark, sf):
    obs = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("observed_date")).distinct()
    asks = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("symbol"), F.explode(F.array(F.lit("1996-06-30").cast("date"), F.lit("1997-12-31").cast("date"))).alias("decision_date"))
    return pit.as_of_dates(obs, asks, ["symbol"])


@query(f"WITH {V.PROFILE}, v AS (SELECT exchange, symbol, date, CASE WHEN trade_status = 1 THEN close::DOUBLE END AS c FROM profile) SELECT exchange, symbol, date, lag(c IGNORE NULLS) OVER (PARTITION BY exchange, symbol ORDER BY date) AS prior_price FROM v")
def pit_prior_price(spark, sf):
    rows = V.doubles(V.profile(spark, sf)).withColumn("close", F.when(F.col("trade_status") == 1, F.col("close"))).withColumn("preclose", F.lit(None).cast("double"))
    return pit.prior_price(rows).select("exchange", "symbol", "date", "prior_price")


@query(f"WITH {V.PERIODS}, p AS (SELECT symbol, report_period, fiscal_period FROM periods GROUP BY ALL), w AS (SELECT *, lag(report_period) OVER o AS a, lag(report_period, 2) OVER o AS b, lag(report_period, 3) OVER o AS c FROM p WINDOW o AS (PARTITION BY symbol ORDER BY report_period)) SELECT symbol, report_period, coalesce(report_period - a BETWEEN 45 AND 150 AND a - b BETWEEN 45 AND 150 AND b - c BETWEEN 45 AND 150 AND report_period - c BETWEEN 250 AND 430, false) AS consecutive FROM w")
def pit_consecutive_quarters(spark, sf):
    rows = V.periods(spark, sf).select("symbol", "report_period", "fiscal_period").distinct()
    return pit.consecutive_quarters(rows).select("symbol", "report_period", "consecutive")


@query("WITH days AS (SELECT DISTINCT l_shipdate::DATE AS date FROM lineitem), s AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM days) SELECT count(*) AS selected, max(n) - min(n) + 1 AS span, count(*) = max(n) - min(n) + 1 AS contiguous FROM s WHERE date BETWEEN DATE '1996-03-01' AND DATE '1996-04-30'")
def pit_contiguous_dates(spark, sf):
    days = V.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    return pit.contiguous(days.filter("date between '1996-03-01' and '1996-04-30'"), days)


# -- financials


@query("WITH t AS (SELECT o_orderkey, (o_orderdate::DATE - (o_orderkey % 420)::INT)::DATE AS s, o_orderdate::DATE AS e, (o_orderkey % 420) + 1 AS n, CASE WHEN o_orderkey % 2 = 0 THEN 'FY' ELSE 'Q1' END AS fp FROM orders) SELECT o_orderkey, CASE WHEN n BETWEEN 300 AND 390 AND fp = 'FY' THEN 'annual' WHEN n BETWEEN 60 AND 120 THEN 'quarter' WHEN n BETWEEN 150 AND 220 THEN 'h1_ytd' WHEN n BETWEEN 230 AND 300 THEN 'nine_month_ytd' WHEN n BETWEEN 300 AND 390 THEN 'annual' ELSE 'ambiguous' END AS cls FROM t")
def fin_period_class(spark, sf):
    rows = V.table(spark, sf, "orders").withColumn("e", F.to_date("o_orderdate")).withColumn("s", F.date_sub("e", (F.col("o_orderkey") % 420).cast("int")))
    return rows.select("o_orderkey", S.period_class("s", "e", F.lit("10-Q"), F.when(F.col("o_orderkey") % 2 == 0, "FY").otherwise("Q1")).alias("cls"))


def _facts(spark, sf) -> DataFrame:
    """Order totals as revenue facts: of each nation's quarters one fact per priority, under five tags of different preference."""
    tags = concepts.CONCEPTS[0][4][:5]
    p = V.periods(spark, sf)
    version = F.right("accession", F.lit(1)).cast("int")
    tag = F.element_at(F.array(*map(F.lit, tags)), version)
    start = F.trunc("report_period", "quarter")
    return p.select("symbol", F.concat_ws("-", "symbol", F.date_format("report_period", "yyyyMMdd"), version.cast("string")).alias("row_id"), F.lit("us-gaap").alias("taxonomy"), tag.alias("tag"), F.lit("USD").alias("unit"), start.alias("start_date"), F.col("report_period").alias("end_date"), F.col("value").cast("decimal(38,12)").alias("value"), F.date_add("report_period", 40).alias("available_date"), F.lit("x").alias("accepted_at"), "form", "fiscal_year", "fiscal_period", F.concat_ws("-", "symbol", F.date_format("report_period", "yyyyMMdd")).alias("accession"), F.lit("r").alias("retrieved_at"))


@query(f"WITH {V.PERIODS}, k AS (SELECT *, right(accession, 1)::INT AS v FROM periods WHERE (report_period - date_trunc('quarter', report_period)::DATE) + 1 BETWEEN 60 AND 120) SELECT symbol, report_period AS end_date, 'revenue' AS metric, arg_min(value, v)::DOUBLE AS value, count(DISTINCT value) > 1 AS conflict, min(symbol || '-' || strftime(report_period, '%Y%m%d') || '-' || v) AS row_ids FROM k GROUP BY symbol, report_period")
def fin_candidate_choice(spark, sf):
    out = financials.candidate_choice(financials.mapped_facts(_facts(spark, sf)))
    return V.doubles(out.select("symbol", "end_date", "metric", "value", "conflict", F.array_join("row_ids", ";").alias("row_ids")))


@query(f"WITH {V.PERIODS}, n AS (SELECT p.symbol, p.report_period, p.accession, p.value, q.value AS old, row_number() OVER (PARTITION BY p.symbol, p.accession ORDER BY abs((p.report_period - q.report_period) - 365), q.available_date DESC, q.accession) AS r FROM periods p LEFT JOIN periods q ON q.symbol = p.symbol AND q.fiscal_period = p.fiscal_period AND q.available_date <= p.available_date AND p.report_period - q.report_period BETWEEN 330 AND 400) SELECT symbol, report_period, accession, value::DOUBLE AS value, old::DOUBLE AS prior_value, (value * 100)::BIGINT * 1000 // (old * 100)::BIGINT AS permille FROM n WHERE r = 1")
def fin_yoy(spark, sf):
    out = pit.prior_year(V.periods(spark, sf), "value").select("symbol", "report_period", "accession", "value", "prior_value", F.floor((F.col("yoy") + 1) * 1000).cast("long").alias("permille"))
    return V.doubles(out)


_TTM = f"""{V.PERIODS}, ev AS (SELECT DISTINCT symbol, available_date AS a, accession AS x FROM periods), seen AS (SELECT e.a, e.x, p.* FROM ev e JOIN periods p ON p.symbol = e.symbol AND p.available_date <= e.a),
top AS (SELECT *, dense_rank() OVER (PARTITION BY symbol, a, x ORDER BY report_period DESC) AS k FROM seen), four AS (SELECT * FROM top WHERE k <= 4),
best AS (SELECT symbol, a, x, report_period, arg_max(value, (available_date, accession)) AS value, bool_or(accession = x) AS touched FROM four GROUP BY 1, 2, 3, 4),
g AS (SELECT *, report_period - lag(report_period) OVER (PARTITION BY symbol, a, x ORDER BY report_period) AS gap FROM best)
SELECT symbol, max(report_period) AS report_period, a AS available_date, x AS accession, sum(value)::DOUBLE AS revenue FROM g GROUP BY symbol, a, x HAVING count(*) = 4 AND bool_or(touched) AND bool_and(gap IS NULL OR gap BETWEEN 45 AND 150) AND max(report_period) - min(report_period) BETWEEN 250 AND 430"""


@query(f"WITH {_TTM}")
def fin_ttm(spark, sf):
    p = V.periods(spark, sf)
    versions = p.select("symbol", "period_type", "report_period", "available_date", "accession", "accepted_at", "form", "fiscal_year", "fiscal_period", F.trunc("report_period", "quarter").alias("period_start"))
    metrics = p.select(*financials.ROW, F.lit("revenue").alias("metric"), F.col("value").cast("decimal(38,12)").alias("value"), F.lit("us-gaap").alias("taxonomy"), F.lit("Revenues").alias("tag"), F.lit("USD").alias("unit"), F.array("accession").alias("row_ids"), F.lit("direct").alias("calculation"), F.array().cast("array<date>").alias("component_periods"), F.array("accession").alias("component_accessions"))
    _, out = financials.trailing(versions, metrics)
    return V.doubles(out.select("symbol", "report_period", "available_date", "accession", F.col("value").alias("revenue")))


@query(f"WITH {V.PERIODS}, e AS (SELECT symbol, report_period, right(min(accession), 1) AS v FROM periods GROUP BY 1, 2) SELECT symbol, report_period, (year(report_period) + (v <> '1')::INT)::VARCHAR AS fiscal_year, 'Q' || quarter(report_period) AS fiscal_period FROM e")
def fin_identity(spark, sf):
    """Later versions carry the filing's year; the stable identity does not follow them."""
    p = V.periods(spark, sf)
    later = p.withColumn("fiscal_year", F.when(F.right("accession", F.lit(1)) != "1", (F.col("fiscal_year").cast("int") + 1).cast("string")).otherwise(F.col("fiscal_year")))
    none = p.select("symbol", "report_period", "fiscal_year").filter("false")
    return financials.stable_identity(later, none).select("symbol", "report_period", "fiscal_year", "fiscal_period").distinct()


@query("SELECT o_orderkey, round(CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_totalprice::DECIMAL(24,4)::DOUBLE / (o_custkey % 7)::DOUBLE END, 6) AS ratio FROM orders")
def fin_safe_ratio(spark, sf):
    return V.table(spark, sf, "orders").select("o_orderkey", F.round(S.safe_ratio("o_totalprice", F.col("o_custkey") % 7).cast("double"), 6).alias("ratio"))


# -- snapshots


@query(
    rf"""WITH {V.PROFILE}, m AS (SELECT exchange, date, day(date) AS d, trade_status, adjust, CASE WHEN day(date) % 2 = 0 THEN lpad(regexp_replace(symbol, '\D', '', 'g'), 6, '0') || '.' || upper(exchange) ELSE symbol END AS symbol FROM profile),
r AS (SELECT * FROM m UNION ALL SELECT * FROM m WHERE d = 14)
SELECT exchange, date, symbol, unnest(list_filter([CASE WHEN d % 2 = 1 THEN 'symbol' END, CASE WHEN d % 2 = 1 THEN 'exchange' END, CASE WHEN d = 14 THEN 'duplicate_symbol' END, CASE WHEN d = 10 THEN 'missing_price' END, CASE WHEN d = 6 THEN 'preclose' END, CASE WHEN d = 2 THEN 'trade_status' END,
  CASE WHEN d = 4 AND trade_status = 1 THEN 'tradable_price' END, CASE WHEN d = 4 THEN 'envelope' END, CASE WHEN d = 8 OR (d = 12 AND trade_status = 1) THEN 'activity' END, CASE WHEN adjust = 'raw' THEN 'adjust' END], lambda x: x IS NOT NULL)) AS rule FROM r"""
)
def snap_violations(spark, sf):
    """Symbols are valid on even days; each rule is broken on a day of the month of its own."""
    p = V.doubles(V.profile(spark, sf))
    d = F.dayofmonth("date")
    on = lambda day, c, value: F.when(d == day, value).otherwise(F.col(c))
    valid = F.concat(F.lpad(F.regexp_replace("symbol", r"\D", ""), 6, "0"), F.lit("."), F.upper("exchange"))
    rows = p.withColumns({
        "symbol": F.when(d % 2 == 0, valid).otherwise(F.col("symbol")), "open": on(10, "open", F.lit(None)), "close": on(4, "close", F.lit(0.0)), "preclose": on(6, "preclose", F.lit(0.0)),
        "volume": on(8, "volume", F.lit(-1.0)), "amount": on(12, "amount", F.lit(None)), "trade_status": on(2, "trade_status", F.lit(2)),
    })
    return snapshot.violations(rows.unionByName(rows.filter(d == 14)))


_TEXT = "'=' || symbol || chr(31) || '=' || trade_status || chr(31) || '=' || is_st || chr(31) || '=' || adjust"


@query(f"WITH {V.PROFILE}, d AS (SELECT exchange, date, count(*) AS rows, sum(('0x' || substr(md5({_TEXT}), 1, 15))::BIGINT::DECIMAL(38,0)) AS s FROM profile GROUP BY 1, 2) SELECT exchange, date, rows, sha256(rows || ':' || s) AS digest FROM d")
def snap_partition_hash(spark, sf):
    return snapshot.partition_digest(V.profile(spark, sf), ["symbol", "trade_status", "is_st", "adjust"])


@query(f"WITH {V.PROFILE}, n AS (SELECT date FROM profile GROUP BY date HAVING count(DISTINCT exchange) = 2) SELECT date FROM n ORDER BY date DESC LIMIT 30")
def snap_latest_dates(spark, sf):
    return snapshot.latest_dates(V.profile(spark, sf), ["sz", "sh"], 30)


# -- search, reference and scalar functions


@query("SELECT 'o_orderstatus' AS field, o_orderstatus AS value, count(*) AS count FROM orders GROUP BY ALL UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL")
def search_value_counts(spark, sf):
    return search.value_counts(V.table(spark, sf, "orders"), ("o_orderstatus", "o_orderpriority"))


@query("SELECT 'us' AS taxonomy, p_type AS tag, p_brand AS unit, count(*) AS count FROM part GROUP BY ALL ORDER BY count DESC, tag, unit LIMIT 12")
def search_top_concepts(spark, sf):
    return search.top_concepts(V.table(spark, sf, "part").select(F.lit("us").alias("taxonomy"), F.col("p_type").alias("tag"), F.col("p_brand").alias("unit")))


@query("WITH i AS (SELECT CASE WHEN c_nationkey < 12 THEN 'us' ELSE 'cn' END AS market, c_mktsegment || c_custkey AS symbol, c_name AS name FROM customer) SELECT * FROM i WHERE symbol LIKE '%MACH%' OR upper(name) LIKE '%MACH%' ORDER BY symbol LIMIT 50")
def search_instruments(spark, sf):
    rows = V.table(spark, sf, "customer").select(F.when(F.col("c_nationkey") < 12, "us").otherwise("cn").alias("market"), F.concat("c_mktsegment", F.col("c_custkey").cast("string")).alias("symbol"), F.col("c_name").alias("name"))
    return search.search(rows, "mach", limit=50)


def _codes(spark, sf) -> DataFrame:
    p = V.table(spark, sf, "part")
    head = F.element_at(F.array(*map(F.lit, ["600", "688", "300", "002", "000", "900", "200", "430"])), (F.col("p_partkey") % 8 + 1).cast("int"))
    return p.select(F.concat(F.when(F.col("p_partkey") % 8 < 2, "sh").when(F.col("p_partkey") % 8 == 7, "bj").when(F.col("p_partkey") % 8 == 5, "sh").otherwise("sz"), F.lit("."), head, F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")).alias("code"), F.col("p_name").alias("code_name"), F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") % 3000).cast("int")), "yyyy-MM-dd").alias("ipoDate"), F.when(F.col("p_partkey") % 5 == 0, "1999-06-30").otherwise("").alias("outDate"))


_CODES = """codes AS (SELECT CASE WHEN p_partkey % 8 IN (0, 1, 5) THEN 'SH' WHEN p_partkey % 8 = 7 THEN 'BJ' ELSE 'SZ' END AS exchange, ['600', '688', '300', '002', '000', '900', '200', '430'][p_partkey % 8 + 1] || lpad((p_partkey % 1000)::VARCHAR, 3, '0') AS code, p_name AS name,
  (DATE '1995-01-01' + (p_partkey % 3000)::INT)::DATE AS listed, CASE WHEN p_partkey % 5 = 0 THEN DATE '1999-06-30' END AS gone FROM part),
boards AS (SELECT *, CASE WHEN exchange = 'BJ' THEN 'beijing' WHEN code LIKE '600%' OR code LIKE '000%' THEN 'main' WHEN code LIKE '688%' THEN 'star' WHEN code LIKE '300%' THEN 'chi_next' WHEN code LIKE '002%' THEN 'sme' ELSE 'b_share' END AS board FROM codes)"""


@query(f"WITH {_CODES} SELECT code || '.' || exchange AS symbol, exchange, board, listed AS listing_date, gone AS delisting_date, CASE WHEN listed > DATE '1999-12-31' THEN 'not_listed' WHEN gone <= DATE '1999-12-31' THEN 'delisted' ELSE 'active' END AS status_as_of, CASE WHEN board IN ('star', 'chi_next') THEN '0.20' ELSE '0.10' END AS base_price_limit_pct, board || CASE WHEN board IN ('star', 'chi_next') THEN '_20pct_base' ELSE '_10pct_base' END AS price_limit_rule FROM boards WHERE board IN ('main', 'star', 'chi_next', 'sme')")
def ref_security_master(spark, sf):
    return reference.security_master(_codes(spark, sf), "1999-12-31", "now", "test").select("symbol", "exchange", "board", "listing_date", "delisting_date", "status_as_of", "base_price_limit_pct", "price_limit_rule")


@query(f"WITH {_CODES} SELECT code || '.' || exchange AS symbol, board, lower(exchange) || '.' || code AS back, board IN ('main', 'star', 'chi_next', 'sme') AS a_share FROM boards")
def scl_symbols(spark, sf):
    symbol = S.from_provider_code("code")
    return _codes(spark, sf).select(symbol.alias("symbol"), S.board(symbol).alias("board"), S.to_provider_code(symbol).alias("back"), S.is_a_share(symbol).alias("a_share"))


@query("SELECT o_orderkey, o_orderdate::DATE AS a, o_orderdate::DATE AS b, o_orderdate::DATE AS c, isodow(o_orderdate) <= 5 AS weekday FROM orders")
def scl_dates(spark, sf):
    o = V.table(spark, sf, "orders")
    return o.select("o_orderkey", S.parse_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("a"), S.parse_date(F.date_format("o_orderdate", "yyyy/M/d")).alias("b"), S.parse_date_prefix(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T10:00:00"))).alias("c"), S.is_weekday("o_orderdate").alias("weekday"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS cleaned, CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_totalprice END AS floated FROM orders")
def scl_numbers(spark, sf):
    text = F.when(F.col("o_orderkey") % 5 == 0, "N/A").otherwise(F.format_number("o_totalprice", 2))
    plain = F.when(F.col("o_orderkey") % 5 == 0, "nan").otherwise(F.col("o_totalprice").cast("string"))
    return V.table(spark, sf, "orders").select("o_orderkey", S.clean_number(text).alias("cleaned"), S.safe_float(plain, 0.0).alias("floated"))
