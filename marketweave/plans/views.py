"""Market-shaped views over the driver's tables, and the same as SQL text for its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which results are compared."""
    return df.select(*[F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n) for n, t in df.dtypes])


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as trades: symbol, ts, seq, price, volume, amount."""
    price, volume = F.col("value").cast("decimal(18,2)"), (F.col("user_id") % 100 + 1).cast("long")
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), "ts", F.col("event_id").alias("seq"), price.alias("price"), volume.alias("volume"), (price * volume).cast("decimal(24,2)").alias("amount"))


TICKS = "ticks AS (SELECT event_type AS symbol, ts, event_id AS seq, value::DECIMAL(18,2) AS price, user_id % 100 + 1 AS volume, (value::DECIMAL(18,2) * (user_id % 100 + 1))::DECIMAL(24,2) AS amount FROM events)"


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-minute bars of the trades within the sessions, labelled by the minute's end."""
    end = F.date_trunc("minute", "ts") + F.expr("interval 1 minute")
    rows = ticks(spark, sf_dir).withColumn("trade_time", end)
    m = F.hour("trade_time") * 60 + F.minute("trade_time")
    return bars.ticks_to_bars(rows.filter(m.between(570, 900) & ~m.between(691, 780)), ["symbol", "trade_time"], ["ts", "seq"])


MINUTES = TICKS + """, timed AS (SELECT *, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS trade_time FROM ticks),
inside AS (SELECT *, extract(hour FROM trade_time) * 60 + extract(minute FROM trade_time) AS m FROM timed),
minutes AS (SELECT symbol, trade_time, arg_min(price, (ts, seq)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, seq)) AS close, sum(volume) AS volume, sum(amount) AS amount
  FROM inside WHERE m BETWEEN 570 AND 900 AND NOT m BETWEEN 691 AND 780 GROUP BY symbol, trade_time)"""


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as trades of returnflag||linestatus by ship date."""
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 10000).cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(5,4)")
    return table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("symbol"), "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("date"), price.cast("decimal(18,4)").alias("price"),
        F.col("l_quantity").cast("decimal(18,2)").alias("volume"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"), "l_orderkey", "l_linenumber",
    )


ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "volume", "amount"]
TRADES = """trades AS (SELECT l_returnflag || l_linestatus AS symbol, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate::DATE AS date,
  (floor(l_extendedprice / l_quantity * 10000)::BIGINT::DECIMAL(18,0) * 0.0001::DECIMAL(5,4))::DECIMAL(18,4) AS price, l_quantity::DECIMAL(18,2) AS volume, l_extendedprice::DECIMAL(18,2) AS amount, l_orderkey, l_linenumber FROM lineitem)"""
_OHLCV = "arg_min(price, (l_orderkey, l_linenumber, l_partkey, l_suppkey, volume, amount)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (l_orderkey, l_linenumber, l_partkey, l_suppkey, volume, amount)) AS close, sum(volume) AS volume, sum(amount) AS amount"


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.ticks_to_bars(trades(spark, sf_dir), ["symbol", "date"], ORDER)


DAILY = f"{TRADES}, daily AS (SELECT symbol, date, {_OHLCV} FROM trades GROUP BY symbol, date)"


def branded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of brands, listed at sz (size up to 25) or sh."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"), F.when(F.col("p_size") <= 25, "sz").otherwise("sh").alias("exchange"))
    return trades(spark, sf_dir).join(part, "l_partkey").withColumn("symbol", F.col("brand"))


BRANDED = f"{TRADES}, branded AS (SELECT t.* EXCLUDE (symbol), p_brand AS symbol, CASE WHEN p_size <= 25 THEN 'sz' ELSE 'sh' END AS exchange FROM trades t JOIN part ON p_partkey = l_partkey)"


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily cross-sections of brands: exchange, date, symbol, prices, preclose, volume, amount, trade_status, is_st, adjust."""
    rows = branded(spark, sf_dir)
    keys = ["exchange", "date", "symbol"]
    rank = F.struct(*ORDER)
    out = rows.groupBy(*keys).agg(
        F.min_by("price", rank).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", rank).alias("close"), F.sum("volume").alias("volume"), F.sum("amount").alias("amount"),
        F.max(F.when(F.col("l_returnflag") == "N", 0).otherwise(1)).alias("trade_status"), F.max(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("is_st"),
    )
    return out.withColumn("preclose", F.col("open")).withColumn("adjust", F.when(F.col("volume") > 40, "raw").otherwise("qfq"))


PROFILE = f"""{BRANDED}, profile0 AS (SELECT exchange, date, symbol, {_OHLCV}, max(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END) AS trade_status, max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS is_st
  FROM branded GROUP BY exchange, date, symbol), profile AS (SELECT *, open AS preclose, CASE WHEN volume > 40 THEN 'raw' ELSE 'qfq' END AS adjust FROM profile0)"""


def us_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars as US assets: a split of 2 in the first days of even years, a dividend on each 15th."""
    d = doubles(daily(spark, sf_dir))
    split = F.when((F.dayofyear("date") <= 3) & (F.year("date") % 2 == 0), 2.0).otherwise(1.0)
    dividend = F.when(F.dayofmonth("date") == 15, 0.5).otherwise(0.0)
    return d.select(F.lit("stock").alias("asset_type"), "symbol", "date", "open", "high", "low", "close", "volume", *[(F.col(c) / 2).alias(f"adj_{c}") for c in ("open", "high", "low", "close", "volume")], dividend.alias("dividend"), split.alias("split_factor"))


US_BARS = f"""{DAILY}, us_bars AS (SELECT 'stock' AS asset_type, symbol, date, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close, volume::DOUBLE AS volume,
  open::DOUBLE / 2 AS adj_open, high::DOUBLE / 2 AS adj_high, low::DOUBLE / 2 AS adj_low, close::DOUBLE / 2 AS adj_close, volume::DOUBLE / 2 AS adj_volume,
  CASE WHEN day(date) = 15 THEN 0.5 ELSE 0.0 END::DOUBLE AS dividend, CASE WHEN dayofyear(date) <= 3 AND year(date) % 2 = 0 THEN 2.0 ELSE 1.0 END::DOUBLE AS split_factor FROM daily)"""


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly versions of a revenue per nation: five per period, by order priority."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    p = F.substring("o_orderpriority", 1, 1).cast("int")
    end = F.last_day(F.add_months(F.trunc("o_orderdate", "quarter"), 2))
    out = rows.groupBy(F.col("n_name").alias("symbol"), end.alias("report_period"), p.alias("version")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value"))
    available = F.date_add("report_period", 30 + 10 * F.col("version"))
    return out.select("symbol", F.lit("quarterly").alias("period_type"), "report_period", F.concat(F.lit("Q"), F.quarter("report_period").cast("string")).alias("fiscal_period"), F.year("report_period").cast("string").alias("fiscal_year"), available.alias("available_date"), F.date_format(available, "yyyy-MM-dd").alias("accepted_at"), F.concat_ws("-", "symbol", F.date_format("report_period", "yyyyMMdd"), F.col("version").cast("string")).alias("accession"), F.lit("10-Q").alias("form"), "value")


PERIODS = """periods AS (SELECT symbol, 'quarterly' AS period_type, report_period, 'Q' || quarter(report_period) AS fiscal_period, year(report_period)::VARCHAR AS fiscal_year,
  (report_period + (30 + 10 * version)::INTEGER)::DATE AS available_date, strftime(report_period + (30 + 10 * version)::INTEGER, '%Y-%m-%d') AS accepted_at, symbol || '-' || strftime(report_period, '%Y%m%d') || '-' || version AS accession, '10-Q' AS form, value
  FROM (SELECT n_name AS symbol, last_day((date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH)::DATE) AS report_period, substr(o_orderpriority, 1, 1)::INTEGER AS version, sum(o_totalprice::DECIMAL(18,2)) AS value
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3))"""
