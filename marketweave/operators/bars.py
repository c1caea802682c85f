"""Bars: roll-ups over sessions, days, weeks and months; valid-bar filters; quotes and moving averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

FREQUENCIES = (5, 15, 30, 60)


def ohlcv(order: Column) -> list[Column]:
    """Aggregates of a bar from finer ones; all combine before the shuffle."""
    return [
        F.min_by("open", order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("amount").alias("amount"),
    ]


def ticks_to_bars(ticks: DataFrame, keys: list[str], order: list[str], price: str = "price", volume: str = "volume", amount: str = "amount") -> DataFrame:
    """Bars of trades: first and last price by the order columns, which must tell rows apart."""
    rank = F.struct(*order)
    return ticks.groupBy(*keys).agg(
        F.min_by(price, rank).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, rank).alias("close"), F.sum(volume).alias("volume"), F.sum(amount).alias("amount")
    )


def session_rollup(minutes: DataFrame, frequencies: tuple[int, ...] = FREQUENCIES) -> DataFrame:
    """1-minute bars (symbol, trade_time, OHLCV) to all frequencies at once; one exchange on (symbol, date, frequency, bucket).

    trade_time is the end of a bar; the 09:30 bar stays a bar of its own.
    """
    day = F.to_date("trade_time")
    rows = minutes.withColumn("trade_date", day).withColumn("minute", S.minute_of_day("trade_time")).withColumn("frequency", F.explode(F.array(*map(F.lit, frequencies))))
    bucketed = rows.withColumn("bucket", S.session_bucket("minute", "frequency"))
    out = bucketed.groupBy("symbol", "trade_date", "frequency", "bucket").agg(*ohlcv(F.col("trade_time")))
    time = (F.col("trade_date").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("bucket"))).alias("trade_time")
    return out.select("symbol", "frequency", time, "open", "high", "low", "close", "volume", "amount")


def daily_rollup(minutes: DataFrame) -> DataFrame:
    return minutes.groupBy("symbol", F.to_date("trade_time").alias("date")).agg(*ohlcv(F.col("trade_time")))


def calendar_rollup(daily: DataFrame, interval: str) -> DataFrame:
    """Daily bars to 5d, 1w or 1mo. The label is the last date in the bucket; amount is the sum of what is known, or null.

    5d counts sessions from the first bar given, so filter dates afterwards. Weeks are ISO weeks of the ISO year.
    """
    if interval == "1d":
        return daily
    if interval == "5d":
        keyed = daily.withColumn("bucket", F.floor((F.row_number().over(Window.partitionBy("symbol").orderBy("date")) - 1) / 5).cast("string"))
    elif interval == "1w":
        keyed = daily.withColumn("bucket", F.concat_ws("-", F.extract(F.lit("YEAROFWEEK"), F.col("date")).cast("string"), F.weekofyear("date").cast("string")))
    elif interval == "1mo":
        keyed = daily.withColumn("bucket", F.trunc("date", "month").cast("string"))
    else:
        raise ValueError(f"unknown interval {interval}")
    return keyed.groupBy("symbol", "bucket").agg(F.max("date").alias("date"), *ohlcv(F.col("date"))).drop("bucket")


def valid_bars(bars: DataFrame, market: str) -> DataFrame:
    """Bars fit for charts: traded (CN: trade_status 1), prices finite and over 0 (US: adjusted ones too); missing volume is 0."""
    columns = ["open", "high", "low", "close"]
    if market == "us":
        columns += [f"adj_{c}" for c in columns]
    good = F.lit(True)
    for c in columns:
        good = good & F.coalesce(S.finite(F.col(c).cast("double")) > 0, F.lit(False))
    if market == "cn":
        good = good & (F.col("trade_status") == 1)
    return bars.filter(good).withColumn("volume", F.coalesce("volume", F.lit(0).cast(bars.schema["volume"].dataType)))


def price_mode(bars: DataFrame, mode: str) -> DataFrame:
    """Raw prices, or adjusted ones under the same names (adj_open ... adj_volume)."""
    if mode not in ("raw", "adjusted"):
        raise ValueError(f"unknown price mode {mode}")
    names = [c for c in ("open", "high", "low", "close", "volume") if f"adj_{c}" in bars.columns]
    rest = [F.col(c) for c in bars.columns if c not in names and c not in [f"adj_{n}" for n in names]]
    return bars.select(*rest, *[F.col(f"adj_{n}" if mode == "adjusted" else n).alias(n) for n in names])


def date_range(bars: DataFrame, start=None, end=None, last: int | None = None) -> DataFrame:
    """Bars from start to end, and of these the last N of each symbol."""
    if start is not None:
        bars = bars.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        bars = bars.filter(F.col("date") <= F.lit(end).cast("date"))
    if last is None:
        return bars
    rank = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("date")))
    return bars.withColumn("_rank", rank).filter(F.col("_rank") <= last).drop("_rank")


def quote(daily: DataFrame, window: int = 252) -> DataFrame:
    """Per symbol: latest and previous close, change, change in per cent, highest high of the last ``window`` bars, drawdown from it."""
    newest = Window.partitionBy("symbol").orderBy(F.desc("date"))
    rows = daily.withColumn("n", F.row_number().over(newest)).filter(F.col("n") <= max(2, window)).groupBy("symbol").agg(
        F.max("date").alias("date"), F.max(F.when(F.col("n") == 1, F.col("close"))).alias("c"), F.max(F.when(F.col("n") == 2, F.col("close"))).alias("p"), F.max(F.when(F.col("n") <= window, F.col("high"))).alias("k"),
    )
    c, p, k = F.col("c"), F.col("p"), F.col("k")
    pct = F.when(p != 0, (c.cast("double") / p.cast("double") - 1) * 100)
    return rows.select("symbol", "date", c.alias("close"), p.alias("previous"), (c - p).alias("change"), F.round(pct, 6).alias("change_pct"), k.alias("peak"), F.round(F.when(k != 0, c.cast("double") / k.cast("double") - 1), 8).alias("drawdown"))


def minute_quote(minutes: DataFrame) -> DataFrame:
    """Per symbol: latest and previous close, peak over all bars given, and how many have no volume."""
    order = F.col("trade_time")
    last = Window.partitionBy("symbol").orderBy("trade_time")
    rows = minutes.withColumn("previous", F.lag("close").over(last))
    return rows.groupBy("symbol").agg(F.max("trade_time").alias("trade_time"), F.max_by("close", order).alias("close"), F.max_by("previous", order).alias("previous"), F.max("high").alias("peak"), F.count_if(F.col("volume") == 0).alias("zero_volume_rows"), F.count("*").alias("rows"))


def moving_averages(daily: DataFrame, windows: tuple[int, ...] = (5, 10, 20), column: str = "close") -> DataFrame:
    """ma5, ma10, ma20 of the close; null until a window is full."""
    out = daily
    for n in windows:
        w = Window.partitionBy("symbol").orderBy("date").rowsBetween(1 - n, 0)
        out = out.withColumn(f"ma{n}", F.when(F.count(column).over(w) == n, F.avg(column).over(w)))
    return out


def symbol_bars(profile: DataFrame, symbol: str, start=None, end=None, interval: str = "1d", mode: str = "raw", market: str = "cn", last: int | None = None) -> DataFrame:
    """The chart read of one symbol: valid bars, price mode, roll-up over the whole history, then the date range."""
    rows = price_mode(valid_bars(profile.filter(F.col("symbol") == symbol), market), mode)
    return date_range(calendar_rollup(rows, interval), start, end, last)


def market_summary(profile: DataFrame) -> DataFrame:
    """Per exchange and day: rows, traded, amount (bad numbers are 0) and special-treatment count."""
    amount = F.coalesce(S.finite(F.col("amount").cast("double")), F.lit(0.0)).cast("decimal(28,4)")
    return profile.groupBy("exchange", "date").agg(F.count("*").alias("rows"), F.count_if(F.col("trade_status") == 1).alias("traded"), F.sum(amount).alias("amount"), F.count_if(F.col("is_st") == 1).alias("st_count"))
