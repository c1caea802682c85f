"""Minute bars of a stream of trades.

The batch roll-ups need no order of arrival, so a stream needs only an event-time window and a watermark; late trades
beyond it are dropped by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def minute_bars(ticks: DataFrame, lateness: str = "5 minutes") -> DataFrame:
    """ticks: symbol, ts, seq, price, volume, amount. Bars labelled by the end of their minute; works on batch frames too."""
    order = F.struct("ts", "seq")
    rows = ticks.withWatermark("ts", lateness).groupBy("symbol", F.window("ts", "1 minute").alias("w"))
    return rows.agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("volume").alias("volume"), F.sum("amount").alias("amount")).select(
        "symbol", F.col("w.end").alias("trade_time"), "open", "high", "low", "close", "volume", "amount"
    )
