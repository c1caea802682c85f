"""Split-adjusted closes and drawdowns of daily bars (asset_type, symbol, date, close, adj_close, split_factor)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ASSET = ["asset_type", "symbol"]


def split_adjusted(bars: DataFrame) -> DataFrame:
    """split_close: the close over the product of all later split factors of the asset."""
    # newest first, so that the frame only grows and the product is a running one
    later = Window.partitionBy(*ASSET).orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, -1)
    factor = F.coalesce(F.product(F.col("split_factor").cast("double")).over(later), F.lit(1.0))
    return bars.withColumn("split_close", F.col("close").cast("double") / factor)


def drawdowns(bars: DataFrame) -> DataFrame:
    """Per asset its latest state: all-time high of the split-adjusted close (latest date on ties), sessions since, drawdowns from it and from the highest close of 252 and 756 sessions, and from the highest adjusted close."""
    rows = split_adjusted(bars).withColumn("n", F.row_number().over(Window.partitionBy(*ASSET).orderBy(F.desc("date"))))
    last = lambda n: F.max(F.when(F.col("n") <= n, F.col("split_close")))
    best = rows.groupBy(*ASSET).agg(
        F.max_by(F.struct("date", "split_close", "adj_close"), "date").alias("now"),
        F.max_by(F.struct("date", "split_close", "n"), F.struct("split_close", "date")).alias("top"),
        F.max(F.col("adj_close").cast("double")).alias("top_adj"),
        last(252).alias("high_252"), last(756).alias("high_756"),
    )
    fall = lambda peak: F.round(F.col("now.split_close") / peak - 1, 8)
    return best.select(
        *ASSET,
        F.col("now.date").alias("date"),
        F.col("now.split_close").alias("close"),
        F.col("top.split_close").alias("ath"),
        F.col("top.date").alias("ath_date"),
        (F.col("top.n") - 1).alias("sessions_since_ath"),
        fall(F.col("top.split_close")).alias("drawdown"),
        fall(F.col("high_252")).alias("drawdown_252"),
        fall(F.col("high_756")).alias("drawdown_756"),
        F.round(F.col("now.adj_close").cast("double") / F.col("top_adj") - 1, 8).alias("total_return_drawdown"),
    )
