"""Minute bars: normalising, repair with audit, exclusions, validation and the build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..settled import settle
from . import bars
from .findings import Check, run_checks

COLUMNS = ["symbol", "trade_time", "open", "high", "low", "close", "volume", "amount"]
PRICES = ("open", "high", "low", "close")
# Lows checked against the vendor's 5-minute bars (Asia/Shanghai wall time).
LOW_CORRECTIONS = [
    ("601005.SH", "2011-04-26 10:31:00", 4.87),
    ("600356.SH", "2011-12-12 09:32:00", 7.07),
    ("600358.SH", "2011-12-12 09:33:00", 4.64),
    ("600367.SH", "2011-12-12 09:34:00", 15.90),
    ("600579.SH", "2011-12-12 10:31:00", 5.62),
    ("600377.SH", "2011-12-12 09:35:00", 5.82),
    ("600511.SH", "2011-12-12 09:34:00", 14.04),
    ("600897.SH", "2011-12-12 09:32:00", 13.55),
    ("600988.SH", "2011-12-12 09:34:00", 9.35),
    ("600337.SH", "2011-12-12 09:32:00", 9.16),
    ("600689.SH", "2011-12-15 09:32:00", 8.01),
    ("600228.SH", "2011-12-21 10:31:00", 8.21),
]


def low_registry(spark: SparkSession) -> DataFrame:
    """symbol, trade_time (session time zone: run with Asia/Shanghai), corrected_low."""
    return spark.createDataFrame(LOW_CORRECTIONS, "symbol string, t string, corrected_low double").select("symbol", F.to_timestamp("t").alias("trade_time"), "corrected_low")


def normalize(vendor: DataFrame, symbol: Column | str, frequency: Column | int) -> DataFrame:
    """Vendor columns to the canonical ones, with ``reject`` telling what is wrong with a row (null: nothing).

    ``symbol`` and ``frequency`` are what the archive member claims to hold.
    """
    want = F.upper(symbol if isinstance(symbol, Column) else F.lit(symbol))
    freq = frequency if isinstance(frequency, Column) else F.lit(frequency)
    number = lambda c: F.col(c).try_cast("double")
    reject = (
        F.when(~F.col("ts_code").eqNullSafe(want), "symbol_mismatch")
        .when(~F.col("freq").eqNullSafe(F.concat(freq.cast("string"), F.lit("min"))), "frequency_tag_mismatch")
        .when(F.col("trade_time").isNull(), "missing_time")
        .when(F.array_contains(F.array(*[F.coalesce(S.finite(number(c)).isNull(), F.lit(True)) for c in (*PRICES, "amount")]), True) | F.col("vol").try_cast("long").isNull(), "bad_number")
    )
    return vendor.select(F.col("ts_code").alias("symbol"), "trade_time", *[number(c).alias(c) for c in PRICES], F.col("vol").try_cast("long").alias("volume"), number("amount").alias("amount"), reject.alias("reject"))


def repair(minutes: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Bars with repaired lows and highs and ``corrections``, an array of what was changed, in order.

    In this order: the registered low of a bar whose low is 0; a low of 0 under sound prices becomes the lesser of open
    and close; then, where all prices are over 0: a low above them, a high below them, and a high over twice the greater
    one become the lesser or greater of open and close. ``conflict`` is true where a registered bar's low is not 0.
    """
    given = [c for c in minutes.columns if c not in ("corrections", "conflict")]
    rows = minutes if registry is None else minutes.join(F.broadcast(registry), ["symbol", "trade_time"], "left")
    registered = F.lit(None).cast("double") if registry is None else F.col("corrected_low")
    lesser, greater = F.least("open", "close"), F.greatest("open", "close")
    low, high = F.col("low"), F.col("high")
    kind = "struct<field:string,original_value:double,corrected_value:double,evidence:string,inferred:boolean>"

    def change(when: Column, field: str, old: Column, new: Column, evidence: str, inferred: bool) -> Column:
        return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(field).alias("field"), old.cast("double").alias("original_value"), new.cast("double").alias("corrected_value"), F.lit(evidence).alias("evidence"), F.lit(inferred).alias("inferred")).cast(kind))

    a = registered.isNotNull() & (low == 0)
    rows = rows.withColumn("_a", change(a, "low", low, registered, "vendor_5m_ohlc_crosscheck", False)).withColumn("_low1", F.coalesce("_a.corrected_value", low))
    low1 = F.col("_low1")
    b = (low1 == 0) & (F.col("open") > 0) & (high > 0) & (F.col("close") > 0) & (high >= greater)
    rows = rows.withColumn("_b", change(b, "low", low1, lesser, "structural_ohlc_lower_bound", True)).withColumn("_low2", F.coalesce("_b.corrected_value", low1))
    low2 = F.col("_low2")
    positive = (F.col("open") > 0) & (high > 0) & (low2 > 0) & (F.col("close") > 0)
    rows = rows.withColumn("_c", change(positive & (low2 > lesser), "low", low2, lesser, "structural_ohlc_envelope", True)).withColumn("_d", change(positive & (high < greater), "high", high, greater, "structural_ohlc_envelope", True)).withColumn("_high1", F.coalesce("_d.corrected_value", high))
    high1 = F.col("_high1")
    rows = rows.withColumn("_e", change(positive & (high1 > greater * 2), "high", high1, greater, "extreme_intraminute_spike_guard", True))
    conflict = F.coalesce(registered.isNotNull() & (low != 0), F.lit(False))
    fixed = {"low": F.coalesce("_c.corrected_value", low2), "high": F.coalesce("_e.corrected_value", high1)}
    return rows.select(*[fixed[c].cast(minutes.schema[c].dataType).alias(c) if c in fixed else F.col(c) for c in given], F.array_compact(F.array("_a", "_b", "_c", "_d", "_e")).alias("corrections"), conflict.alias("conflict"))


def audit(repaired: DataFrame) -> DataFrame:
    """One row per correction."""
    return repaired.select("symbol", "trade_time", F.inline("corrections"))


def split_zero_days(minutes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars without the days of a symbol on which every price, volume and amount is 0; and per symbol the days and rows left out."""
    zero = F.lit(True)
    for c in (*PRICES, "volume", "amount"):
        zero = zero & (F.col(c) == 0)
    day = F.to_date("trade_time").alias("date")
    days = minutes.groupBy("symbol", day).agg(F.bool_and(F.coalesce(zero, F.lit(False))).alias("zero"), F.count("*").alias("rows")).filter("zero").select("symbol", "date", "rows")
    kept = minutes.withColumn("_date", F.to_date("trade_time")).join(days.select("symbol", F.col("date").alias("_date")), ["symbol", "_date"], "left_anti").select(*minutes.columns)
    excluded = days.groupBy("symbol").agg(F.sort_array(F.collect_set("date")).alias("dates"), F.sum("rows").alias("rows"))
    return kept, excluded


def post_close_adjustments(minutes: DataFrame) -> DataFrame:
    """BJ bars of 15:01 to 15:30 with negative volume or amount: kept, and shown here."""
    return minutes.filter(_post_close() & ((F.col("volume") < 0) | (F.col("amount") < 0)))


def _post_close() -> Column:
    return F.col("symbol").endswith(".BJ") & S.minute_of_day("trade_time").between(901, 930)


def bad_ohlc(positive: bool = True) -> Column:
    bad = (F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close")) | (F.col("low") > F.col("high"))
    return bad | (F.least(*PRICES) <= 0) if positive else bad


def _any_null(columns: list[str]) -> Column:
    return F.array_contains(F.array(*[F.col(c).isNull() for c in columns]), True)


def canonical_checks(frequency: int | Column, positive: bool = True) -> list[Check]:
    """Predicates of a canonical bar, whose prices are over 0 unless ``positive`` is false; ``_copies`` counts the rows of its key."""
    exchange = F.substring_index("symbol", ".", -1)
    key = F.concat_ws(" ", "symbol", F.col("trade_time").cast("string"))
    off = ~S.on_grid(S.minute_of_day("trade_time"), frequency, exchange) | (F.second("trade_time") != 0)
    return [
        Check("null_value", _any_null(COLUMNS), example=key),
        Check("duplicate_key", F.col("_copies") > 1, example=key),
        Check("invalid_ohlc", bad_ohlc(positive), example=key),
        Check("negative_activity", ((F.col("volume") < 0) | (F.col("amount") < 0)) & ~_post_close(), example=key),
        Check("invalid_timestamp", off, example=key),
    ]


def _with_copies(minutes: DataFrame, keys: list[str]) -> DataFrame:
    """With the rows of each key as ``_copies``. Keys are counted before the shuffle's sort; only the few that repeat are joined back."""
    again = minutes.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("_copies")).filter("_copies > 1")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return minutes.join(again, same, "left").withColumn("_copies", F.coalesce("_copies", F.lit(1))).drop(*[f"_{k}" for k in keys])


def validate(minutes: DataFrame, frequency: int = 1, scope: list[str] | None = None) -> DataFrame:
    """Findings of canonical bars of one frequency, by symbol unless another scope is given."""
    return run_checks(_with_copies(minutes, ["symbol", "trade_time"]), canonical_checks(frequency), scope or ["symbol"])


def build(minutes: DataFrame, registry: DataFrame | None = None, accepted: Sequence[str] = ()) -> dict[str, DataFrame]:
    """From canonical 1-minute bars of many symbols: repaired bars with all roll-ups, and the evidence.

    bars: frequency, exchange, trade_date and the canonical columns; unresolved: symbols with findings or registry
    conflicts, which are in no other table; corrections and exclusions: the audits of the others. Findings of the checks
    named in ``accepted`` leave no symbol out.
    """
    repaired = settle(repair(minutes, registry), "repaired")  # all four tables read it
    kept, excluded = split_zero_days(repaired)
    kept = settle(kept, "kept")
    wrong = validate(kept).filter(~F.col("check").isin(*accepted)).select(F.col("scope").alias("symbol"), F.col("check").alias("reason")).unionByName(repaired.filter("conflict").select("symbol", F.lit("correction_conflict").alias("reason"))).distinct()
    unresolved = settle(wrong.groupBy("symbol").agg(F.sort_array(F.collect_set("reason")).alias("reasons")), "unresolved")
    good = kept.join(unresolved, "symbol", "left_anti").select(*COLUMNS)
    one = good.withColumn("frequency", F.lit(1))
    out = one.unionByName(bars.session_rollup(good)).withColumn("exchange", F.lower(F.substring_index("symbol", ".", -1))).withColumn("trade_date", F.to_date("trade_time"))
    return {"bars": out, "unresolved": unresolved, "corrections": audit(repaired.join(unresolved, "symbol", "left_anti")), "exclusions": excluded.join(unresolved, "symbol", "left_anti")}


def build_statistics(built: DataFrame) -> DataFrame:
    """Per frequency: partitions, rows, first and last date."""
    return built.groupBy("frequency").agg(F.countDistinct("exchange", "trade_date").alias("partitions"), F.count("*").alias("rows"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))


def pending_years(requested: DataFrame, validated: DataFrame, build_id: str) -> DataFrame:
    """Years asked for that no clean validation of this build has; validated: year, build_id, errors."""
    done = validated.filter((F.col("build_id") == build_id) & (F.col("errors") == 0)).select("year")
    return requested.select("year").distinct().join(done, "year", "left_anti")


def incomplete_sessions(minutes: DataFrame, frequency: int = 1, short_bj: bool = True) -> DataFrame:
    """Symbol and day with another number of bars than the grid has; production bars of BJ may also lack the post-close session."""
    counts = minutes.groupBy("symbol", F.to_date("trade_time").alias("date")).agg(F.count("*").alias("bars"))
    exchange = F.substring_index("symbol", ".", -1)
    want = S.bars_per_day(F.lit(frequency), exchange)
    fits = F.col("bars") == want
    if short_bj:
        fits = fits | ((F.upper(exchange) == "BJ") & (F.col("bars") == S.bars_per_day(F.lit(frequency), F.lit(""))))
    return counts.withColumn("expected", want).filter(~fits)


def partition_differences(built: DataFrame, base: int = 1) -> DataFrame:
    """Per derived frequency: (exchange, date) partitions missing against the base frequency, and extra ones."""
    parts = built.select("frequency", "exchange", "trade_date").distinct()
    have = parts.filter(F.col("frequency") == base).select("exchange", "trade_date", F.lit(True).alias("in_base"))
    others = parts.filter(F.col("frequency") != base)
    wanted = have.withColumn("frequency", F.explode(F.array(*map(F.lit, bars.FREQUENCIES))))
    both = wanted.join(others.withColumn("in_derived", F.lit(True)), ["frequency", "exchange", "trade_date"], "full_outer")
    return both.groupBy("frequency").agg(F.count_if(F.col("in_derived").isNull()).alias("missing"), F.count_if(F.col("in_base").isNull()).alias("extra"))


def raw_checks(frequency: int | Column) -> list[Check]:
    """Row checks of raw vendor frames (ts_code, freq, trade_time, prices, vol, amount; ``member`` is the archive member's symbol); ``duplicate_timestamp`` is counted by key, apart from these."""
    exchange = F.substring_index("member", ".", -1)
    minute = S.minute_of_day("trade_time")
    late = (F.upper(exchange) == "BJ") & minute.between(901, 930)
    v, a = F.col("vol") < 0, F.col("amount") < 0
    key = F.col("trade_time").cast("string")
    return [
        Check("null_row", _any_null(["ts_code", "freq", "trade_time", *PRICES, "vol", "amount"])),
        Check("symbol_mismatch", F.col("ts_code") != F.col("member")),
        Check("frequency_tag_mismatch", F.col("freq") != F.concat(F.lit(frequency).cast("string"), F.lit("min"))),
        Check("invalid_ohlc", bad_ohlc(positive=False), example=key),
        Check("nonpositive_price", F.least(*PRICES) <= 0, example=key),
        Check("negative_volume", v & ~late, example=key),
        Check("negative_amount", a & ~late, example=key),
        Check("post_close_negative_adjustment", (v | a) & late, "warning", example=key),
        Check("invalid_session_timestamp", ~S.on_grid(minute, frequency, exchange) | (F.second("trade_time") != 0), example=key),
    ]


def raw_findings(frames: DataFrame, frequency: int) -> DataFrame:
    """All checks of raw frames by member: row checks, bars per day, days without volume."""
    rows = run_checks(frames, raw_checks(frequency), ["member"])
    keys = frames.groupBy("member", "trade_time").agg(F.count("*").alias("n"))
    again = keys.groupBy("member").agg(F.sum(F.col("n") - 1).alias("count"), F.sum("n").alias("total"), F.min(F.when(F.col("n") > 1, F.col("trade_time"))).cast("string").alias("example")).filter("count > 0")
    text = F.concat(F.col("count").cast("string"), F.lit(" of "), F.col("total").cast("string"))
    rows = rows.unionByName(again.select(F.lit("error").alias("severity"), F.lit("duplicate_timestamp").alias("check"), F.col("member").alias("scope"), "count", "total", F.lit(None).cast("double").alias("max_abs_diff"), "example", text.alias("detail")))
    days = frames.groupBy("member", F.to_date("trade_time").alias("date")).agg(F.count("*").alias("bars"), F.sum("vol").alias("vol"))
    want = S.bars_per_day(F.lit(frequency), F.substring_index("member", ".", -1))
    by_day = [Check("unexpected_bars_per_day", F.col("bars") != want, example=F.concat_ws(":", F.col("date").cast("string"), F.col("bars").cast("string"))), Check("zero_volume_day", F.col("vol") == 0, "info", example=F.col("date"))]
    whole = days.groupBy("member").agg(F.bool_and(F.col("vol") == 0).alias("all_zero"))
    return rows.unionByName(run_checks(days, by_day, ["member"])).unionByName(run_checks(whole, [Check("all_year_zero_volume_grid", F.col("all_zero"), "warning")], ["member"]))


def year_audit(partitions: DataFrame, first: int, last: int) -> DataFrame:
    """Years from first to last with their partitions and whether any is there; partitions: trade_date, exchange."""
    years = partitions.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    have = partitions.groupBy(F.year("trade_date").alias("year")).agg(F.countDistinct("exchange", "trade_date").alias("partitions"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))
    return years.join(have, "year", "left").withColumn("missing", F.col("partitions").isNull()).withColumn("partitions", F.coalesce("partitions", F.lit(0).cast("long")))
