"""Comparisons and health checks of daily and minute data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .findings import Check, file_order, run_checks

PRICES = ("open", "high", "low", "close")


def _beside_reference(profile: DataFrame, reference: DataFrame, tolerance: float) -> DataFrame:
    """All profile rows with the reference's prices, if there, and ``status``: ok, mismatch, or null without a reference."""
    number = lambda c: S.safe_float(c, 0.0)
    left = profile.select("date", "exchange", F.upper("symbol").alias("symbol"), *[number(c).alias(f"profile_{c}") for c in PRICES])
    right = reference.select("date", "exchange", F.upper("symbol").alias("symbol"), F.col("source"), *[number(c).alias(f"source_{c}") for c in PRICES], F.lit(True).alias("_there"))
    joined = left.join(right, ["date", "exchange", "symbol"], "left")
    diffs = [(F.col(f"profile_{c}") - F.col(f"source_{c}")).alias(f"{c}_diff") for c in PRICES]
    worst = F.greatest(*[F.abs(F.col(f"{c}_diff")) for c in PRICES])
    return joined.select("*", *diffs).withColumn("status", F.when(F.col("_there"), F.when(worst <= tolerance, "ok").otherwise("mismatch"))).drop("_there")


def ohlc_check(profile: DataFrame, reference: DataFrame, tolerance: float = 0.0001) -> DataFrame:
    """Profile against reference by (date, exchange, upper-case symbol): both sides' prices, differences and status. Rows without a reference have no output row."""
    return _beside_reference(profile, reference, tolerance).filter("status is not null")


def ohlc_check_summary(profile: DataFrame, reference: DataFrame, tolerance: float = 0.0001) -> DataFrame:
    """One row: checked, mismatched and missing_reference; one join and one aggregation."""
    status = _beside_reference(profile, reference, tolerance).select("status")
    return status.agg(F.count("status").alias("checked"), F.count_if(F.col("status") == "mismatch").alias("mismatched"), F.count_if(F.col("status").isNull()).alias("missing_reference"))


def outer_compare(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], tolerances: dict[str, Column] | None = None) -> DataFrame:
    """One row per field: matched rows, mismatches beyond the tolerance of the left value, greatest difference over all matched rows, least offending key; and keys missing on the right and extra there."""
    tolerances = tolerances or {}
    a = left.select(*keys, *[F.col(f).cast("double").alias(f"l_{f}") for f in fields], F.lit(True).alias("in_l"))
    b = right.select(*keys, *[F.col(f).cast("double").alias(f"r_{f}") for f in fields], F.lit(True).alias("in_r"))
    joined = a.join(b, keys, "full_outer")
    both = F.col("in_l") & F.col("in_r")
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    aggregates = [F.count_if(both).alias("matched"), F.count_if(F.col("in_r").isNull()).alias("missing_target"), F.count_if(F.col("in_l").isNull()).alias("extra_target")]
    for f in fields:
        d = F.abs(F.col(f"l_{f}") - F.col(f"r_{f}"))
        bad = both & (d > tolerances.get(f, S.tolerance(f, F.col(f"l_{f}"))))
        aggregates += [F.count_if(bad).alias(f"n_{f}"), F.max(F.when(both, d)).alias(f"d_{f}"), F.min(F.when(bad, key)).alias(f"e_{f}")]
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").alias("mismatches"), F.coalesce(F.col(f"d_{f}"), F.lit(0.0)).alias("max_abs_diff"), F.col(f"e_{f}").alias("example")) for f in fields])
    return joined.agg(*aggregates).select("matched", "missing_target", "extra_target", F.inline(rows))


def derived_compare(expected: DataFrame, actual: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Stored derived bars against recomputed ones. Volume must be equal, others within 1e-9 + 1e-12 of the stored value; the greatest difference is over mismatched rows."""
    a = expected.select(*keys, *[F.col(f).cast("double").alias(f"l_{f}") for f in fields], F.lit(True).alias("in_l"))
    b = actual.select(*keys, *[F.col(f).cast("double").alias(f"r_{f}") for f in fields], F.lit(True).alias("in_r"))
    both = F.col("in_l") & F.col("in_r")
    checks = [Check("missing_key", F.col("in_r").isNull()), Check("extra_key", F.col("in_l").isNull())]
    for f in fields:
        d = F.abs(F.col(f"l_{f}") - F.col(f"r_{f}"))
        allowed = F.lit(0.0) if f == "volume" else F.lit(1e-9) + F.lit(1e-12) * F.abs(F.col(f"r_{f}"))
        checks.append(Check(f"{f}_mismatch", both & (d > allowed), diff=d))
    return run_checks(a.join(b, keys, "full_outer"), checks)


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def partition_health(profile: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Per (exchange, date): rows, duplicate symbols (rows beyond the first of each), rows whose prices are not all over 0; and missing columns."""
    bad = F.lit(False)
    for c in PRICES:
        bad = bad | ~F.coalesce(S.safe_float(c) > 0, F.lit(False))
    per_symbol = profile.groupBy("exchange", "date", "symbol").agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"))
    missing = sorted(set(required or []) - set(profile.columns))
    return per_symbol.groupBy("exchange", "date").agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicates"), F.sum("bad").alias("nonpositive_rows")).withColumn("missing_columns", F.array(*map(F.lit, missing)).cast("array<string>"))


def row_floor(health: DataFrame, ratio: float = 0.85, least: int = 80) -> DataFrame:
    """``row_floor``: greatest of ``least`` and the whole part of the exact median rows of the exchange's partitions times ratio; ``low_rows`` if under it."""
    median = health.groupBy("exchange").agg(F.median("rows").alias("median_rows"))
    floor = F.greatest(F.lit(least).cast("long"), F.floor(F.col("median_rows") * F.lit(ratio)))
    return health.join(median, "exchange").withColumn("row_floor", floor).withColumn("low_rows", F.col("rows") < F.col("row_floor"))


def profile_health(profile: DataFrame, exchanges: list[str], dates: DataFrame, evidence: DataFrame | None = None, required: list[str] | None = None, expected=None, ratio: float = 0.85, least: int = 80) -> DataFrame:
    """Every (exchange, date) of the grid with ``issues``: missing, missing_columns, low_rows, duplicate_symbols, nonpositive_ohlc, fetch_failures, evidence_incomplete, stale.

    dates: one column date. evidence: exchange, date, status, failed. expected: the date that the latest partition must reach.
    """
    grid = dates.select("date").distinct().withColumn("exchange", F.explode(F.array(*map(F.lit, exchanges))))
    health = row_floor(partition_health(profile, required), ratio, least)
    rows = grid.join(health, ["exchange", "date"], "left")
    if evidence is not None:
        rows = rows.join(evidence.select("exchange", "date", F.col("status").alias("run_status"), F.col("failed").alias("run_failed")), ["exchange", "date"], "left")
    else:
        rows = rows.withColumn("run_status", F.lit("completed")).withColumn("run_failed", F.lit(0))
    there = F.col("rows").isNotNull()
    latest = F.max(F.when(there, F.col("date"))).over(Window.partitionBy("exchange"))
    stale = F.lit(False) if expected is None else F.coalesce(latest < F.lit(expected).cast("date"), F.lit(True))
    issue = lambda when, name: F.when(F.coalesce(when, F.lit(False)), F.lit(name))
    issues = F.array_compact(F.array(issue(~there, "missing"), issue(F.size("missing_columns") > 0, "missing_columns"), issue(F.col("low_rows"), "low_rows"), issue(F.col("duplicates") > 0, "duplicate_symbols"), issue(F.col("nonpositive_rows") > 0, "nonpositive_ohlc"), issue(F.col("run_failed") > 0, "fetch_failures"), issue(there & ~F.col("run_status").eqNullSafe("completed"), "evidence_incomplete"), issue(stale, "stale")))
    return rows.withColumn("issues", issues).select("exchange", "date", "rows", "duplicates", "nonpositive_rows", "row_floor", "issues")


def order_violations(rows: DataFrame, key: list[str], place: str, order: str) -> DataFrame:
    """Rows of an incoming file whose ``order`` value is not over that of the row before; ``place`` is the row's position."""
    before = F.lag(order).over(Window.partitionBy(*key).orderBy(place))
    return rows.withColumn("_before", before).filter(F.col(order) <= F.col("_before")).drop("_before")


def us_daily_findings(bars: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Checks of US bars by asset: identity, dates, finite and consistent raw and adjusted prices, volumes, actions.

    With a ``source`` column, rows without one; with ``place`` (a row's position in its file), dates that are not in order;
    with a ``universe`` (asset_type, symbol), its assets without any row.
    """
    from .minute import _with_copies

    raw, adj = list(PRICES), [f"adj_{c}" for c in PRICES]
    numbers = [*raw, "volume", *adj, "adj_volume", "dividend", "split_factor"]
    bad_number = F.array_contains(F.array(*[F.coalesce(S.finite(F.col(c).cast("double")).isNull(), F.lit(True)) for c in numbers]), True)

    def envelope(o: str, h: str, low: str, c: str) -> Column:
        return (F.least(o, h, low, c) <= 0) | (F.col(low) > F.least(o, c)) | (F.col(h) < F.greatest(o, c))

    key = F.concat_ws(" ", "symbol", F.col("date").cast("string"))
    checks = [
        Check("invalid_date", F.col("date").isNull()),
        Check("duplicate_date", F.col("_copies") > 1, example=key),
        Check("identity", S.us_symbol("symbol").isNull() | S.asset_type("asset_type").isNull(), example=key),
        Check("bad_number", bad_number, example=key),
        Check("raw_ohlc", envelope(*raw), example=key),
        Check("adjusted_ohlc", envelope(*adj), example=key),
        Check("negative_volume", (F.col("volume") < 0) | (F.col("adj_volume") < 0), example=key),
        Check("negative_dividend", F.col("dividend") < 0, example=key),
        Check("split_factor", F.col("split_factor") <= 0, example=key),
    ]
    if "source" in bars.columns:
        checks.append(Check("missing_source", F.trim(F.coalesce("source", F.lit(""))) == "", example=key))
    scope = ["asset_type", "symbol"]
    out = run_checks(_with_copies(bars, [*scope, "date"]), checks, scope)
    if "place" in bars.columns:
        out = out.unionByName(file_order(bars, scope, ["date"], "date_order"))
    if universe is not None:
        bare = universe.select(*scope).distinct().join(bars.select(*scope).distinct(), scope, "left_anti")
        out = out.unionByName(run_checks(bare, [Check("no_rows", F.lit(True))], scope))
    return out


def universe_report(universe: DataFrame, bars: DataFrame) -> DataFrame:
    """Every asset with rows, first and last date, errors and ok; an asset without bars is missing and not ok."""
    have = bars.groupBy("asset_type", "symbol").agg(F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    wrong = us_daily_findings(bars).groupBy("scope").agg(F.sort_array(F.collect_set("check")).alias("errors"))
    rows = universe.select("asset_type", "symbol").distinct().join(have, ["asset_type", "symbol"], "left")
    rows = rows.withColumn("scope", F.concat_ws("/", "asset_type", "symbol")).join(wrong, "scope", "left")
    errors = F.when(F.col("rows").isNull(), F.array(F.lit("missing_file"))).otherwise(F.coalesce("errors", F.array().cast("array<string>")))
    return rows.select("asset_type", "symbol", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "first_date", "last_date", errors.alias("errors"), (F.size(errors) == 0).alias("ok"))


def set_differences(parts: DataFrame, key: str, group: str) -> DataFrame:
    """Keys that some groups lack, with the groups that have them; e.g. symbols by archive frequency."""
    groups = parts.agg(F.countDistinct(group)).first()[0]
    have = parts.groupBy(key).agg(F.sort_array(F.collect_set(group)).alias("present"))
    return have.filter(F.size("present") < groups)


def missing_months(delivered: DataFrame, group: str, first, last) -> DataFrame:
    """Months from first to last that a group lacks; delivered: the group and month (a date)."""
    months = F.sequence(F.trunc(F.lit(first).cast("date"), "month"), F.trunc(F.lit(last).cast("date"), "month"), F.expr("interval 1 month"))
    want = delivered.select(group).distinct().withColumn("month", F.explode(months))
    return want.join(delivered.select(group, F.trunc("month", "month").alias("month")), [group, "month"], "left_anti")
