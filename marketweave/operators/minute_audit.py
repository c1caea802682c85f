"""Whole validations of minute bars: a production build against its roll-ups and manifest, raw vendor bars across frequencies and against daily bars, and a history of years."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..settled import settle
from . import bars, minute
from .findings import COLUMNS, Check, run_checks

FIELDS = ["open", "high", "low", "close", "volume", "amount"]
SCOPE = ["frequency", "exchange", "trade_date"]


def _exchange():
    return F.lower(F.substring_index("symbol", ".", -1))


def _plain(findings: DataFrame) -> DataFrame:
    return findings.select(*COLUMNS)


def _finding(rows: DataFrame, severity: str, check: str, scope, count, detail) -> DataFrame:
    """Rows that are findings themselves."""
    as_col = lambda x: F.lit(x) if isinstance(x, (str, int)) else x
    return rows.select(F.lit(severity).alias("severity"), F.lit(check).alias("check"), as_col(scope).cast("string").alias("scope"), as_col(count).cast("long").alias("count"), F.lit(None).cast("long").alias("total"), F.lit(None).cast("double").alias("max_abs_diff"), F.lit(None).cast("string").alias("example"), detail.cast("string").alias("detail"))


def _met(rows: DataFrame, keys: list[str], checks: list[Check]) -> DataFrame:
    """Rows that are there (``stored``) and rows that they should come from, met by ``keys``.

    n and m count them, b0, b1, ... the offending ones of each check; s_ fields are those stored, w_ fields the bar wanted.
    """
    stored = F.col("stored")
    out = [F.count_if(stored).alias("n"), F.count_if(~stored).alias("m")]
    out += [F.count_if(stored & F.coalesce(c.bad, F.lit(False))).alias(f"b{i}") for i, c in enumerate(checks)]
    out += [F.max(F.when(stored, F.col(f).cast("double"))).alias(f"s_{f}") for f in FIELDS]
    want = lambda f: F.when(~stored, F.col(f).cast("double"))
    at = F.when(~stored, F.col("trade_time"))
    out += [F.min_by(want("open"), at).alias("w_open"), F.max(want("high")).alias("w_high"), F.min(want("low")).alias("w_low"), F.max_by(want("close"), at).alias("w_close"), F.sum(want("volume")).alias("w_volume"), F.sum(want("amount")).alias("w_amount")]
    return rows.groupBy(*keys).agg(*out)


def _wanted(frequencies: tuple[int, ...], own: Column, by: dict[str, Column]) -> Column:
    """A row for itself (``own``, a struct that ends in ``label`` and ``stored``) and, of a 1-minute bar, for the bars of other frequencies that it is part of."""
    start = F.to_date("trade_time").cast("timestamp")
    label = lambda f: start + F.make_dt_interval(F.lit(0), F.lit(0), S.session_bucket(S.minute_of_day("trade_time"), F.lit(f)))
    parts = [F.struct(F.lit(f).alias("frequency"), *[c.alias(k) for k, c in by.items()], label(f).alias("label"), F.lit(False).alias("stored")) for f in frequencies]
    return F.when((F.col("frequency") == 1) & F.col("trade_time").isNotNull(), F.array(own, *parts)).otherwise(F.array(own))


def _differences(kind: str, allowed: Callable[[str], Column], there: Column, wanted: Column, missing: str, extra: str) -> list[tuple[str, Column, Column | None]]:
    """Name, count and difference of a key that is missing, extra, or has other values than wanted."""
    out: list[tuple[str, Column, Column | None]] = [(f"{kind}_{missing}", (wanted & ~there).cast("long"), None), (f"{kind}_{extra}", F.when(there & ~wanted, F.col("n")).otherwise(0).cast("long"), None)]
    for f in FIELDS:
        d = F.abs(F.col(f"w_{f}") - F.col(f"s_{f}"))
        out.append((f"{kind}_{f}_mismatch", F.coalesce(there & wanted & (d > allowed(f)), F.lit(False)).cast("long"), d))
    return out


def _sums(counts: list[tuple[str, Column, Column | None]], example: Column) -> list[Column]:
    """Aggregates c, e and d of each count: its sum, the least example and the greatest difference where it is not 0."""
    out = []
    for i, (_, n, d) in enumerate(counts):
        out += [F.sum(n).alias(f"c{i}"), F.min(F.when(n > 0, example)).alias(f"e{i}")]
        if d is not None:
            out.append(F.max(F.when(n > 0, d)).alias(f"d{i}"))
    return out


def _sums_again(counts: list[tuple[str, Column, Column | None]], example: Callable[[Column], Column]) -> list[Column]:
    out = []
    for i, (_, _, d) in enumerate(counts):
        out += [F.sum(f"c{i}").alias(f"c{i}"), F.min(F.when(F.col(f"c{i}") > 0, example(F.col(f"e{i}")))).alias(f"e{i}")]
        if d is not None:
            out.append(F.max(f"d{i}").alias(f"d{i}"))
    return out


def _listed(counts: list[tuple[str, Column, Column | None]], total: Callable[[str], Column], severity: Callable[[str], str] = lambda name: "error", shown: Callable[[str], bool] = lambda name: True) -> list[Column]:
    """Findings of summed counts, as structs."""
    return [F.struct(F.lit(severity(name)).alias("severity"), F.lit(name).alias("check"), F.col(f"c{i}").alias("count"), total(name).cast("long").alias("total"), (F.col(f"d{i}") if d is not None else F.lit(None).cast("double")).alias("max_abs_diff"),
                     (F.col(f"e{i}").cast("string") if shown(name) else F.lit(None).cast("string")).alias("example")) for i, (name, _, d) in enumerate(counts)]


def _found(summed: DataFrame, scope: Column, listed: list[Column], *more: str) -> DataFrame:
    out = summed.select(*more, scope.alias("scope"), F.inline(F.array(*listed))).filter("count > 0")
    return out.withColumn("detail", F.concat(F.col("count").cast("string"), F.lit(" of "), F.col("total").cast("string"))).select(*more, *COLUMNS)


def production(built: DataFrame, manifest: DataFrame, evidence: DataFrame | None = None, whole_sessions: bool = True, positive: bool = True) -> DataFrame:
    """All findings of a build: frequency, exchange, trade_date and the canonical columns of every bar.

    By partition: canonical checks (prices over 0 unless ``positive`` is false), bars of another date or exchange than their partition's, symbols without a whole
    session (``whole_sessions``), rows out of order (where ``place``, the row's place in its file, and ``file`` are given),
    and stored roll-ups against recomputed ones. By frequency: partitions that the 1-minute bars do not have or that they
    alone have, and partitions, rows and dates against ``manifest`` (frequency, partitions, rows, first_date, last_date).
    evidence: report, told and found numbers of audit rows, which must agree.

    Bars are dealt out once, by symbol and day. Where they meet, each 1-minute bar is also a part of the bars of all other
    frequencies, so stored and recomputed ones come together in one aggregation by key; its sums by partition are settled,
    and all else follows from these few rows.
    """
    suffix = F.upper(F.substring_index("symbol", ".", -1))
    checks = [c for c in minute.canonical_checks(F.col("frequency"), positive) if c.name != "duplicate_key"]
    checks += [Check("date_mismatch", F.to_date("trade_time") != F.col("trade_date")), Check("exchange_mismatch", _exchange() != F.lower("exchange"))]
    dealt = built.select(*SCOPE, *minute.COLUMNS, F.to_date("trade_time").alias("day")).repartition("symbol", "day")
    own = F.struct(F.col("frequency").cast("int").alias("frequency"), "exchange", "trade_date", F.col("trade_time").alias("label"), F.lit(True).alias("stored"))
    parts = _wanted(bars.FREQUENCIES, own, {"exchange": _exchange(), "trade_date": F.to_date("trade_time")})
    keys = [*SCOPE, "symbol", "day"]
    met = _met(dealt.select("symbol", "day", "trade_time", *FIELDS, F.explode(parts).alias("x")).select("symbol", "day", "trade_time", *FIELDS, "x.*"), [*keys, "label"], checks)
    derived, there, wanted = F.col("frequency") != 1, F.col("n") > 0, F.col("m") > 0
    allowed = lambda f: F.lit(0.0) if f == "volume" else F.lit(1e-9) + F.lit(1e-12) * F.abs(F.col(f"s_{f}"))
    counts = [(c.name, F.col(f"b{i}"), None) for i, c in enumerate(checks)] + [("duplicate_key", F.when(F.col("n") > 1, F.col("n")).otherwise(0), None)]
    counts += [(name, F.when(derived, n).otherwise(0), d) for name, n, d in _differences("derived", allowed, there, wanted, "missing_key", "extra_key")]
    by_symbol = met.groupBy(*keys).agg(F.sum("n").alias("bars"), F.count_if(derived).alias("keys"), *_sums(counts, F.col("label")))
    short = (suffix == "BJ") & (F.col("bars") == S.bars_per_day(F.col("frequency"), F.lit("")))
    partial = (F.col("bars") > 0) & (F.col("bars") != S.bars_per_day(F.col("frequency"), suffix)) & ~short
    sums = by_symbol.groupBy(*SCOPE).agg(
        F.sum("bars").alias("rows"), F.sum("keys").alias("keys"), F.count_if(F.col("bars") > 0).alias("symbols"), F.count_if(partial).alias("partial"), F.min(F.when(partial, F.col("symbol"))).alias("partial_example"),
        *_sums_again(counts, lambda e: F.concat_ws(" ", "symbol", e.cast("string"))))
    sums = settle(sums, "audit")
    listed = _listed(counts, lambda name: F.col("keys") if name.startswith("derived_") else F.col("rows"))
    if whole_sessions:
        listed.append(F.struct(F.lit("error").alias("severity"), F.lit("incomplete_symbol_session").alias("check"), F.col("partial").alias("count"), F.col("symbols").alias("total"), F.lit(None).cast("double").alias("max_abs_diff"), F.col("partial_example").alias("example")))
    out = _found(sums, F.concat_ws("/", *[F.col(c).cast("string") for c in SCOPE]), listed)
    if {"file", "place"} <= set(built.columns):
        now = F.struct("symbol", "trade_time")
        before = F.lag(now).over(Window.partitionBy("file").orderBy("place"))
        key = F.concat_ws(" ", "symbol", F.col("trade_time").cast("string"))
        out = out.unionByName(run_checks(built.select(*SCOPE, "symbol", "trade_time", (before >= now).alias("bad")), [Check("row_order", F.col("bad"), example=key)], SCOPE))
    stored = sums.filter("rows > 0")
    sets = minute.partition_differences(stored).filter("missing > 0 or extra > 0")
    out = out.unionByName(_finding(sets, "error", "frequency_partition_set", F.concat("frequency", F.lit("m")), F.col("missing") + F.col("extra"), F.concat(F.lit("missing="), "missing", F.lit(" extra="), "extra")))
    now = stored.groupBy("frequency").agg(F.count("*").alias("partitions"), F.sum("rows").alias("rows"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))
    same = ["partitions", "rows", "first_date", "last_date"]
    beside = manifest.select("frequency", *[F.col(c).alias(f"m_{c}") for c in same]).join(now, "frequency", "full_outer")
    differs = F.lit(False)
    for c in same:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"m_{c}"))
    out = out.unionByName(_finding(beside.filter(differs), "error", "manifest_statistics", F.concat("frequency", F.lit("m")), 1, F.concat(F.lit("rows="), F.coalesce(F.col("rows").cast("string"), F.lit("none")), F.lit(" manifest="), F.coalesce(F.col("m_rows").cast("string"), F.lit("none")))))
    if evidence is not None:
        wrong = evidence.filter(~F.col("told").eqNullSafe(F.col("found")))
        out = out.unionByName(_finding(wrong, "error", "audit_report_mismatch", F.col("report"), 1, F.concat(F.lit("told="), F.coalesce(F.col("told").cast("string"), F.lit("none")), F.lit(" found="), F.coalesce(F.col("found").cast("string"), F.lit("none")))))
    return _plain(out)


def daily_reference(reference: DataFrame, days: DataFrame) -> DataFrame:
    """Daily bars (symbol, date, prices, volume, amount) of the symbols and dates that ``days`` has, symbols in upper case."""
    return reference.withColumn("symbol", F.upper("symbol")).join(days.select(F.upper("symbol").alias("symbol"), "date").distinct(), ["symbol", "date"], "left_semi")


#: Columns that every vendor frame must have.
REQUIRED = ["ts_code", "freq", "trade_time", "open", "close", "high", "low", "vol", "amount"]


def _told(frames: dict[int, DataFrame], zone: str) -> DataFrame | None:
    """Findings of what only some frames can tell: lacking columns, rows out of order by ``place``, and time zones that members name in ``zone``."""
    out = None
    for f, rows in sorted(frames.items()):
        parts = []
        if lacking := [c for c in REQUIRED if c not in rows.columns]:
            parts.append(_finding(rows.select("member").distinct(), "error", "schema_missing_columns", F.col("member"), len(lacking), F.lit(",".join(lacking))))
        else:
            if "place" in rows.columns:
                before = F.lag("trade_time").over(Window.partitionBy("member").orderBy("place"))
                moved = rows.select("member", (before > F.col("trade_time")).alias("bad")).groupBy("member").agg(F.bool_or("bad").alias("bad")).filter("bad")
                parts.append(_finding(moved, "error", "timestamp_not_sorted", F.col("member"), 1, F.lit("1 of 1")))
            if "zone" in rows.columns:
                other = rows.filter(~F.col("zone").eqNullSafe(zone)).groupBy("member").agg(F.min(F.coalesce("zone", F.lit("none"))).alias("zone"))
                parts.append(_finding(other, "error", "timezone_mismatch", F.col("member"), 1, F.col("zone")))
        for p in parts:
            p = p.withColumn("frequency", F.lit(str(f)))
            out = p if out is None else out.unionByName(p)
    return out


def raw(frames: dict[int, DataFrame], reference: DataFrame | None = None, zone: str = "Asia/Shanghai") -> DataFrame:
    """All findings of raw vendor bars by frequency, with ``frequency``: row and day checks of each; symbols of the 1-minute archive that another lacks; bars and days against those of the 1-minute bars; and these days against daily bars, where there are any of the symbol.

    A frame without a column of ``REQUIRED`` is told so and not looked at further. ``place`` (row in its member) and ``zone``
    (that the member's schema names), where frames have them, are checked too.

    Bars of all frequencies and the daily bars are dealt out once, by symbol and day, and met by key as in ``production``;
    the rows of a day that this gives are settled, and symbols and the daily bars are summed from them.
    """
    whole = {f: rows for f, rows in frames.items() if set(REQUIRED) <= set(rows.columns)}
    told = _told(frames, zone)
    if 1 not in whole:
        raise ValueError("the 1-minute frame must have all columns")
    values = ["ts_code", "freq", "open", "high", "low", "close", "volume", "amount"]
    all_rows = None
    for f, rows in sorted(whole.items()):
        number = [F.col(c).cast("double").alias("volume" if c == "vol" else c) for c in ("open", "high", "low", "close", "vol", "amount")]
        part = rows.select(F.lit(f).alias("frequency"), "member", "ts_code", "freq", "trade_time", *number, F.to_date("trade_time").alias("day"))
        all_rows = part if all_rows is None else all_rows.unionByName(part)
    if reference is not None:
        daily = reference.select(F.lit(0).alias("frequency"), F.upper("symbol").alias("member"), *[F.col(c).cast("double").alias(c) for c in FIELDS], F.col("date").alias("day"))
        all_rows = all_rows.unionByName(daily, allowMissingColumns=True)
    dealt = all_rows.withColumn("u", F.upper("member")).repartition("u", "day")
    others = tuple(f for f in sorted(whole) if f != 1)
    own = F.struct("frequency", F.col("trade_time").alias("label"), F.lit(True).alias("stored"))
    checks = minute.raw_checks(F.col("frequency"))
    exploded = dealt.select("u", "day", "member", "trade_time", *values, F.explode(_wanted(others, own, {})).alias("x")).select("u", "day", "member", "trade_time", *values, F.col("volume").alias("vol"), "x.*")
    met = _met(exploded, ["u", "day", "member", "frequency", "label"], checks)
    there, wanted, other = F.col("n") > 0, F.col("m") > 0, F.col("frequency") > 1
    allowed = lambda f: S.tolerance(f, F.col(f"w_{f}"))
    counts = [(c.name, F.col(f"b{i}"), None) for i, c in enumerate(checks)] + [("duplicate_timestamp", F.greatest(F.col("n") - 1, F.lit(0)), None)]
    counts += [(name, F.when(other, n).otherwise(0), d) for name, n, d in _differences("bar", allowed, there, wanted, "missing_target", "extra_target")]
    daily = [F.sum("n").alias("n"), F.sum("m").alias("m"), F.count("*").alias("keys")]
    for x, has in (("s", there), ("w", wanted)):
        at = F.when(has, F.col("label"))
        daily += [F.min_by(f"{x}_open", at).alias(f"{x}_open"), F.max(f"{x}_high").alias(f"{x}_high"), F.min(f"{x}_low").alias(f"{x}_low"), F.max_by(f"{x}_close", at).alias(f"{x}_close"), F.sum(f"{x}_volume").alias(f"{x}_volume"), F.sum(f"{x}_amount").alias(f"{x}_amount")]
    # a daily bar has no time: its values are those of the only row
    daily += [F.max(f"s_{f}").alias(f"r_{f}") for f in FIELDS]
    days = settle(met.groupBy("u", "day", "member", "frequency").agg(*daily, *_sums(counts, F.col("label"))), "audit-days")

    want = S.bars_per_day(F.col("frequency"), F.substring_index("member", ".", -1))
    again = [("unexpected_bars_per_day", (there & (F.col("n") != want)).cast("long"), None), ("zero_volume_day", F.coalesce(there & (F.col("s_volume") == 0), F.lit(False)).cast("long"), None)]
    again += [(name, F.when(other, F.least(n, F.lit(1))).otherwise(0), d) for name, n, d in _differences("daily", allowed, there, wanted, "missing_target", "extra_target")]
    bars_sums = [c.alias(f"b_{n}") for c, n in ((F.sum("n"), "rows"), (F.sum("m"), "wanted"), (F.sum("keys"), "keys"), (F.count_if(there), "days"), (F.count("*"), "all_days"))]
    by = days.filter("frequency > 0")
    by_row = by.groupBy("member", "frequency").agg(*bars_sums, *_sums_again(counts, lambda e: e))
    rename = {x: f"{x[0]}{int(x[1:]) + len(counts)}" for i in range(len(again)) for x in (f"c{i}", f"e{i}", f"d{i}")}
    every = [("all_year_zero_volume_grid", F.col("c0"), None)]
    by_day = by.groupBy("member", "frequency").agg(F.bool_and(F.coalesce(F.when(there, F.col("s_volume") == 0), F.lit(True))).alias("b_zero"), *_sums(again, F.struct("day", "n"))).withColumnsRenamed(rename)
    sums = settle(by_row.join(by_day, ["member", "frequency"]), "audit-symbols")
    has = F.col("b_rows") > 0
    severity = {c.name: c.severity for c in checks} | {"zero_volume_day": "info"}
    unshown = {c.name for c in checks if c.example is None}
    shown_as = []
    for i, (name, _, d) in enumerate([*counts, *again]):
        e, day = F.col(f"e{i}"), i >= len(counts)
        text = F.concat_ws(":", e["day"].cast("string"), e["n"].cast("string")) if name == "unexpected_bars_per_day" else e["day"].cast("string") if day else e.cast("string")
        total = "b_days" if name in ("unexpected_bars_per_day", "zero_volume_day") else "b_all_days" if day else "b_keys" if name.startswith("bar_") else "b_rows"
        # of a symbol that the archive lacks altogether only that is told
        shown_as.append(F.struct(F.lit(severity.get(name, "error")).alias("severity"), F.lit(name).alias("check"), F.when(has, F.col(f"c{i}")).otherwise(0).alias("count"), F.col(total).alias("total"),
                                 (F.col(f"d{i}") if d is not None else F.lit(None).cast("double")).alias("max_abs_diff"), (F.lit(None).cast("string") if name in unshown else text).alias("example")))
    single = lambda sev, name, bad: F.struct(F.lit(sev).alias("severity"), F.lit(name).alias("check"), bad.cast("long").alias("count"), F.lit(1).cast("long").alias("total"), F.lit(None).cast("double").alias("max_abs_diff"), F.lit(None).cast("string").alias("example"))
    shown_as += [single("warning", every[0][0], has & F.col("b_zero")), single("error", "symbol_missing_from_archive", ~has & (F.col("b_wanted") > 0))]
    out = _found(sums, F.col("member"), shown_as, "frequency").withColumn("frequency", F.col("frequency").cast("string"))
    if reference is not None:
        one = lambda c, f: F.max(F.when(F.col("frequency") == f, F.col(c)))
        pairs = days.filter("frequency in (0, 1)").groupBy("u", "day").agg(F.coalesce(F.max(F.col("frequency") == 1), F.lit(False)).alias("known"), F.coalesce(F.max(F.col("frequency") == 0), F.lit(False)).alias("told"), *[one(f"s_{f}", 1).alias(f"w_{f}") for f in FIELDS], *[one(f"r_{f}", 0).alias(f"s_{f}") for f in FIELDS])
        pairs = pairs.filter("known").withColumn("n", F.col("told").cast("long"))
        compared = _differences("reference", allowed, F.col("told"), F.col("known"), "missing_target", "extra_target")
        by_symbol = pairs.groupBy("u").agg(F.count("*").alias("rows"), F.max("told").alias("any"), *_sums(compared, F.col("day"))).filter("any")
        out = out.unionByName(_found(by_symbol, F.col("u"), _listed(compared, lambda name: F.col("rows"))).withColumn("frequency", F.lit("daily")))
    return out if told is None else out.unionByName(told)


def history(partitions: DataFrame, manifest: DataFrame, first: int, last: int, status: str = "validated") -> DataFrame:
    """Findings of a history of years: years without partitions, years that the manifest (year, status, first_date, last_date) has not validated, dates other than the manifest's, and the history's own status."""
    years = minute.year_audit(partitions, first, last)
    beside = years.join(manifest.select("year", F.col("status").alias("m_status"), F.col("first_date").alias("m_first"), F.col("last_date").alias("m_last")), "year", "left")
    span = lambda a, b: F.concat_ws("..", F.col(a).cast("string"), F.col(b).cast("string"))
    missing = _finding(years.filter("missing"), "error", "missing_year", F.col("year"), 1, F.lit("no partition"))
    unsound = _finding(beside.filter(~F.col("m_status").eqNullSafe("validated")), "error", "year_status", F.col("year"), 1, F.concat(F.lit("actual="), F.coalesce("m_status", F.lit("none"))))
    moved = beside.filter(~F.col("missing") & F.col("m_status").isNotNull() & ~(F.col("first_date").eqNullSafe(F.col("m_first")) & F.col("last_date").eqNullSafe(F.col("m_last"))))
    ranges = _finding(moved, "error", "year_range", F.col("year"), 1, F.concat(span("first_date", "last_date"), F.lit(" manifest "), span("m_first", "m_last")))
    whole = partitions.sparkSession.range(1).filter(F.lit(status) != "validated")
    return missing.unionByName(unsound).unionByName(ranges).unionByName(_finding(whole, "error", "history_status", "history", 1, F.lit(f"actual={status}")))
