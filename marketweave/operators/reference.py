"""Reference tables: trading calendar, security master, industries, universes, A-share statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .findings import Check, run_checks
from .merge import numbered


def calendar(rows: DataFrame, market: str, source: str, observed_at: str) -> DataFrame:
    """date, market, is_trading_day, source, observed_at, year (to partition by) and ``reject`` for a bad date or flag."""
    flag = F.trim(F.col("is_trading_day").cast("string"))
    date = S.parse_date("calendar_date")
    return rows.select(date.alias("date"), F.lit(market).alias("market"), F.when(flag.isin("0", "1"), flag == "1").alias("is_trading_day"), F.lit(source).alias("source"), F.lit(observed_at).alias("observed_at"), F.year(date).alias("year"), F.when(date.isNull(), "bad_date").when(~flag.isin("0", "1") | flag.isNull(), "bad_flag").alias("reject"))


def security_master(rows: DataFrame, as_of, observed_at: str, source: str, exchanges: tuple[str, ...] = ("SZ", "SH")) -> DataFrame:
    """A-shares of provider rows (code ``sz.000001``, code_name, ipoDate, outDate) with board, base limit and status as of a date."""
    symbol = S.from_provider_code("code")
    listed, delisted = S.parse_date("ipoDate"), S.parse_date("outDate")
    out = rows.withColumn("symbol", symbol).filter(S.is_a_share("symbol", exchanges)).withColumn("board", S.board("symbol")).withColumn("_limit", S.price_limit("board"))
    return out.select(F.lit(observed_at).alias("observed_at"), "symbol", F.substring_index("symbol", ".", -1).alias("exchange"), F.trim("code_name").alias("name"), "board", listed.alias("listing_date"), delisted.alias("delisting_date"), S.listing_status(listed, delisted, F.lit(as_of).cast("date")).alias("status_as_of"), F.lit("unknown").alias("st_status"), "_limit.*", F.lit(source).alias("source"))


def industries(rows: DataFrame, date, retrieved_at: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Industries of A-shares without blank ones, and the symbols that occur more than once (must be none)."""
    symbol = S.from_provider_code("code")
    out = rows.withColumn("symbol", symbol).filter(S.is_a_share("symbol")).filter(S.blank_to_null("industry").isNotNull())
    out = out.select(F.lit(date).cast("date").alias("classification_date"), S.parse_date("updateDate").alias("provider_update_date"), F.lit(retrieved_at).alias("retrieved_at"), "symbol", F.substring_index("symbol", ".", -1).alias("exchange"), F.trim("code_name").alias("name"), F.trim("industry").alias("industry"), F.trim("industryClassification").alias("classification"), F.lit(source).alias("source"))
    return out, out.groupBy("symbol").agg(F.count("*").alias("copies")).filter("copies > 1")


def listed_between(universe: DataFrame, exchange: str, start, end, include_delisted: bool) -> DataFrame:
    """Stocks (type 1) of an exchange listed by ``end``. Delisted ones are left out, or if included only those gone before ``start``."""
    listed, gone = S.parse_date("ipoDate"), S.parse_date("outDate")
    rows = universe.filter((F.substring_index("code", ".", 1) == exchange.lower()) & (F.col("type").cast("string") == "1") & (listed <= F.lit(end).cast("date")))
    return rows.filter(gone.isNull() | (gone >= F.lit(start).cast("date"))) if include_delisted else rows.filter(gone.isNull())


def clipped(universe: DataFrame, start, end) -> DataFrame:
    """lower and upper: the requested dates within listing_date and delisting_date; assets with none are left out."""
    lower = F.greatest(F.lit(start).cast("date"), F.coalesce("listing_date", F.lit(start).cast("date")))
    upper = F.least(F.lit(end).cast("date"), F.coalesce("delisting_date", F.lit(end).cast("date")))
    return universe.withColumn("lower", lower).withColumn("upper", upper).filter("lower <= upper")


def us_universe(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Enabled assets (asset_type, symbol, provider_symbol and what else there is), and skipped rows with a reason; repeated assets are skipped as duplicate."""
    symbol, kind = S.us_symbol("symbol"), S.asset_type("asset_type")
    rest = [c for c in rows.columns if c not in ("symbol", "asset_type", "provider_symbol", "enabled")]
    typed = rows.select(symbol.alias("symbol"), kind.alias("asset_type"), F.coalesce(S.blank_to_null("provider_symbol"), S.provider_alias(symbol)).alias("provider_symbol"), S.flag("enabled").alias("enabled"), *rest)
    copies = typed.groupBy("asset_type", "symbol").agg(F.count("*").alias("_n"))
    typed = typed.join(copies, ["asset_type", "symbol"], "left")
    reason = F.when(F.col("symbol").isNull(), "invalid_symbol").when(F.col("asset_type").isNull(), "invalid_asset_type").when(~F.coalesce("enabled", F.lit(False)), "disabled").when(F.col("_n") > 1, "duplicate")
    marked = typed.withColumn("reason", reason).drop("_n")
    return marked.filter("reason is null").drop("reason", "enabled"), marked.filter("reason is not null")


def select_universe(universe: DataFrame, symbols: list[str] | None = None, ciks: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Entries with one of the symbols or CIKs (a CIK may have several symbols), sorted; and the selectors that match none."""
    spark = universe.sparkSession
    asked = spark.createDataFrame([("symbol", s.upper()) for s in symbols or []] + [("cik", c.zfill(10)) for c in ciks or []], "kind string, value string")
    have = universe.select(F.lit("symbol").alias("kind"), F.col("symbol").alias("value")).unionByName(universe.select(F.lit("cik").alias("kind"), F.col("cik").alias("value"))).distinct()
    chosen = universe if not (symbols or ciks) else universe.filter(F.col("symbol").isin(*[s.upper() for s in symbols or []]) | F.col("cik").isin(*[c.zfill(10) for c in ciks or []]))
    return chosen.orderBy("symbol"), asked.join(have, ["kind", "value"], "left_anti")


def cached_universe(rows: DataFrame, exchange: str) -> tuple[DataFrame, DataFrame]:
    """Codes of one exchange sorted, and findings: wrong exchange, duplicates."""
    code = F.lower(F.trim("code"))
    typed = rows.withColumn("code", code)
    counts = typed.join(typed.groupBy("code").agg(F.count("*").alias("_n")), "code")
    found = run_checks(counts, [Check("wrong_exchange", F.substring_index("code", ".", 1) != exchange.lower(), example=F.col("code")), Check("bad_code", ~F.col("code").rlike(r"^(sh|sz|bj)\.\d{6}$"), example=F.col("code")), Check("duplicate_code", F.col("_n") > 1, example=F.col("code"))])
    return typed.orderBy("code"), found


def aligned_statements(profit: DataFrame, balance: DataFrame, cash_flow: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and mismatches with a reason: the three parts of (code, year, quarter) must be there once each with one statDate (the quarter's end) and one pubDate."""
    key = ["code", "year", "quarter"]

    def part(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in key]
        return df.groupBy(*key).agg(F.count("*").alias(f"n_{name}"), F.max(F.struct(*rest)).alias(name))

    joined = part(profit, "profit").join(part(balance, "balance"), key, "full_outer").join(part(cash_flow, "cash"), key, "full_outer")
    dates = lambda c: F.array_distinct(F.array(F.col(f"profit.{c}"), F.col(f"balance.{c}"), F.col(f"cash.{c}")))
    end = F.last_day(F.make_date("year", F.col("quarter") * 3, F.lit(1)))
    reason = (
        F.when(F.col("n_profit").isNull() | F.col("n_balance").isNull() | F.col("n_cash").isNull(), "partial")
        .when(F.greatest("n_profit", "n_balance", "n_cash") > 1, "repeated")
        .when(F.size(dates("statDate")) > 1, "stat_date_mismatch")
        .when(F.size(dates("pubDate")) > 1, "pub_date_mismatch")
        .when(~S.parse_date("profit.statDate").eqNullSafe(end), "stat_date_not_quarter_end")
    )
    marked = joined.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null").select(*key, "reason")


def statements(aligned: DataFrame) -> DataFrame:
    """The statement row of an aligned quarter; per cents become decimals of 8 places beside the raw ones."""
    pct = lambda c, name: [S.percent_to_decimal(c).alias(name), S.blank_to_null(c).alias(f"{name}_raw_percent")]
    num = lambda c: S.blank_to_null(c).try_cast("decimal(28,4)")
    return aligned.select(
        S.from_provider_code("code").alias("symbol"), S.parse_date("profit.statDate").alias("report_period"), S.parse_date("profit.pubDate").alias("announce_date"), S.statement_type("quarter").alias("statement_type"), F.col("code").alias("source_code"), F.col("year").alias("source_year"), F.col("quarter").alias("source_quarter"),
        F.col("profit.statDate").alias("source_stat_date"), F.col("profit.pubDate").alias("source_pub_date"), num("profit.MBRevenue").alias("revenue"), num("profit.netProfit").alias("net_profit"), *pct("cash.CFOToOR", "operating_cash_flow_ratio"), *pct("profit.roeAvg", "roe"), *pct("profit.gpMargin", "gross_margin"), *pct("balance.liabilityToAsset", "debt_to_assets"),
    )


def statement_errors(rows: DataFrame, most: int = 20) -> DataFrame:
    """symbol, error, period: at most ``most`` of each symbol, by period."""
    close = lambda c: F.abs(F.col(c).cast("double") - F.col(f"{c}_raw_percent").try_cast("double") / 100) > F.greatest(F.lit(1e-10), F.lit(1e-9) * F.abs(F.col(c).cast("double")))
    checks = {
        "symbol_prefix": ~S.is_a_share("symbol"),
        "incomplete_key": F.array_contains(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source_code", "source_year", "source_quarter", "source_stat_date", "source_pub_date")]), ""),
        "announced_before_period": F.col("announce_date") < F.col("report_period"),
        "period_not_source_date": ~F.col("report_period").eqNullSafe(S.parse_date("source_stat_date")),
        "announce_not_source_date": ~F.col("announce_date").eqNullSafe(S.parse_date("source_pub_date")),
        "period_not_quarter": ~F.col("report_period").eqNullSafe(F.last_day(F.make_date("source_year", F.col("source_quarter") * 3, F.lit(1)))),
        "statement_type": ~F.col("statement_type").eqNullSafe(S.statement_type("source_quarter")),
        "code": ~F.col("symbol").eqNullSafe(S.from_provider_code("source_code")),
        **{f"{c}_ratio": close(c) for c in ("roe", "gross_margin", "debt_to_assets", "operating_cash_flow_ratio")},
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in checks.items()]))
    return numbered(rows.select("symbol", F.explode(found).alias("error"), F.col("report_period").alias("period")), ["symbol"], [F.col("period"), F.col("error")], most)
