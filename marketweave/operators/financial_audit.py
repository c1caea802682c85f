"""Validation of standardized financials: identity, dates, flags, lineage to facts, and trailing sums recomputed from quarters.

products: plain columns (``financials.values``); lineage: one row a populated metric (``financials.provenance``); facts:
row_id, end_date, available_date. Every check is an aggregation over equi joins with the symbol as a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import concepts
from .financials import ROW, latest_visible
from .findings import Check, file_order, run_checks, with_identity

PERIODS = ["quarterly", "annual", "ttm"]
CORE = ["revenue", "net_income", "operating_cash_flow", "capital_expenditure"]


def _version(prefix: str = "") -> Column:
    return F.struct(F.col(f"{prefix}available_date"), F.coalesce(f"{prefix}accepted_at", F.lit("")).alias("accepted_at"), F.col(f"{prefix}accession"))


def metric_rows(products: DataFrame, metrics: list[str]) -> DataFrame:
    """ROW, accepted_at, fiscal_period, metric and value of every populated metric."""
    parts = F.array(*[F.when(F.col(m).isNotNull(), F.struct(F.lit(m).alias("metric"), F.col(m).cast("decimal(38,12)").alias("value"))) for m in metrics])
    return products.select(*ROW, "accepted_at", "fiscal_period", F.inline(F.array_compact(parts)))


# Fixed value: what the products say of their source.
STANDARDIZED_SOURCE = "sec.edgar.standardized"


def product_checks(products: DataFrame, metrics: list[str], universe: DataFrame | None = None) -> DataFrame:
    """Findings of columns that stored products have: another source, a period_end other than the report_period, built_at that is no time, metrics that are not finite, ciks that are not the symbol's in ``universe`` (symbol, cik), and rows out of order by ``place``."""
    key = F.concat_ws(" ", F.col("report_period").cast("string"), "accession")
    scope, checks, have, kinds = ["symbol", "period_type"], [], set(products.columns), dict(products.dtypes)
    if "source" in have:
        checks.append(Check("source", ~F.col("source").eqNullSafe(STANDARDIZED_SOURCE), example=key))
    if "period_end" in have:
        checks.append(Check("period_end", ~F.col("period_end").eqNullSafe(F.col("report_period")), example=key))
    if "built_at" in have:
        checks.append(Check("built_at", F.col("built_at").cast("string").try_cast("timestamp").isNull(), example=key))
    numbers = [m for m in metrics if m in have and kinds[m] in ("double", "float", "string")]
    if numbers:
        bad = F.array_compact(F.array(*[F.when(F.col(m).isNotNull() & (F.col(m).cast("string") != "") & S.finite(F.col(m).cast("string").try_cast("double")).isNull(), F.lit(m)) for m in numbers]))
        checks.append(Check("not_finite", F.size(bad) > 0, example=F.array_join(bad, ",")))
    rows = products
    if universe is not None and "cik" in have:
        rows = with_identity(rows, universe)
        checks.append(Check("cik", ~F.col("cik").eqNullSafe(F.col("_cik")), example=key))
    out = file_order(products, scope, ["report_period", "available_date", "accession"])
    return run_checks(rows, checks, scope).unionByName(out) if checks else out


def row_checks(products: DataFrame) -> DataFrame:
    """Findings of single rows and keys, by symbol and period type."""
    copies = products.groupBy(*ROW).agg((F.count("*") - 1).alias("again"))
    days = F.datediff("report_period", "period_start") + 1
    unknown = F.array_except(F.coalesce("quality_flags", F.array().cast("array<string>")), F.array(*map(F.lit, concepts.QUALITY_FLAGS)))
    key = F.concat_ws(" ", F.col("report_period").cast("string"), "accession")
    checks = [
        Check("period_type", ~F.coalesce(F.col("period_type").isin(PERIODS), F.lit(False)), example=key),
        Check("missing_date", F.col("report_period").isNull() | F.col("available_date").isNull(), example=key),
        Check("missing_accession", F.coalesce(F.col("accession"), F.lit("")) == "", example=key),
        Check("invalid_quality_flag", F.size(unknown) > 0, example=F.array_join(unknown, ",")),
        Check("completeness_score", ~F.coalesce(F.col("completeness_score").between(0, 1), F.lit(False)), example=key),
        Check("quarterly_duration", (F.col("period_type") == "quarterly") & ~days.between(45, 150), "warning", example=key),
    ]
    repeated = run_checks(copies, [Check("duplicate_key", F.col("again") > 0, example=key)], ["symbol", "period_type"])
    return run_checks(products, checks, ["symbol", "period_type"]).unionByName(repeated)


def lineage_checks(products: DataFrame, lineage: DataFrame, facts: DataFrame, metrics: list[str]) -> DataFrame:
    """Metrics without lineage, lineage told twice, and sources that are no fact or were not public yet, by symbol and period type."""
    told = lineage.groupBy(*ROW, "metric").agg(F.count("*").alias("n"))
    beside = metric_rows(products, metrics).join(told, [*ROW, "metric"], "left")
    bare = run_checks(beside, [Check("no_provenance", F.col("n").isNull(), example=F.col("metric"))], ["symbol", "period_type"])
    twice = run_checks(told, [Check("duplicate_provenance", F.col("n") > 1, example=F.col("metric"))], ["symbol", "period_type"])
    known = facts.select("symbol", "row_id", F.col("end_date").alias("f_end"), F.col("available_date").alias("f_available"))
    used = lineage.select(*ROW, "metric", F.explode("row_ids").alias("row_id")).join(known, ["symbol", "row_id"], "left")
    wrong = run_checks(
        used,
        [
            Check("unknown_source", F.col("f_end").isNull() & F.col("f_available").isNull(), example=F.col("row_id")),
            Check("future_source_availability", F.col("f_available") > F.col("available_date"), example=F.col("row_id")),
            Check("future_period_source", F.col("f_end") > F.col("available_date"), example=F.col("row_id")),
        ],
        ["symbol", "period_type"],
    )
    return bare.unionByName(twice).unionByName(wrong)


def trailing_components(products: DataFrame, lineage: DataFrame) -> DataFrame:
    """One row per trailing sum: value, number of components told and found, their sum, whether they are consecutive quarters and whether each is the latest visible version that has the metric."""
    quarters = metric_rows(products.filter("period_type = 'quarterly'"), concepts.ADDITIVE)
    q = quarters.select("symbol", "metric", F.col("report_period").alias("q_period"), F.col("accession").alias("q_accession"), "fiscal_period", F.col("value").alias("q_value"), F.col("available_date").alias("q_available"), _version().alias("q_version"))
    sums = metric_rows(products.filter("period_type = 'ttm'"), concepts.ADDITIVE).drop("accepted_at", "fiscal_period")
    told = lineage.filter("period_type = 'ttm'").select(*ROW, "metric", "calculation", F.arrays_zip(F.col("component_periods").alias("p"), F.col("component_accessions").alias("a")).alias("parts"))
    asked = sums.join(told, [*ROW, "metric"]).withColumn("told", F.size("parts"))
    each = asked.select(*ROW, "metric", "value", "calculation", "told", F.posexplode_outer("parts").alias("k", "part")).select("*", F.col("part.p").alias("q_period"), F.col("part.a").alias("wanted"))
    # of the component's quarter the version told, if it was public, and the latest that was, found in one pass by availability
    own = q.select("symbol", "metric", "q_period", F.col("q_accession").alias("wanted"), F.struct("q_version", "q_value", "fiscal_period").alias("version"), F.col("q_available").alias("own_available"))
    seen = each.join(own, ["symbol", "metric", "q_period", "wanted"], "left")
    mine = F.when(F.col("own_available") <= F.col("available_date"), F.col("version"))
    of_part = [*ROW, "metric", "value", "calculation", "told", "k", "q_period", "wanted"]
    parts = seen.groupBy(*of_part).agg(F.max_by(mine, F.when(mine.isNotNull(), F.col("version.q_version"))).alias("own"))
    versions = q.select("symbol", "metric", "q_period", "q_available", F.col("q_version.accepted_at").alias("q_accepted"), "q_accession", "q_version")
    last = latest_visible(parts.select(*of_part).distinct(), "available_date", versions, ["symbol", "metric", "q_period"], ["q_available", "q_accepted", "q_accession"], F.col("q_version"))
    same = F.lit(True)
    last = last.select(*[F.col(c).alias(f"_{c}") for c in of_part], F.col("found").alias("latest"))
    for c in of_part:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    parts = parts.join(last, same, "left").drop(*[f"_{c}" for c in of_part])
    own = parts.withColumn("number", F.regexp_extract("own.fiscal_period", "^Q([1-4])$", 1).try_cast("int"))
    listed = F.sort_array(F.collect_list(F.struct("q_period", "number")))
    out = own.groupBy(*ROW, "metric", "value", "calculation", "told").agg(F.count("own").alias("found"), F.sum("own.q_value").cast("decimal(38,12)").alias("total"), F.bool_and(F.col("latest.accession") == F.col("wanted")).alias("latest"), listed.alias("q"))
    follows = F.size("q") == 4
    for i in range(3):
        gap = F.datediff(F.get("q", F.lit(i + 1))["q_period"], F.get("q", F.lit(i))["q_period"])
        step = F.get("q", F.lit(i + 1))["number"] % 4 == (F.get("q", F.lit(i))["number"] + 1) % 4
        follows = follows & gap.between(45, 150) & F.coalesce(step, F.lit(False))
    return out.withColumn("consecutive", follows).drop("q")


def trailing_checks(products: DataFrame, lineage: DataFrame) -> DataFrame:
    """Findings of the trailing sums, by symbol."""
    four = (F.col("calculation") == "sum_four_quarters") & (F.col("told") == 4)
    whole = four & (F.col("found") == 4)
    key = F.concat_ws(" ", F.col("report_period").cast("string"), "metric")
    checks = [
        Check("ttm_without_four_quarters", ~F.coalesce(four, F.lit(False)), example=key),
        Check("ttm_component_missing", four & (F.col("found") < 4), example=key),
        Check("ttm_not_consecutive", whole & ~F.col("consecutive"), example=key),
        Check("ttm_not_the_sum", whole & (F.col("total") != F.col("value")), example=key),
        Check("ttm_not_latest_version", whole & ~F.coalesce(F.col("latest"), F.lit(False)), example=key),
    ]
    return run_checks(trailing_components(products, lineage), checks, ["symbol"])


def state_checks(products: DataFrame, as_of, most_days: int = 180) -> DataFrame:
    """Findings of a symbol's state: quarters of two fiscal identities, last four quarters not consecutive, no trailing rows, or stale ones, or without a core metric that applies."""
    q = products.filter("period_type = 'quarterly'")
    names = q.groupBy("symbol", "report_period").agg(F.countDistinct(F.struct(F.coalesce("fiscal_year", F.lit("")), F.coalesce("fiscal_period", F.lit("")))).alias("names"), F.max_by("fiscal_period", _version()).alias("label"))
    unstable = run_checks(names, [Check("unstable_fiscal_identity", F.col("names") > 1, example=F.col("report_period"))], ["symbol"])
    newest = Window.partitionBy("symbol").orderBy(F.desc("report_period"))
    four = names.withColumn("r", F.row_number().over(newest)).withColumn("n", F.regexp_extract("label", "^Q([1-4])$", 1).try_cast("int")).withColumn("later", F.lag("report_period").over(newest)).withColumn("later_n", F.lag("n").over(newest)).filter("r <= 4")
    broken = (F.col("r") > 1) & ~F.coalesce(F.datediff("later", "report_period").between(45, 150) & (F.col("later_n") % 4 == (F.col("n") + 1) % 4), F.lit(False))
    last = four.groupBy("symbol").agg(F.count("*").alias("quarters"), F.bool_or(broken).alias("broken"))
    gaps = run_checks(last, [Check("latest_quarters_not_consecutive", (F.col("quarters") == 4) & F.col("broken"), "warning")], ["symbol"])
    t = products.filter("period_type = 'ttm'")
    newest_t = t.groupBy("symbol").agg(F.max_by(F.struct("report_period", "business_model", *CORE), F.struct(F.col("report_period"), _version())).alias("t"))
    state = products.select("symbol").distinct().join(newest_t, "symbol", "left").select("symbol", "t.*")

    def lacks(metric: str) -> Column:
        without = [m for m, out in concepts.NOT_APPLICABLE.items() if metric in out]
        return F.col("report_period").isNotNull() & F.col(metric).isNull() & (~F.col("business_model").isin(*without) if without else F.lit(True))

    checks = [
        Check("no_ttm", F.col("report_period").isNull(), "warning"),
        Check("stale_ttm", F.datediff(F.lit(as_of).cast("date"), "report_period") > most_days, "warning", example=F.col("report_period")),
        *[Check(f"ttm_missing_{m}", lacks(m), "warning") for m in CORE],
    ]
    return unstable.unionByName(gaps).unionByName(run_checks(state, checks, ["symbol"]))


def validate(products: DataFrame, lineage: DataFrame, facts: DataFrame, as_of, most_days: int = 180, universe: DataFrame | None = None) -> DataFrame:
    """All findings of standardized financials, those of ``product_checks`` where their columns are there; a symbol is sound if none of its findings is an error."""
    from .financials import DERIVED

    metrics = [m for m in (*concepts.BASE_METRICS, *DERIVED) if m in products.columns]
    return row_checks(products).unionByName(product_checks(products, metrics, universe)).unionByName(lineage_checks(products, lineage, facts, metrics)).unionByName(trailing_checks(products, lineage)).unionByName(state_checks(products, as_of, most_days))
