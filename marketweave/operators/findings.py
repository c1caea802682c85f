"""Findings: every check of a validation is one count in a single aggregation, unpivoted to rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COLUMNS = ["severity", "check", "scope", "count", "total", "max_abs_diff", "example", "detail"]


@dataclass(frozen=True)
class Check:
    """``bad`` is the predicate of offending rows; a null predicate does not offend."""

    name: str
    bad: Column
    severity: str = "error"
    example: Column | None = None
    diff: Column | None = None


def run_checks(rows: DataFrame, checks: list[Check], scope: list[str] | None = None) -> DataFrame:
    """One row per scope and check that found something: count, total rows, greatest difference among offenders, least example."""
    scope = scope or []
    text = lambda c: c.cast("string")
    aggregates = [F.count("*").alias("_total")]
    for i, c in enumerate(checks):
        aggregates.append(F.count_if(F.coalesce(c.bad, F.lit(False))).alias(f"_n{i}"))
        aggregates.append(F.min(F.when(c.bad, text(c.example))).alias(f"_e{i}") if c.example is not None else F.first(F.lit(None).cast("string")).alias(f"_e{i}"))
        aggregates.append(F.max(F.when(c.bad, c.diff.cast("double"))).alias(f"_d{i}") if c.diff is not None else F.first(F.lit(None).cast("double")).alias(f"_d{i}"))
    counted = rows.groupBy(*scope).agg(*aggregates) if scope else rows.agg(*aggregates)
    found = F.array(*[F.struct(F.lit(c.severity).alias("severity"), F.lit(c.name).alias("check"), F.col(f"_n{i}").alias("count"), F.col(f"_d{i}").alias("max_abs_diff"), F.col(f"_e{i}").alias("example")) for i, c in enumerate(checks)])
    name = F.concat_ws("/", *[F.col(s).cast("string") for s in scope]) if scope else F.lit("")
    out = counted.select(name.alias("scope"), F.col("_total").alias("total"), F.inline(found)).filter("count > 0")
    return out.withColumn("detail", F.concat(F.col("count").cast("string"), F.lit(" of "), F.col("total").cast("string"))).select(*COLUMNS)


def file_order(rows: DataFrame, scope: list[str], order: list[str | Column], name: str = "row_order") -> DataFrame:
    """Rows that stand behind a greater one in their file, by scope; ``place`` is a row's position there. Null values come first. Without ``place`` nothing can be told, and there are no findings."""
    if "place" not in rows.columns:
        return run_checks(rows.limit(0), [Check(name, F.lit(False))], scope)
    key = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    before = F.lag(key).over(Window.partitionBy(*scope).orderBy("place"))
    placed = rows.select(*scope, (before > key).alias("_bad"), F.col("place").cast("string").alias("_at"))
    return run_checks(placed, [Check(name, F.col("_bad"), example=F.col("_at"))], scope)


def with_identity(rows: DataFrame, universe: DataFrame) -> DataFrame:
    """Rows with the cik that their symbol has in ``universe`` as ``_cik`` (null: none)."""
    return rows.join(universe.select("symbol", F.col("cik").alias("_cik")).dropDuplicates(["symbol"]), "symbol", "left")


def roll_up(findings: DataFrame) -> DataFrame:
    """One row: numbers of error, warning and info findings."""
    kind = lambda s: F.count_if(F.col("severity") == s)
    return findings.agg(kind("error").alias("errors"), kind("warning").alias("warnings"), kind("info").alias("info"))


def ordered(findings: DataFrame, year: str | None = None) -> DataFrame:
    keys = ([F.asc_nulls_last(year)] if year else []) + [F.asc(c) for c in ("severity", "check", "scope")]
    return findings.orderBy(*keys)
