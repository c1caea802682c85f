"""Standardized point-in-time financials from company facts.

Everything is a long table of metric versions until the end; versions of a report period differ by (available_date,
accepted_at, accession). All joins have the symbol as an equi key, so one company never meets another.

facts: symbol, row_id, taxonomy, tag, unit, start_date, end_date (date), value (decimal), available_date (date),
accepted_at, form, fiscal_year, fiscal_period, accession, retrieved_at. filings: symbol, accession.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..settled import settle
from . import concepts

VERSION = ["available_date", "accepted_at", "accession"]
CONTEXT = ["symbol", "accession", "available_date", "end_date", "cls", "start_date"]
SOURCE = ["taxonomy", "tag", "unit", "row_ids", "calculation", "component_periods", "component_accessions"]
ROW = ["symbol", "period_type", "report_period", "available_date", "accession"]


def mapped_facts(facts: DataFrame) -> DataFrame:
    """Facts of registered concepts that are known by then and have a period class; the registry is broadcast."""
    known = facts.join(F.broadcast(concepts.registry(facts.sparkSession)), ["taxonomy", "tag", "unit"])
    return known.filter(F.col("end_date") <= F.col("available_date")).withColumn("cls", S.period_class("start_date", "end_date", "form", "fiscal_period")).filter("cls <> 'ambiguous'")


def build_statistics(facts: DataFrame) -> DataFrame:
    """Per symbol: facts, future ones left out, unmapped tags, ambiguous ones, and whether there is a custom taxonomy."""
    reg = F.broadcast(concepts.registry(facts.sparkSession).select("taxonomy", "tag", "unit", F.lit(True).alias("mapped")))
    rows = facts.join(reg, ["taxonomy", "tag", "unit"], "left").withColumn("mapped", F.coalesce("mapped", F.lit(False)))
    future = F.col("mapped") & (F.col("end_date") > F.col("available_date"))
    ambiguous = F.col("mapped") & ~future & (S.period_class("start_date", "end_date", "form", "fiscal_period") == "ambiguous")
    custom = ~F.col("mapped") & ~F.col("taxonomy").isin("us-gaap", "dei", "ifrs-full")
    return rows.groupBy("symbol").agg(F.count("*").alias("facts"), F.count_if(future).alias("future_facts"), F.countDistinct(F.when(~F.col("mapped"), F.struct("taxonomy", "tag", "unit"))).alias("unmapped_tags"), F.count_if(ambiguous).alias("ambiguous_facts"), F.bool_or(custom).alias("custom_taxonomy"), F.max("retrieved_at").alias("built_at"))


def candidate_choice(mapped: DataFrame) -> DataFrame:
    """One row per context and metric: the value of the preferred tag (outflows positive), whether candidates disagree, and the facts behind it."""
    value = F.when(F.col("expenditure"), F.abs("value")).otherwise(F.col("value"))
    order = F.struct("priority", F.coalesce("start_date", F.lit("0001-01-01").cast("date")), "row_id")
    per = mapped.withColumn("norm", value).withColumn("flipped", F.col("expenditure") & (F.col("value") < 0)).groupBy(*CONTEXT, "metric", "kind", "additive").agg(
        F.min_by(F.struct("norm", "priority", "taxonomy", "tag", "unit", "flipped"), order).alias("best"),
        F.size(F.collect_set("norm")).alias("values"),
        F.collect_list(F.struct("priority", "norm", "row_id")).alias("all"),
    )
    same = F.array_sort(F.transform(F.filter("all", lambda x: (x.priority == F.col("best.priority")) & (x.norm == F.col("best.norm"))), lambda x: x.row_id))
    return per.select(
        *CONTEXT, "metric", "kind", "additive", F.col("best.norm").alias("value"), "best.taxonomy", "best.tag", "best.unit", same.alias("row_ids"),
        F.when(F.col("best.flipped"), "normalize_positive_outflow").otherwise("direct").alias("calculation"), F.array().cast("array<date>").alias("component_periods"), F.array("accession").alias("component_accessions"), (F.col("values") > 1).alias("conflict"),
    )


def contexts(mapped: DataFrame, chosen: DataFrame, filings: DataFrame) -> DataFrame:
    """One row per context: modal fiscal year, period and form (ties: the least), latest acceptance, number of metrics, flags."""
    modal = lambda c: F.mode(F.nullif(F.col(c), F.lit("")), True).alias(c)
    rows = mapped.groupBy(*CONTEXT).agg(modal("fiscal_year"), modal("fiscal_period"), modal("form"), F.max("accepted_at").alias("accepted_at"), F.countDistinct("metric").alias("n_metrics"))
    clash = chosen.groupBy(*[F.col(c).alias(f"_{c}") for c in CONTEXT]).agg(F.bool_or("conflict").alias("conflict"))
    on = F.lit(True)
    for c in CONTEXT:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    linked = filings.select("symbol", "accession").distinct().withColumn("linked", F.lit(True))
    rows = rows.join(clash, on, "left").drop(*[f"_{c}" for c in CONTEXT]).join(linked, ["symbol", "accession"], "left")
    flags = F.array_compact(F.array(F.when(F.col("conflict"), "conflicting_candidate_tags"), F.when(F.col("linked").isNull(), "unlinked_accession")))
    return rows.withColumn("flags", flags).drop("conflict", "linked")


def _version(prefix: str = "") -> Column:
    return F.struct(*[F.coalesce(F.col(prefix + c), F.lit("")) if c == "accepted_at" else F.col(prefix + c) for c in VERSION])


def _of_context(chosen: DataFrame, rows: DataFrame, start: str, keep: list[str]) -> DataFrame:
    """Metrics of the context of each row; ``start`` names the column with the context's start, cls its class."""
    left = rows.select(*[F.col(c).alias(f"_{c}") for c in ("symbol", "accession", "available_date", "end_date", "cls")], F.col(start).alias("_start_date"), F.struct(*keep).alias("_keep"))
    on = F.lit(True)
    for c in ("symbol", "accession", "available_date", "end_date", "cls"):
        on = on & (F.col(c) == F.col(f"_{c}"))
    on = on & F.col("start_date").eqNullSafe(F.col("_start_date"))
    return chosen.join(left, on).select("_keep.*", "metric", "kind", "additive", "value", *SOURCE)


def _instants(versions: DataFrame, ctx: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Balance-sheet metrics and flags of each version: of its own accession and end, else the latest visible with that end."""
    i = ctx.filter("cls = 'instant'").select(F.col("symbol").alias("i_symbol"), F.col("accession").alias("i_accession"), F.col("available_date").alias("i_available_date"), F.coalesce("accepted_at", F.lit("")).alias("i_accepted_at"), F.col("end_date").alias("i_end"), F.col("flags").alias("i_flags"))
    own = F.col("i_accession") == F.col("accession")
    met = versions.join(i, (F.col("symbol") == F.col("i_symbol")) & (F.col("report_period") == F.col("i_end")) & (own | (F.col("i_available_date") <= F.col("available_date"))))
    best = met.groupBy(*ROW).agg(F.max_by(F.struct("i_accession", "i_available_date", "i_flags"), F.struct(own, "i_available_date", F.when(own, F.lit("")).otherwise(F.col("i_accepted_at")), "i_accession")).alias("i"))
    flags = best.select(*ROW, F.col("i.i_flags").alias("flags"))
    rows = best.select(*ROW, F.col("i.i_accession").alias("c_accession"), F.col("i.i_available_date").alias("c_available"))
    c = chosen.filter("cls = 'instant'").select(F.col("symbol").alias("c_symbol"), F.col("accession").alias("m_accession"), F.col("available_date").alias("m_available"), F.col("end_date").alias("m_end"), "metric", "kind", "additive", "value", *SOURCE)
    metrics = rows.join(c, (F.col("symbol") == F.col("c_symbol")) & (F.col("c_accession") == F.col("m_accession")) & (F.col("c_available") == F.col("m_available")) & (F.col("report_period") == F.col("m_end")))
    return metrics.select(*ROW, "metric", "kind", "additive", "value", *SOURCE), flags


def _first_metrics(parts: list[DataFrame]) -> DataFrame:
    """Of several sources of a row's metric the first that has it."""
    out = None
    for k, p in enumerate(parts):
        p = p.select(*ROW, "metric", "value", *SOURCE, F.lit(k).alias("_k"))
        out = p if out is None else out.unionByName(p)
    return out.groupBy(*ROW, "metric").agg(F.min_by(F.struct("value", *SOURCE), "_k").alias("m")).select(*ROW, "metric", "m.*")


def _flagged(versions: DataFrame, more: list[DataFrame]) -> DataFrame:
    """Versions with their flags and those of the other tables (ROW and flags) united; one row per key."""
    out = versions.select(*ROW, "flags")
    for m in more:
        out = out.unionByName(m.select(*ROW, "flags"))
    flags = out.groupBy(*ROW).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("flags")))).alias("flags"))
    rest = [c for c in versions.columns if c not in (*ROW, "flags")]
    one = versions.groupBy(*ROW).agg(F.min_by(F.struct(*rest), F.struct(*[c for c in rest])).alias("_r")).select(*ROW, "_r.*")
    return one.join(flags, ROW)


def annual(ctx: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Annual versions and their metrics. The fiscal year is that of the period's earliest disclosure."""
    form = F.regexp_replace("form", "/A", "").isin("10-K", "20-F", "40-F")
    rows = ctx.filter("cls = 'annual'").filter(F.coalesce(form, F.lit(False)) | F.coalesce(F.col("fiscal_period") == "FY", F.lit(False)))
    rows = rows.withColumns({"period_type": F.lit("annual"), "report_period": F.col("end_date"), "period_start": F.col("start_date"), "fiscal_period": F.lit("FY")})
    flows = _of_context(chosen, rows, "start_date", ROW)
    instants, flags = _instants(rows.select(*ROW).distinct(), ctx, chosen)
    versions = _flagged(rows.select(*ROW, "accepted_at", "form", "fiscal_year", "fiscal_period", "period_start", "flags"), [flags])
    first = versions.groupBy("symbol", "report_period").agg(F.min_by("fiscal_year", _version()).alias("_fy"))
    versions = versions.join(first, ["symbol", "report_period"]).withColumn("fiscal_year", F.col("_fy")).drop("_fy")
    return versions, _first_metrics([instants, flows])


def quarters(ctx: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Versions of the quarters Q1 to Q3 and their metrics: direct quarter facts, else year-to-date less the quarters before."""
    event = ["symbol", "accession", "available_date", "end_date"]
    of = lambda cls: F.max_by(F.struct("start_date", F.coalesce("fiscal_year", F.lit("")).alias("fiscal_year"), F.coalesce("fiscal_period", F.lit("")).alias("fiscal_period"), "form", F.coalesce("accepted_at", F.lit("")).alias("accepted_at")), F.when(F.col("cls") == cls, F.struct("n_metrics", "start_date")))
    events = ctx.filter(F.col("cls").isin("quarter", "h1_ytd", "nine_month_ytd", "instant")).groupBy(*event).agg(
        F.collect_set(F.upper("fiscal_period")).alias("periods"), F.collect_set("cls").alias("classes"), F.flatten(F.collect_list("flags")).alias("flags"), of("quarter").alias("direct"), of("h1_ytd").alias("h1"), of("nine_month_ytd").alias("nine")
    )
    label = S.quarter_label("periods", "classes")
    events = events.filter(F.exists("classes", lambda c: c != "instant")).withColumn("label", label).filter(F.col("label").isin("Q1", "Q2", "Q3"))
    own = F.when(F.col("label") == "Q2", F.col("h1")).when(F.col("label") == "Q3", F.col("nine")).otherwise(F.col("direct"))
    events = events.withColumn("cum", F.coalesce(own, F.col("direct"))).withColumn("cum_cls", F.when(own.isNull() | (F.col("label") == "Q1"), "quarter").when(F.col("label") == "Q2", "h1_ytd").otherwise("nine_month_ytd"))
    events = events.withColumn("anchor", F.coalesce("direct", "cum")).filter("anchor is not null")
    versions = events.select(
        "symbol", F.lit("quarterly").alias("period_type"), F.col("end_date").alias("report_period"), "available_date", "accession", "end_date", F.col("anchor.accepted_at").alias("accepted_at"), F.col("anchor.form").alias("form"), F.col("anchor.fiscal_year").alias("fiscal_year"),
        F.col("label").alias("fiscal_period"), F.col("anchor.start_date").alias("period_start"), "flags", "direct", "cum", "cum_cls",
    )
    direct = _of_context(chosen.filter("kind = 'flow'"), versions.filter("direct is not null").withColumn("cls", F.lit("quarter")).withColumn("_s", F.col("direct.start_date")), "_s", ROW)
    keep = [*ROW, "label", "fy", "cum_end"]
    cum_rows = versions.filter("cum is not null").withColumns({"cls": F.col("cum_cls"), "_s": F.col("cum.start_date"), "label": F.col("fiscal_period"), "fy": F.col("cum.fiscal_year"), "cum_end": F.col("report_period")})
    cum = _of_context(chosen.filter("kind = 'flow' and additive"), cum_rows, "_s", keep).join(direct.select(*ROW, "metric"), [*ROW, "metric"], "left_anti")
    first = cum.filter("label = 'Q1'")
    before = chosen.filter("kind = 'flow' and additive and cls in ('quarter', 'h1_ytd')").join(ctx.select(*CONTEXT, F.coalesce("fiscal_year", F.lit("")).alias("p_fy"), F.coalesce("accepted_at", F.lit("")).alias("p_accepted")), CONTEXT)
    before = before.select(F.col("symbol").alias("p_symbol"), F.col("metric").alias("p_metric"), F.col("cls").alias("p_cls"), "p_fy", F.col("end_date").alias("p_end"), F.col("available_date").alias("p_available"), "p_accepted", F.col("accession").alias("p_accession"), F.struct("value", *SOURCE).alias("p"))
    later = cum.filter("label <> 'Q1'")
    met = later.join(before, (F.col("symbol") == F.col("p_symbol")) & (F.col("metric") == F.col("p_metric")) & (F.col("p_cls") == F.when(F.col("label") == "Q2", "quarter").otherwise("h1_ytd")) & ((F.col("fy") == "") | (F.col("fy") == F.col("p_fy"))) & (F.col("p_end") < F.col("cum_end")) & (F.col("p_available") <= F.col("available_date")))
    prior = met.groupBy(*ROW, "metric").agg(F.max_by(F.struct("p_end", "p"), F.struct("p_end", "p_available", "p_accepted", "p_accession")).alias("prior"))
    diff = later.join(prior, [*ROW, "metric"]).filter(F.col("unit") == F.col("prior.p.unit"))
    derived = diff.select(
        *ROW, "metric", (F.col("value") - F.col("prior.p.value")).alias("value"), "taxonomy", "tag", "unit", F.array_sort(F.array_union("row_ids", "prior.p.row_ids")).alias("row_ids"), F.lit("ytd_difference").alias("calculation"),
        F.array("report_period", "prior.p_end").alias("component_periods"), F.array_sort(F.array_union("component_accessions", "prior.p.component_accessions")).alias("component_accessions"), F.col("prior.p_end").alias("prior_end"),
    )
    flows = _first_metrics([direct, first, derived])
    marks = derived.groupBy(*ROW).agg(F.max("prior_end").alias("prior_end"))
    lacking = cum.join(flows.select(*ROW, "metric"), [*ROW, "metric"], "left_anti").filter("label <> 'Q1'").select(*ROW).distinct().withColumn("flags", F.array(F.lit("quarter_derivation_incomplete")))
    instants, flags = _instants(versions.select(*ROW).distinct(), ctx, chosen)
    rows = versions.join(marks, ROW, "left").withColumn("period_start", F.when(F.col("direct").isNull() & F.col("prior_end").isNotNull(), F.date_add("prior_end", 1)).otherwise(F.col("period_start")))
    rows = rows.withColumn("flags", F.when(F.col("prior_end").isNotNull(), F.array_union("flags", F.array(F.lit("quarter_derived_from_ytd")))).otherwise(F.col("flags")))
    rows = _flagged(rows.select(*ROW, "accepted_at", "form", "fiscal_year", "fiscal_period", "period_start", "flags"), [flags, lacking])
    metrics = _first_metrics([instants, flows])
    return rows.join(metrics.select(*ROW).distinct(), ROW, "left_semi"), metrics


def stable_identity(versions: DataFrame, annual_versions: DataFrame) -> DataFrame:
    """Fiscal year and period of each report period, once and for all its versions.

    The earliest disclosure names a period; an annual end is Q4; the last four ends up to an annual end (span 250 to 430
    days) are its Q1 to Q4; up to three ends after the last one (gaps 45 to 150 days) are Q1 to Q3 of the next year.
    """
    named = versions.groupBy("symbol", "report_period").agg(F.min_by(F.struct("fiscal_year", "fiscal_period"), _version()).alias("own"))
    anchors = annual_versions.filter("fiscal_year is not null and fiscal_year <> ''").groupBy("symbol", "report_period").agg(F.min("fiscal_year").alias("anchor_fy"))
    rows = named.join(anchors, ["symbol", "report_period"], "left")
    order = Window.partitionBy("symbol").orderBy("report_period")
    anchor = F.when(F.col("anchor_fy").isNotNull(), F.struct("report_period", "anchor_fy"))
    rows = rows.withColumn("next", F.first(anchor, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))).withColumn("last", F.last(anchor, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("gap", F.datediff("report_period", F.lag("report_period").over(order)))
    group = Window.partitionBy("symbol", "next.report_period")
    rows = rows.withColumn("back", F.row_number().over(group.orderBy(F.desc("report_period")))).withColumn("ahead", F.row_number().over(group.orderBy("report_period")))
    fourth = F.min(F.when(F.col("back") == 4, F.col("report_period"))).over(group)
    rows = rows.withColumn("span", F.datediff(F.col("next.report_period"), fourth)).withColumn("steady", F.min(F.when(F.col("gap").between(45, 150), 1).otherwise(0)).over(group.orderBy("report_period").rowsBetween(Window.unboundedPreceding, 0)) == 1)
    full = F.col("next").isNotNull() & (F.col("back") <= 4) & F.coalesce(F.col("span").between(250, 430), F.lit(False))
    after = F.col("next").isNull() & F.col("last").isNotNull() & (F.col("ahead") <= 3) & F.col("steady")
    year = F.when(full, F.col("next.anchor_fy")).when(F.col("anchor_fy").isNotNull(), F.col("anchor_fy")).when(after, F.coalesce((F.col("last.anchor_fy").try_cast("int") + 1).cast("string"), F.col("last.anchor_fy"))).otherwise(F.col("own.fiscal_year"))
    period = F.when(full, F.concat(F.lit("Q"), (5 - F.col("back")).cast("string"))).when(F.col("anchor_fy").isNotNull(), "Q4").when(after, F.concat(F.lit("Q"), F.col("ahead").cast("string"))).otherwise(F.col("own.fiscal_period"))
    names = rows.select("symbol", "report_period", year.alias("_fy"), period.alias("_fp"))
    return versions.join(names, ["symbol", "report_period"]).withColumn("fiscal_year", F.col("_fy")).withColumn("fiscal_period", F.col("_fp")).drop("_fy", "_fp")


def fourth_quarters(ctx: DataFrame, chosen: DataFrame, annual_versions: DataFrame, annual_metrics: DataFrame, q_versions: DataFrame, q_metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q4 versions, visible from the annual report on: direct quarter facts of that report, else the year less Q1 to Q3 as known then."""
    as_q4 = annual_versions.withColumn("period_type", F.lit("quarterly"))
    quarter = ctx.filter("cls = 'quarter'").groupBy("symbol", "accession", F.col("end_date").alias("report_period")).agg(F.min_by(F.struct("available_date", "start_date"), F.struct("available_date", "start_date")).alias("q"))
    with_direct = as_q4.join(quarter, ["symbol", "accession", "report_period"]).withColumns({"end_date": F.col("report_period"), "cls": F.lit("quarter"), "_s": F.col("q.start_date"), "row_available": F.col("available_date")})
    direct = _of_context(chosen, with_direct.withColumn("available_date", F.col("q.available_date")), "_s", ["symbol", "period_type", "report_period", "row_available", "accession"]).withColumnRenamed("row_available", "available_date")
    a = as_q4.select(*ROW, "fiscal_year")
    q = q_versions.select("symbol", F.col("report_period").alias("q_period"), F.col("available_date").alias("q_available"), F.coalesce("accepted_at", F.lit("")).alias("q_accepted"), F.col("accession").alias("q_accession"), "fiscal_year", F.col("fiscal_period").alias("q_label"))
    prior = a.join(q, ["symbol", "fiscal_year"]).filter(F.col("q_label").isin("Q1", "Q2", "Q3") & (F.col("q_period") < F.col("report_period")) & (F.col("q_available") <= F.col("available_date")))
    periods = prior.groupBy(*ROW, "q_label").agg(F.max("q_period").alias("q_period"))
    third = periods.filter("q_label = 'Q3'").select(*ROW, F.col("q_period").alias("q3_period"))
    seen = q_metrics.select("symbol", F.col("report_period").alias("q_period"), F.col("available_date").alias("q_available"), F.col("accession").alias("q_accession"), "metric", F.struct("value", *SOURCE).alias("m")).join(q_versions.select("symbol", F.col("report_period").alias("q_period"), F.col("available_date").alias("q_available"), F.col("accession").alias("q_accession"), F.coalesce("accepted_at", F.lit("")).alias("q_accepted")), ["symbol", "q_period", "q_available", "q_accession"])
    known = periods.join(seen, ["symbol", "q_period"]).filter(F.col("q_available") <= F.col("available_date"))
    latest = known.groupBy(*ROW, "metric", "q_label").agg(F.max_by(F.struct("q_label", "q_period", "m"), F.struct("q_available", "q_accepted", "q_accession")).alias("part"))
    three = latest.groupBy(*ROW, "metric").agg(F.sort_array(F.collect_list("part")).alias("parts")).filter(F.size("parts") == 3)
    derivable = annual_metrics.withColumn("period_type", F.lit("quarterly")).filter(F.col("metric").isin(*concepts.ADDITIVE)).join(direct.select(*ROW, "metric"), [*ROW, "metric"], "left_anti")
    total = F.aggregate("parts", F.lit(0).cast("decimal(38,12)"), lambda s, p: (s + p["m"]["value"]).cast("decimal(38,12)"))
    union = lambda c: F.array_sort(F.array_union(c, F.array_distinct(F.flatten(F.transform("parts", lambda p: p["m"][c])))))
    less = derivable.join(three, [*ROW, "metric"]).select(
        *ROW, "metric", (F.col("value") - total).cast("decimal(38,12)").alias("value"), "taxonomy", "tag", "unit", union("row_ids").alias("row_ids"), F.lit("fy_less_q1_q2_q3").alias("calculation"),
        F.concat(F.array("report_period"), F.transform("parts", lambda p: p["q_period"])).alias("component_periods"), union("component_accessions").alias("component_accessions"),
    )
    instants, flags = _instants(as_q4.select(*ROW).distinct(), ctx, chosen)
    metrics = _first_metrics([instants, direct, less])
    derived = less.select(*ROW).distinct().withColumn("flags", F.array(F.lit("q4_derived_from_fy")))
    core = annual_metrics.withColumn("period_type", F.lit("quarterly")).filter(F.col("metric").isin("revenue", "operating_income", "net_income", "operating_cash_flow", "capital_expenditure"))
    lacking = core.join(metrics.select(*ROW, "metric"), [*ROW, "metric"], "left_anti").select(*ROW).distinct().withColumn("flags", F.array(F.lit("quarter_derivation_incomplete")))
    rows = as_q4.join(third, ROW, "left").withColumns({"period_start": F.date_add("q3_period", 1), "fiscal_period": F.lit("Q4")}).drop("q3_period")
    rows = _flagged(rows.select(*ROW, "accepted_at", "form", "fiscal_year", "fiscal_period", "period_start", "flags"), [flags, derived, lacking])
    return rows.join(metrics.select(*ROW).distinct(), ROW, "left_semi"), metrics


def latest_visible(asks: DataFrame, at: str, facts: DataFrame, keys: list[str], version: list[str], row: Column) -> DataFrame:
    """For each ask its columns and ``found``, the ``row`` of the fact of its keys with the greatest ``version`` (available date first) that ``at`` has seen; asks without one are left out.

    Facts and asks are united and gone through once in order of availability, so it is linear in both.
    """
    told = facts.select(*keys, F.col(version[0]).alias("_at"), F.lit(0).alias("_ask"), F.struct(*version).alias("_v"), row.alias("_row"))
    asked = asks.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_ask"), F.struct(*asks.columns).alias("_of"))
    order = Window.partitionBy(*keys).orderBy("_at", "_ask", "_v").rowsBetween(Window.unboundedPreceding, 0)
    both = told.unionByName(asked, allowMissingColumns=True).withColumn("found", F.last("_row", ignorenulls=True).over(order))
    return both.filter("_ask = 1 and found is not null").select("_of.*", "found")


_FOUR = "symbol string, available_date date, accepted_at string, accession string, form string, fiscal_year string, fiscal_period string, period_start date, periods array<date>"


def _follow(periods: list, first: dict) -> bool:
    """Whether four periods are consecutive quarters by their dates and, where all have one, by their labels."""
    gaps = [(b - a).days for a, b in zip(periods, periods[1:], strict=False)]
    if any(not 45 <= g <= 150 for g in gaps) or not 250 <= (periods[-1] - periods[0]).days <= 430:
        return False
    labels = [first[p][0] for p in periods]
    if all(isinstance(x, str) and len(x) == 2 and x[0] == "Q" and x[1] in "1234" for x in labels):
        return all(int(b[1]) % 4 == (int(a[1]) + 1) % 4 for a, b in zip(labels, labels[1:], strict=False))
    return True


def four_quarters(versions: pd.DataFrame) -> pd.DataFrame:
    """A symbol's disclosures that concern its last four visible quarters, where these are consecutive.

    One pass over the versions in order of availability; what is kept is each period's first and last version and the
    sorted periods.
    """
    rows = versions.assign(accepted_at=versions["accepted_at"].fillna("")).sort_values(["available_date", "accepted_at", "accession"], kind="stable")
    first, last, periods, out = {}, {}, [], []
    for day, of_day in rows.groupby("available_date", sort=False):
        events = {}
        for r in of_day.itertuples(index=False):
            if r.report_period not in first:
                first[r.report_period] = r.fiscal_period, r.period_start
                bisect.insort(periods, r.report_period)
            last[r.report_period] = r.form, r.fiscal_year, r.fiscal_period
            events.setdefault((r.accepted_at, r.accession), set())
        touched = {}
        for r in of_day.itertuples(index=False):
            touched.setdefault(r.accession, set()).add(r.report_period)
        four = periods[-4:]
        if len(four) < 4 or not _follow(four, first):
            continue
        for accepted, accession in events:
            if touched[accession] & set(four):
                out.append((rows["symbol"].iloc[0], day, accepted, accession, *last[four[-1]], first[four[0]][1], four))
    return pd.DataFrame(out, columns=[c.split(" ")[0] for c in _FOUR.split(", ")])


def trailing(q_versions: DataFrame, q_metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trailing-twelve-month versions: at each disclosure the last four visible quarters, if consecutive by their earliest versions.

    A symbol's versions (without their metrics) are gone through once; the metrics of each quarter are found by another pass
    in order of availability. Both are linear in the number of versions.
    """
    v = q_versions.select("symbol", "report_period", "available_date", F.coalesce("accepted_at", F.lit("")).alias("accepted_at"), "accession", "form", F.col("fiscal_year").cast("string").alias("fiscal_year"), "fiscal_period", "period_start")
    good = v.groupBy("symbol").applyInPandas(four_quarters, _FOUR)
    rows = good.select("symbol", F.lit("ttm").alias("period_type"), F.element_at("periods", -1).alias("report_period"), "available_date", "accession", "accepted_at", "form", "fiscal_year", "fiscal_period", "period_start", "periods")
    m = q_metrics.join(v.select("symbol", "report_period", "available_date", "accession", "accepted_at"), ["symbol", "report_period", "available_date", "accession"])
    m = m.select("symbol", F.col("report_period").alias("q_period"), F.col("available_date").alias("q_available"), F.col("accepted_at").alias("q_accepted"), F.col("accession").alias("q_accession"), "metric", "value", *SOURCE)
    asked = rows.select(*ROW, F.posexplode("periods").alias("k", "q_period")).join(m.select("symbol", "q_period", "metric").distinct(), ["symbol", "q_period"])
    latest = latest_visible(asked, "available_date", m, ["symbol", "q_period", "metric"], ["q_available", "q_accepted", "q_accession"], F.struct("value", *SOURCE, "q_accession")).withColumnRenamed("found", "m")
    first = F.min_by(F.struct("m.taxonomy", "m.tag", "m.unit"), "k").alias("f")
    sums = latest.filter(F.col("metric").isin(*concepts.ADDITIVE)).groupBy(*ROW, "metric").agg(F.count("*").alias("n"), F.sum("m.value").cast("decimal(38,12)").alias("value"), first, F.array_sort(F.array_distinct(F.flatten(F.collect_list("m.row_ids")))).alias("row_ids"), F.sort_array(F.collect_list(F.struct("k", "q_period", F.col("m.q_accession").alias("a")))).alias("c")).filter("n = 4")
    sums = sums.select(*ROW, "metric", "value", "f.taxonomy", "f.tag", "f.unit", "row_ids", F.lit("sum_four_quarters").alias("calculation"), F.transform("c", lambda x: x["q_period"]).alias("component_periods"), F.transform("c", lambda x: x["a"]).alias("component_accessions"))
    last = latest.filter((F.col("k") == 3) & F.col("metric").isin(*concepts.INSTANTS)).select(*ROW, "metric", "m.value", *[F.col(f"m.{c}") for c in SOURCE])
    metrics = sums.unionByName(last)
    whole = metrics.filter(F.col("metric").isin("revenue", "net_income")).groupBy(*ROW).agg(F.count("*").alias("n")).filter("n = 2")
    rows = rows.drop("periods").join(whole, ROW, "left").withColumn("flags", F.when(F.col("n").isNull(), F.array(F.lit("ttm_incomplete"))).otherwise(F.array().cast("array<string>"))).drop("n")
    return rows, metrics


def _combined(rows: DataFrame, name: str, value: Column, inputs: list[str], calculation: str) -> DataFrame:
    """A derived metric in the wide table of structs; null where an input is missing."""
    part = lambda c: F.array_distinct(F.flatten(F.array(*[F.col(i)[c] for i in inputs])))
    made = F.struct(value.cast("decimal(38,12)").alias("value"), F.col(inputs[0])["taxonomy"].alias("taxonomy"), F.col(inputs[0])["tag"].alias("tag"), F.col(inputs[0])["unit"].alias("unit"), F.array_sort(part("row_ids")).alias("row_ids"), F.lit(calculation).alias("calculation"), F.array(*["report_period"] * len(inputs)).alias("component_periods"), F.array_sort(part("component_accessions")).alias("component_accessions"))
    return rows.withColumn(name, F.when(value.isNotNull(), made).otherwise(F.col(name) if name in rows.columns else F.lit(None).cast("struct<value:decimal(38,12),taxonomy:string,tag:string,unit:string,row_ids:array<string>,calculation:string,component_periods:array<date>,component_accessions:array<string>>")))


def common_metrics(versions: DataFrame, metrics: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """Wide rows of structs (value and lineage) per metric: inapplicable ones blanked, totals, cash flow, ratios, year-over-year.

    models: symbol, business_model; without it every company is non_financial.
    """
    from .pit import prior_year

    wide = metrics.groupBy(*ROW).pivot("metric", concepts.METRICS).agg(F.first(F.struct("value", *SOURCE)))
    rows = versions.join(wide, ROW, "left")
    rows = rows.join(models.select("symbol", "business_model"), "symbol", "left").withColumn("business_model", F.coalesce("business_model", F.lit("non_financial"))) if models is not None else rows.withColumn("business_model", F.lit("non_financial"))

    def applies(name: str) -> Column:
        without = [m for m, names in concepts.NOT_APPLICABLE.items() if name in names]
        return ~F.col("business_model").isin(*without) if without else F.lit(True)

    rows = settle(rows.withColumns({m: F.when(applies(m), F.col(m)) for m in concepts.METRICS}), "wide")
    v = lambda c: F.col(c)["value"]
    rows = _combined(rows, "total_debt", F.when(v("total_debt").isNull(), v("short_term_debt") + v("long_term_debt")), ["short_term_debt", "long_term_debt"], "short_term_debt+long_term_debt")
    rows = _combined(rows, "free_cash_flow", F.when(applies("free_cash_flow"), v("operating_cash_flow") - v("capital_expenditure")), ["operating_cash_flow", "capital_expenditure"], "operating_cash_flow-capital_expenditure")
    for name, num, den in concepts.RATIOS:
        rows = _combined(rows, name, F.when(applies(name), S.safe_ratio(v(num), v(den))), [num, den], f"{num}/{den}")
    rows = settle(rows, "ratios")
    rows = _combined(rows, "net_debt", v("total_debt") - v("cash_and_equivalents") - F.coalesce(v("short_term_investments"), F.lit(0)), ["total_debt", "cash_and_equivalents"], "total_debt-cash-short_term_investments")
    for metric, name in (("revenue", "revenue_yoy"), ("shares_outstanding", "shares_yoy")):
        flat = prior_year(rows.select(*ROW, "accepted_at", "fiscal_period", v(metric).alias("_v")), "_v").select(*ROW, F.col("yoy").alias(f"_{name}"))
        rows = _combined(rows.join(flat, ROW, "left"), name, F.col(f"_{name}"), [metric], "year_over_year").drop(f"_{name}")
    return rows


def finalize(rows: DataFrame) -> DataFrame:
    """Flags, completeness and status."""
    v = lambda c: F.col(c)["value"]
    # completeness: present base metrics over those that apply
    filled = F.lit(0)
    apply_n = F.lit(0)
    for m in concepts.BASE_METRICS:
        without = [b for b, names in concepts.NOT_APPLICABLE.items() if m in names]
        on = ~F.col("business_model").isin(*without) if without else F.lit(True)
        apply_n = apply_n + on.cast("int")
        filled = filled + (on & v(m).isNotNull()).cast("int")
    limited = F.col("business_model").isin(*[b for b, names in concepts.NOT_APPLICABLE.items() if names])
    more = F.array_compact(F.array(F.when(v("revenue").isNull(), "missing_revenue"), F.when(v("net_income").isNull(), "missing_net_income"), F.when(v("stockholders_equity") < 0, "negative_equity"), F.when(limited, "not_applicable_for_business_model")))
    flags = F.array_sort(F.array_union(F.coalesce("flags", F.array().cast("array<string>")), more))
    return rows.withColumn("completeness_score", F.round(filled / apply_n, 6)).withColumn("quality_flags", flags).withColumn("quality_status", F.when(F.size("quality_flags") > 0, "warning").otherwise("observed")).drop("flags")


def standardize(facts: DataFrame, filings: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """All quarterly, annual and TTM versions as wide rows of structs. ``values`` and ``provenance`` take them apart."""
    mapped = settle(mapped_facts(facts), "mapped")
    chosen = settle(candidate_choice(mapped), "chosen")
    ctx = settle(contexts(mapped, chosen, filings), "contexts")
    a_rows, a_metrics = _settled(annual(ctx, chosen), "annual")
    q_rows, q_metrics = quarters(ctx, chosen)
    q_rows, q_metrics = _settled((stable_identity(q_rows, a_rows), q_metrics), "quarters")
    q4_rows, q4_metrics = fourth_quarters(ctx, chosen, a_rows, a_metrics, q_rows, q_metrics)
    q_rows, q_metrics = _settled((_flagged(q_rows.unionByName(q4_rows), []), _first_metrics([q_metrics, q4_metrics])), "all-quarters")
    q_rows = settle(stable_identity(q_rows, a_rows), "named-quarters")
    t_rows, t_metrics = _settled(trailing(q_rows, q_metrics), "trailing")
    versions, metrics = _settled((q_rows.unionByName(a_rows).unionByName(t_rows), q_metrics.unionByName(a_metrics).unionByName(t_metrics)), "versions")
    return finalize(common_metrics(versions, metrics, models))


def _settled(tables: tuple[DataFrame, DataFrame], name: str) -> tuple[DataFrame, DataFrame]:
    return settle(tables[0], f"{name}-rows"), settle(tables[1], f"{name}-metrics")


DERIVED = [r[0] for r in concepts.RATIOS] + ["net_debt", "revenue_yoy", "shares_yoy"]


def values(rows: DataFrame) -> DataFrame:
    """Plain columns: one decimal per metric."""
    names = [*concepts.BASE_METRICS, *DERIVED]
    return rows.select(*[c for c in rows.columns if c not in names], *[F.col(n)["value"].alias(n) for n in names])


def provenance(rows: DataFrame) -> DataFrame:
    """One row per populated metric with its source."""
    names = [*concepts.BASE_METRICS, *DERIVED]
    parts = F.array(*[F.when(F.col(n).isNotNull(), F.struct(F.lit(n).alias("metric"), *[F.col(n)[c].alias(c) for c in SOURCE])) for n in names])
    return rows.select(*ROW, F.inline(F.array_compact(parts)))
