"""Trailing sums by one pass over versions, against trying all versions for each disclosure."""

import datetime as dt
import random
import time
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from marketweave.operators import financial_audit, financials


def versions(seed, symbols=3, quarters=14):
    """Quarters of some symbols with gaps, amendments, same-day filings and metrics that only some versions have."""
    rng, out = random.Random(seed), []
    for s in range(symbols):
        for q in range(quarters):
            if rng.random() < 0.1:
                continue
            period = dt.date(2018 + q // 4, 3 * (q % 4) + 3, 28)
            for n in range(rng.choice([1, 1, 2, 3])):
                day = period + dt.timedelta(days=rng.choice([30, 30, 45, 200, 400]) + n)
                label = None if rng.random() < 0.05 else f"Q{q % 4 + 1}"
                out.append((f"S{s}", "quarterly", period, day, f"a{s}-{q}-{n}" if rng.random() < 0.8 else f"a{s}-{q + 1}-0", rng.choice([None, "t1", "t2"]), "10-Q", str(period.year), label, period - dt.timedelta(days=89), rng.randrange(100) if rng.random() < 0.8 else None, rng.randrange(1000)))
    unique = {(r[0], r[2], r[3], r[4]): r for r in out}
    return list(unique.values())


def brute(rows):
    key = lambda r: (r[3], r[5] or "", r[4])
    out = {}
    for symbol in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == symbol]
        for day, accepted, accession in sorted({(r[3], r[5] or "", r[4]) for r in mine}):
            seen = [r for r in mine if r[3] <= day]
            periods = sorted({r[2] for r in seen})[-4:]
            if len(periods) < 4:
                continue
            first = [min((r for r in seen if r[2] == p), key=key) for p in periods]
            gaps = [(b - a).days for a, b in zip(periods, periods[1:])]
            labels = [r[8] for r in first]
            if any(not 45 <= g <= 150 for g in gaps) or not 250 <= (periods[-1] - periods[0]).days <= 430:
                continue
            if all(labels) and any(int(b[1]) % 4 != (int(a[1]) + 1) % 4 for a, b in zip(labels, labels[1:])):
                continue
            if not any(r[4] == accession and r[3] == day and r[2] in periods for r in seen):
                continue
            for metric, at in (("revenue", 10), ("total_assets", 11)):
                last = [max((r for r in seen if r[2] == p and r[at] is not None), key=key, default=None) for p in (periods if metric == "revenue" else periods[-1:])]
                if None not in last:
                    out[symbol, periods[-1], day, accession, metric] = sum(r[at] for r in last), [r[4] for r in last] if metric == "revenue" else None
    return out


def tables(spark, rows):
    schema = "symbol string, period_type string, report_period date, available_date date, accession string, accepted_at string, form string, fiscal_year string, fiscal_period string, period_start date, revenue int, total_assets int"
    df = spark.createDataFrame(rows, schema)
    metric = lambda c: df.filter(F.col(c).isNotNull()).select(*financials.ROW, F.lit(c).alias("metric"), F.col(c).cast("decimal(38,12)").alias("value"), F.lit("t").alias("taxonomy"), F.lit(c).alias("tag"), F.lit("USD").alias("unit"), F.array("accession").alias("row_ids"), F.lit("direct").alias("calculation"), F.array().cast("array<date>").alias("component_periods"), F.array("accession").alias("component_accessions"))
    return df.drop("revenue", "total_assets"), metric("revenue").unionByName(metric("total_assets"))


def test_against_all_versions(spark):
    for seed in range(3):
        rows = versions(seed)
        _, metrics = financials.trailing(*tables(spark, rows))
        got = {(r.symbol, r.report_period, r.available_date, r.accession, r.metric): (int(r.value), list(r.component_accessions) if r.metric == "revenue" else None) for r in metrics.collect()}
        want = brute(rows)
        assert got == want and len(want) > 20


def long_history(n):
    """``n`` versions of one symbol over 40 quarters."""
    day = dt.date(2000, 1, 1)
    periods = [dt.date(1990 + q // 4, 3 * (q % 4) + 3, 28) for q in range(40)]
    return pd.DataFrame([("S", periods[i % 40], day + dt.timedelta(days=i // 4), None, f"a{i}", "10-Q", "1990", f"Q{i % 4 + 1}", periods[i % 40]) for i in range(n)], columns=["symbol", "report_period", "available_date", "accepted_at", "accession", "form", "fiscal_year", "fiscal_period", "period_start"])


def test_the_pass_is_linear():
    times = []
    for n in (4_000, 16_000):
        frame = long_history(n)
        began = time.perf_counter()
        assert len(financials.four_quarters(frame)) > 0
        times.append(time.perf_counter() - began)
    assert times[1] < 9 * times[0] + 0.5


def test_ten_thousand_versions_of_a_symbol(spark):
    """No join makes more rows than a few for each version, so the plan is linear too."""
    frame = long_history(10_000)
    rows = [(r.symbol, "quarterly", r.report_period, r.available_date, r.accession, None, r.form, r.fiscal_year, r.fiscal_period, r.period_start, 1, 1) for r in frame.itertuples()]
    ttm, metrics = financials.trailing(*tables(spark, rows))
    sums = metrics.filter("metric = 'revenue'").agg(F.count("*").alias("n"), F.max("value").alias("v")).first()
    assert sums["n"] == ttm.count() > 900 and sums["v"] == Decimal(4)


def test_components_are_audited(spark):
    rows = versions(4)
    v, m = tables(spark, rows)
    ttm, metrics = financials.trailing(v, m)
    wide = lambda versions, metrics: versions.join(metrics.groupBy(*financials.ROW).pivot("metric", ["revenue", "total_assets"]).agg(F.first("value")), financials.ROW)
    columns = [*financials.ROW, "accepted_at", "fiscal_period", "revenue", "total_assets"]
    products = wide(v.select(*financials.ROW, "accepted_at", "fiscal_period"), m).select(*columns).unionByName(wide(ttm.select(*financials.ROW, "accepted_at", "fiscal_period"), metrics).select(*columns))
    for c in financial_audit.concepts.ADDITIVE:
        if c not in products.columns:
            products = products.withColumn(c, F.lit(None).cast("decimal(38,12)"))
    lineage = metrics.select(*financials.ROW, "metric", "calculation", "component_periods", "component_accessions")
    got = financial_audit.trailing_components(products, lineage).collect()
    assert got and all(r.found == r.told == 4 and r.total == r.value and r.latest for r in got)
    other = lineage.withColumn("component_accessions", F.transform("component_accessions", lambda x, i: F.when(i == 0, F.lit("none")).otherwise(x)))
    assert all(r.found == 3 for r in financial_audit.trailing_components(products, other).collect())
