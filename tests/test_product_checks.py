"""Checks of stored products: source, order in the file, identities, finite values."""

import datetime as dt

from pyspark.sql import functions as F

from marketweave.operators import financial_audit, findings, sec


def test_filings(spark):
    row = dict(symbol="A", cik="1", form="10-Q", filing_date=dt.date(2024, 5, 1), accepted_at="2024-05-01T10:00:00-04:00", is_xbrl=True, is_inline_xbrl=True, source="sec.edgar.submissions")
    rows = [row | dict(accession="a", place=1), row | dict(accession="b", place=2, source="other"), row | dict(accession="c", place=4, cik="2"), row | dict(accession="d", place=3)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "symbol string, cik string, form string, filing_date date, accepted_at string, is_xbrl boolean, is_inline_xbrl boolean, source string, accession string, place int")
    universe = spark.createDataFrame([("A", "1")], "symbol string, cik string")
    got = {(r.check, r["count"], r.example) for r in sec.validate_filings(df, universe).collect()}
    assert got == {("source", 1, "b"), ("cik", 1, "c"), ("row_order", 1, "4")}
    assert sec.validate_filings(df.drop("place", "source")).count() == 0


def test_standardized(spark):
    base = ("A", "quarterly", dt.date(2024, 3, 31), dt.date(2024, 5, 1), "a1", "1", dt.date(2024, 3, 31), "sec.edgar.standardized", "2024-06-01T00:00:00Z", 1.0, 1)
    schema = "symbol string, period_type string, report_period date, available_date date, accession string, cik string, period_end date, source string, built_at string, revenue double, place int"
    names = [x.split(" ")[0] for x in schema.split(", ")]
    change = lambda **k: tuple(k.get(n, v) for n, v in zip(names, base, strict=True))
    rows = [base, change(accession="a2", period_end=dt.date(2024, 3, 30), place=2), change(accession="a3", source="x", place=3), change(accession="a4", revenue=float("nan"), place=4), change(accession="a5", built_at="soon", place=5), change(accession="a6", cik="9", place=7), change(accession="a7", place=6)]
    universe = spark.createDataFrame([("A", "1")], "symbol string, cik string")
    got = {(r.check, r["count"]) for r in financial_audit.product_checks(spark.createDataFrame(rows, schema), ["revenue"], universe).collect()}
    assert got == {("period_end", 1), ("source", 1), ("not_finite", 1), ("built_at", 1), ("cik", 1), ("row_order", 1)}
    assert financial_audit.product_checks(spark.createDataFrame([base], schema), ["revenue"], universe).count() == 0


def test_order_in_files(spark):
    rows = spark.createDataFrame([("f", 1, None), ("f", 2, 5), ("f", 3, 5), ("f", 4, 3), ("g", 1, 9)], "file string, place int, x int")
    assert [(r.scope, r["count"], r.example) for r in findings.file_order(rows, ["file"], ["x"]).collect()] == [("f", 1, "4")]
    assert findings.file_order(rows.drop("place"), ["file"], ["x"]).count() == 0
    assert findings.file_order(rows.filter(F.lit(False)), ["file"], ["x"]).count() == 0
