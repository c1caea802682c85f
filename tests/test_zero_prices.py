"""Queries over minute bars equal their SQL where trades have a price of 0, whichever fault the minute has."""

import duckdb
import pytest
from pyspark.sql import functions as F

from marketweave.operators import minute
from marketweave.plans import products  # noqa: F401
from marketweave.plans import queries as plans
from test_minute import sample
from test_oracle import SF, plain


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("zero")
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE value END AS value) FROM '{SF}/events.parquet') TO '{out}/events.parquet' (FORMAT parquet)")
    return str(out)


def equal(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    got = plans.QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    want = con.sql(plans.ORACLE[name])
    place = [want.columns.index(c) for c in columns]
    rows = [tuple(r[i] for i in place) for r in want.fetchall()]
    assert rows and plain(got.select(*columns).collect()) == plain(rows)


def test_build(spark, folder):
    equal(spark, folder, "min_build")


def test_build_evidence(spark, folder):
    equal(spark, folder, "min_build_evidence")


def test_production(spark, folder):
    equal(spark, folder, "min_production")


def test_raw_audit(spark, folder):
    equal(spark, folder, "min_raw_audit")


def test_accepted_findings_leave_no_symbol_out(spark):
    bad = sample(spark, cells={(1, "open"): 0.0, (1, "low"): 0.0, (2, "volume"): -1})
    assert minute.build(bad)["unresolved"].select(F.array_join("reasons", " ")).first()[0] == "invalid_ohlc negative_activity"
    assert minute.build(bad, accepted=["invalid_ohlc"])["unresolved"].select(F.array_join("reasons", " ")).first()[0] == "negative_activity"
    kept = minute.build(bad, accepted=["invalid_ohlc", "negative_activity"])
    assert kept["unresolved"].count() == 0 and kept["bars"].filter("frequency = 1").count() == 6
