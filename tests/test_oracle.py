"""Every registered market query equals its SQL on DuckDB at the smallest scale."""

import duckdb
import pytest

from marketweave.plans import products  # noqa: F401
from marketweave.plans import queries as plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(tuple("" if v is None else str(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = plans.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.sql(plans.ORACLE[name])
    assert sorted(want.columns) == columns
    place = [want.columns.index(c) for c in columns]
    rows = [tuple(r[i] for i in place) for r in want.fetchall()]
    assert plain(got.select(*columns).collect()) == plain(rows)


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLE)
