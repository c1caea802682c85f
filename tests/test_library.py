import datetime as dt
import decimal
import io
import gzip
import json
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketweave import schemas
from marketweave.functions import scalars as S
from marketweave.operators import bars, concepts, financials, merge, pit, quality, reference, returns, search, sec, snapshot
from marketweave.sources import archive, files, sinks

D = dt.date.fromisoformat


def col(spark, f, *values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f("x")).collect()]


def test_scalars(spark):
    assert col(spark, S.parse_date, "20240102", "2024-1-2", "2024/01/02", "x", "", None, "20241301") == [D("2024-01-02")] * 3 + [None] * 4
    assert col(spark, S.normalize_symbol, "600000.sse", "000001.XSHE", "300001", "900001", "AAPL") == ["600000.SH", "000001.SZ", "300001.SZ", "900001.SH", "AAPL"]
    assert col(spark, S.board, "300001.SZ", "002001.SZ", "688001.SH", "430047.BJ", "600000", "700000.SH") == ["chi_next", "sme", "star", "beijing", "", "other"]
    assert col(spark, S.clean_number, "1,234.5", "nan", "inf", "N/A", " 2 ", "x") == [1234.5, None, None, None, 2.0, None]
    assert col(spark, S.decimal_text, *map(decimal.Decimal, ("1.50", "100", "0.000", "-0.25")), kind="decimal(38,12)") == ["1.5", "100", "0", "-0.25"]
    assert col(spark, S.accepted_local, "20231103183001", "2024-05-01T20:00:00-04:00", "2024-05-01T20:00:00Z", "2024-05-01T20:00:00", "") == ["2023-11-03T18:30:01-04:00", "2024-05-01T20:00:00-04:00", "2024-05-01T20:00:00+00:00", None, None]
    assert col(spark, S.cik, "320193", "x", "12345678901") == ["0000320193", None, None]
    assert col(spark, S.five_minute_time, "20260904093500000") == [dt.datetime(2026, 9, 4, 9, 35)]
    assert col(spark, S.flag, "1", "False", "", "maybe") == [True, False, False, None]
    assert col(spark, S.percent_to_decimal, "0.5", "", "x") == [decimal.Decimal("0.00500000"), None, None]
    assert col(spark, S.to_provider_code, "000001.SZ") == ["sz.000001"] and col(spark, S.from_provider_code, "sh.1") == ["000001.SH"]
    chunks = spark.range(1).select(S.date_chunks(F.lit(D("2024-01-01")), F.lit(D("2024-01-10")), 4).alias("c")).first().c
    assert [(c.start.day, c.end.day) for c in chunks] == [(1, 4), (5, 8), (9, 10)]


def test_period_class_at_300_days(spark):
    rows = spark.createDataFrame([(D("2024-01-01"), D("2024-10-26"), "10-Q", "Q3"), (D("2024-01-01"), D("2024-10-26"), "10-K", "FY"), (None, D("2024-10-26"), "10-K", "FY"), (D("2024-01-01"), D("2024-05-10"), "10-Q", "Q1")], "s date, e date, f string, p string")
    assert [r[0] for r in rows.select(S.period_class("s", "e", "f", "p")).collect()] == ["nine_month_ytd", "annual", "instant", "ambiguous"]


def test_calendar_rollups(spark):
    row = lambda d, v, vol: ("a", D(d), float(v), float(v + 2), float(v - 1), float(v + 1), float(vol), float(vol * 100))
    df = spark.createDataFrame([row(f"2024-01-0{i}", 100 + i, i) for i in range(1, 7)], "symbol string, date date, open double, high double, low double, close double, volume double, amount double")
    got = bars.calendar_rollup(df, "5d").orderBy("date").collect()
    assert len(got) == 2 and (got[0].date, got[0].open, got[0].high, got[0].low, got[0].close, got[0].volume) == (D("2024-01-05"), 101, 107, 100, 106, 15)
    df = spark.createDataFrame([row(d, 1, 1) for d in ("2024-01-05", "2024-01-08", "2024-01-31", "2024-02-01")], df.schema)
    assert sorted(r.date for r in bars.calendar_rollup(df, "1w").collect()) == [D("2024-01-05"), D("2024-01-08"), D("2024-02-01")]
    assert sorted(r.date for r in bars.calendar_rollup(df, "1mo").collect()) == [D("2024-01-31"), D("2024-02-01")]


def test_drawdown(spark):
    rows = [("stock", "T", D(f"2024-01-0{i}"), c, c, s) for i, (c, s) in enumerate([(400.0, 1.0), (100.0, 4.0), (80.0, 1.0)], 1)]
    df = spark.createDataFrame(rows, "asset_type string, symbol string, date date, close double, adj_close double, split_factor double")
    r = returns.drawdowns(df).first()
    assert (r.ath, r.drawdown, r.sessions_since_ath) == (100.0, -0.2, 1)


FILINGS = {"q1": ("2024-05-01", "10-Q"), "q2": ("2024-08-01", "10-Q"), "q3": ("2024-11-01", "10-Q"), "fy": ("2025-02-01", "10-K"), "q1a": ("2024-06-01", "10-Q/A")}


def scenario(spark, amended=False, third=True):
    rows = []

    def fact(tag, value, start, end, accession, period, unit="USD"):
        available, form = FILINGS[accession]
        rows.append(("T", f"r{len(rows):03d}", "us-gaap", tag, unit, D(start) if start else None, D(end), decimal.Decimal(value), D(available), f"{available}T10:00:00-04:00", form, "2024", period, accession, "2025-03-01"))

    r, o, n = "RevenueFromContractWithCustomerExcludingAssessedTax", "OperatingIncomeLoss", "NetIncomeLoss"
    y, q1, q2, q3, fy = "2024-01-01", "2024-03-31", "2024-06-30", "2024-09-30", "2024-12-31"
    for args in [(r, 40, y, q1, "q1", "Q1"), ("Revenues", 41, y, q1, "q1", "Q1"), (r, 60, "2024-04-01", q2, "q2", "Q2"), (r, 100, y, q2, "q2", "Q2"), (r, 999, "2024-04-01", q2, "q2", "Q2", "USD/shares"), (r, 250, y, fy, "fy", "FY")]:
        fact(*args)
    for args in [(o, 10, y, q1, "q1", "Q1"), (o, 25, y, q2, "q2", "Q2"), (o, 70, y, fy, "fy", "FY"), (n, -2, y, q1, "q1", "Q1"), (n, 3, "2024-04-01", q2, "q2", "Q2"), (n, 20, y, fy, "fy", "FY")]:
        fact(*args)
    if third:
        for args in [(r, 70, "2024-07-01", q3, "q3", "Q3"), (r, 170, y, q3, "q3", "Q3"), (o, 45, y, q3, "q3", "Q3"), (n, 7, "2024-07-01", q3, "q3", "Q3")]:
            fact(*args)
    fact("NetCashProvidedByUsedInOperatingActivities", -3, y, q1, "q1", "Q1")
    fact("PaymentsToAcquirePropertyPlantAndEquipment", -5, y, q1, "q1", "Q1")
    for args in [("Assets", 1000, None, q2, "q2", "Q2"), ("Assets", 1200, None, fy, "fy", "FY"), ("StockholdersEquity", -10, None, q2, "q2", "Q2"), ("LongTermDebtAndFinanceLeaseObligations", 200, None, q2, "q2", "Q2")]:
        fact(*args)
    if amended:
        fact(r, 42, y, q1, "q1a", "Q1")
    facts = spark.createDataFrame(rows, "symbol string, row_id string, taxonomy string, tag string, unit string, start_date date, end_date date, value decimal(38,12), available_date date, accepted_at string, form string, fiscal_year string, fiscal_period string, accession string, retrieved_at string")
    return facts, spark.createDataFrame([("T", a) for a in FILINGS], "symbol string, accession string")


def test_standardized_scenario(spark):
    rows = financials.standardize(*scenario(spark)).cache()
    got = {(r.period_type, r.fiscal_period): r for r in financials.values(rows).collect()}
    q1, q2, q3, q4 = (got["quarterly", f"Q{i}"] for i in (1, 2, 3, 4))
    assert (q1.revenue, q1.capital_expenditure, q1.free_cash_flow) == (40, 5, -8) and "conflicting_candidate_tags" in q1.quality_flags
    assert (q2.revenue, q2.operating_income) == (60, 15) and {"quarter_derived_from_ytd", "negative_equity"} <= set(q2.quality_flags)
    assert q3.operating_income == 20 and q2.debt_to_assets == decimal.Decimal("0.2")
    assert (q4.revenue, q4.operating_income, q4.available_date) == (80, 25, D("2025-02-01")) and "q4_derived_from_fy" in q4.quality_flags
    ttm = got["ttm", "Q4"]
    assert ttm.revenue == 250 and got["annual", "FY"].total_assets == 1200
    p = financials.provenance(rows).filter("period_type = 'ttm' and metric = 'revenue'").first()
    assert p.calculation == "sum_four_quarters" and len(p.component_periods) == 4
    assert set(q1.quality_flags) | set(q2.quality_flags) <= set(concepts.QUALITY_FLAGS)


def test_amendment_and_missing_quarter(spark):
    got = financials.values(financials.standardize(*scenario(spark, amended=True, third=False))).cache()
    assert got.filter("period_type = 'ttm'").count() == 0
    first = got.filter("period_type = 'quarterly'").select("symbol", "report_period", "available_date", "accepted_at", "accession", "revenue")
    early = pit.latest_as_of(first.filter("report_period = '2024-03-31'"), "2024-05-15").first()
    late = pit.latest_as_of(first.filter("report_period = '2024-03-31'"), "2024-06-15").first()
    assert (early.revenue, late.revenue, late.stale) == (40, 42, False)


def test_sec_payloads(spark):
    names = ["accessionNumber", "filingDate", "reportDate", "acceptanceDateTime", "form", "primaryDocument", "isXBRL", "isInlineXBRL"]
    recent = {n: v for n, v in zip(names, [["a1", "a2"], ["2023-11-03", "2023-11-04"], ["2023-09-30", ""], ["20231103183001", "2023-11-04T20:00:00-04:00"], ["10-K", "4"], ["x", "y"], ["1", "0"], ["1", "0"]])}
    old = recent | {"acceptanceDateTime": ["", ""], "form": ["10-K", "8-K"]}
    pay = spark.createDataFrame([("T", "1", 0, False, json.dumps(old), "t0"), ("T", "1", 1, True, json.dumps({"filings": {"recent": recent}}), "t0"), ("U", "2", 1, False, json.dumps(recent | {"form": ["10-K"]}), "t0")], "symbol string, cik string, sequence int, recent boolean, json string, retrieved_at string")
    rows = sec.filings(pay).cache()
    good = {r.accession: r for r in rows.filter("reject is null and symbol = 'T'").collect()}
    assert good["a1"].accepted_at == "2023-11-03T18:30:01-04:00" and good["a2"].form == "8-K"
    assert rows.filter("symbol = 'U'").first().reject == "unequal_lengths"
    fact = {"end": "2023-09-30", "start": "2022-10-01", "accn": "a1", "fy": 2023, "fp": "FY", "form": "10-K", "filed": "2023-11-03", "frame": "CY2023"}
    text = json.dumps({"cik": 1, "entityName": "T", "facts": {"us-gaap": {"Revenues": {"label": "R", "description": "d", "units": {"USD": ["V1", "V2"]}}}}}).replace('"V1"', json.dumps(fact | {"val": 0}).replace('"val": 0', '"val": 255000000000.00000001')).replace('"V2"', json.dumps(fact | {"val": 7, "form": "4"}))
    facts = sec.facts(spark.createDataFrame([("T", "1", text, "t1")], "symbol string, cik string, json string, retrieved_at string"), rows.filter("reject is null")).cache()
    (one,) = facts.collect()
    assert one.value == decimal.Decimal("255000000000.000000010000") and one.available_date == D("2023-11-03") and len(one.row_id) == 64
    again = sec.merge_facts(facts, facts.withColumn("retrieved_at", F.lit("t2")))
    assert [(r.retrieved_at, r.row_id) for r in again.collect()] == [("t1", one.row_id)]
    assert sec.validate_facts(facts, rows).count() == 0
    assert {r.check for r in sec.validate_facts(facts.withColumn("value", F.lit(1).cast("decimal(38,12)")), rows.filter("false")).collect()} == {"row_id", "unlinked_accession"}
    assert sec.validate_filings(rows.filter("reject is null")).filter("check <> 'accepted_without_offset'").count() == 0


def profile(spark, rows):
    base = dict(board="main", volume=100.0, volume_unit="share", amount=1000.0, trade_status=1, is_st=0, adjust="qfq", source="t")
    full = []
    for r in rows:
        x = dict.fromkeys(schemas.names(schemas.PROFILE)) | base | dict(open=10.0, high=10.0, low=10.0, close=10.0, preclose=10.0) | r
        full.append(tuple(x[n] for n in schemas.names(schemas.PROFILE)))
    return spark.createDataFrame(full, schemas.PROFILE)


def test_snapshots(spark, tmp_path):
    days = [D("2026-07-20"), D("2026-07-21")]
    rows = [dict(date=d, symbol=s, exchange=s[-2:]) for d in days for s in ("000001.SZ", "600000.SH")]
    good = profile(spark, rows)
    assert snapshot.violations(good).count() == 0
    path = str(tmp_path)
    first = snapshot.publish(good, path, ["SZ", "SH"])
    assert snapshot.publish(good.orderBy(F.desc("symbol")), path, ["SZ", "SH"]) == first
    assert snapshot.resolve(spark, path).count() == 4 and snapshot.verify(spark, path, first).count() == 0
    address = snapshot.listed(spark, path, first)[1].filter("exchange = 'SZ' AND date = '2026-07-20'").first()["address"]
    good.filter("exchange = 'SZ' AND date = '2026-07-20'").withColumn("close", F.lit(9.0)).write.mode("append").parquet(f"{path}/parts/address={address}")
    assert snapshot.verify(spark, path, first).count() == 1
    bad = profile(spark, [rows[0] | dict(adjust="raw"), rows[1] | dict(low=11.0), rows[2] | dict(open=None), rows[3] | dict(symbol="x")])
    assert {r.rule for r in snapshot.violations(bad).collect()} >= {"adjust", "envelope", "missing_price", "symbol"}
    with pytest.raises(snapshot.Blocked):
        snapshot.publish(bad, path, ["SZ", "SH"])
    with pytest.raises(snapshot.Blocked):
        snapshot.publish(good.filter("exchange = 'SZ'"), path, ["SZ", "SH"])
    with pytest.raises(snapshot.Blocked):
        snapshot.latest_dates(good, ["SZ", "SH"], 3)


def test_suspended_rows_are_repaired(spark):
    none = dict(open=None, high=None, low=None, close=None, preclose=None, trade_status=0, volume=None, amount=None, exchange="SZ")
    rows = profile(spark, [dict(date=D("2026-07-20"), symbol="000001.SZ", exchange="SZ", close=12.0), none | dict(date=D("2026-07-21"), symbol="000001.SZ"), none | dict(date=D("2026-07-21"), symbol="000002.SZ")])
    got = {r.symbol: r for r in snapshot.repair_suspended(rows).filter("date = '2026-07-21'").collect()}
    assert (got["000001.SZ"].open, got["000001.SZ"].preclose, got["000001.SZ"].backfill) == (0.0, 12.0, "prior_price")
    assert got["000002.SZ"].backfill == "no_prior_price"


def test_health(spark):
    rows = profile(spark, [dict(date=D("2026-07-20"), symbol="000001.SZ", exchange="SZ"), dict(date=D("2026-07-20"), symbol="000001.SZ", exchange="SZ", low=None)])
    h = quality.partition_health(rows, ["date", "gone"]).first()
    assert (h.rows, h.duplicates, h.nonpositive_rows, h.missing_columns) == (2, 1, 1, ["gone"])
    counts = spark.createDataFrame([("SZ", D("2026-07-20"), 100), ("SZ", D("2026-07-21"), 50)], "exchange string, date date, rows long")
    assert {r.date.day: (r.row_floor, r.low_rows) for r in quality.row_floor(counts).collect()} == {20: (80, False), 21: (80, True)}


def test_merges(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, v int, seen string")
    new = spark.createDataFrame([("b", 2, "z", True), ("c", 3, "z", False)], "k string, v int, seen string, more boolean")
    got = {r.k: (r.v, r.seen, r.more) for r in merge.upsert_keep_first_seen(old, new, ["k"], "seen").collect()}
    assert got == {"a": (1, "x", None), "b": (2, "y", True), "c": (3, "z", False)}
    assert merge.upsert(old.filter("false"), new.select("k", "v", "seen").filter("false"), ["k"]).count() == 0
    with pytest.raises(merge.InvalidKeys):
        merge.strict_upsert(old.unionByName(old), new, ["k"])
    bars_ = lambda rows: spark.createDataFrame([("stock", "T", D(d), c, div, s) for d, c, div, s in rows], "asset_type string, symbol string, date date, close double, dividend double, split_factor double")
    a, b = bars_([("2024-01-01", 1.0, 0.0, 1.0)]), bars_([("2024-01-02", 2.0, 0.5, 1.0)])
    assert merge.changed_actions(a, b).count() == 1 and merge.changed_actions(b, b).count() == 0
    merged, waiting = merge.incremental_us(a, b, bars_([("2024-01-01", 0.9, 0.0, 1.0), ("2024-01-02", 2.0, 0.5, 1.0)]))
    assert merged.count() == 2 and waiting.count() == 0
    assert merge.incremental_us(a, b, a.filter("false"))[1].count() == 1


def test_statements(spark):
    part = lambda **x: spark.createDataFrame([("sz.000001", 2024, 1, x.pop("pub", "2024-04-30"), "2024-03-31", *x.values())], "code string, year int, quarter int, pubDate string, statDate string, " + ", ".join(f"{k} string" for k in x))
    profit, balance, cash = part(MBRevenue="10", netProfit="1", roeAvg="0.5", gpMargin="1"), part(liabilityToAsset="5"), part(CFOToOR="")
    good, bad = reference.aligned_statements(profit, balance, cash)
    (r,) = reference.statements(good).collect()
    assert (r.roe, r.gross_margin, r.debt_to_assets, r.announce_date) == (decimal.Decimal("0.005"), decimal.Decimal("0.01"), decimal.Decimal("0.05"), D("2024-04-30")) and bad.count() == 0
    assert reference.statement_errors(reference.statements(good)).count() == 0
    assert [x.reason for x in reference.aligned_statements(profit, part(pub="2024-05-01", liabilityToAsset="5"), cash)[1].collect()] == ["pub_date_mismatch"]
    assert [x.reason for x in reference.aligned_statements(profit, balance.filter("false"), cash)[1].collect()] == ["partial"]


def test_reference_rows(spark):
    days = spark.createDataFrame([("2024-01-02", "1"), ("2024-01-01", "0"), ("x", "1"), ("2024-01-03", "2")], "calendar_date string, is_trading_day string")
    assert [r.reject for r in reference.calendar(days, "cn", "t", "now").collect()] == [None, None, "bad_date", "bad_flag"]
    with pytest.raises(pit.NothingVisible):
        pit.select_snapshot(spark.createDataFrame([(D("2024-02-01"), "a")], "observed_date date, symbol string"), "2024-01-01")
    good, bad = reference.us_universe(spark.createDataFrame([("aapl", "stock", "", "1"), ("BRK.B", "stock", "", "true"), ("X", "bond", "", "1"), ("spy", "etf", "", "0")], "symbol string, asset_type string, provider_symbol string, enabled string"))
    assert sorted((r.symbol, r.provider_symbol) for r in good.collect()) == [("AAPL", "AAPL"), ("BRK.B", "BRK-B")]
    assert {r.reason for r in bad.collect()} == {"invalid_asset_type", "disabled"}


def vendor(symbol, minutes):
    n = len(minutes)
    t = pa.table({"ts_code": [symbol] * n, "freq": ["1min"] * n, "trade_time": pa.array(minutes, pa.timestamp("ms", "UTC")), **{c: [1.0] * n for c in ("open", "close", "high", "low", "amount")}, "vol": [1] * n})
    out = io.BytesIO()
    pq.write_table(t, out)
    return out.getvalue()


def test_archives(spark, tmp_path):
    times = [dt.datetime(2010, 1, d, 9, 31, tzinfo=dt.timezone.utc) for d in (4, 5)]
    (tmp_path / "2010").mkdir()
    name = tmp_path / "2010" / "A股1分钟历史行情_2010.zip"
    with zipfile.ZipFile(name, "w") as z:
        for s in ("600519.SH", "000001.SZ"):
            z.writestr(f"2010/1分钟/{s}.parquet", vendor(s, times))
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("2010/600001.SH.parquet", vendor("600001.SH", times))
        z.writestr("2011/600001.SH.parquet", vendor("600001.SH", times))
    gone = tmp_path / "delisted.zip"
    with zipfile.ZipFile(gone, "w") as z:
        z.writestr("600001.SH.zip", inner.getvalue())
    found = archive.files(spark, str(tmp_path))
    assert [(r.frequency, r.year, r.month) for r in found.collect()] == [(1, 2010, None)]
    rows = archive.read_year(spark, str(tmp_path), 2010, 1, ["600519.SH"], "2010-01-05", "2010-12-31")
    assert [(r.member, r.ts_code) for r in rows.collect()] == [("600519.SH", "600519.SH")]
    with pytest.raises(KeyError):
        archive.read_year(spark, str(tmp_path), 2010, 1, ["600000.SH"])
    assert archive.read(spark, [str(gone)], nested=True, year=2010).count() == 2
    inv = archive.inventory(spark, [str(name)], deep=True).first()
    assert (inv.parquet_members, inv.symbols, inv.bad_members, inv.problem) == (2, ["000001.SZ", "600519.SH"], [], None)
    assert {(r.frequency, r.layout) for r in archive.delivery(found, [1, 5], [2010]).collect()} == {(1, "annual"), (5, "missing")}


def test_company_files(spark, tmp_path):
    (tmp_path / "a_20240105.csv").write_text('Code;Open;High;Low;Close;Vol;Amt\n"600000";1;2;1;2;"1,000";5\nxx;1;2;1;2;"NU;LL";5\n')
    (tmp_path / "b.txt").write_text("date symbol open high low close volume amount\n2024/1/6 000001.SZE 1 1 1 1 1 1\n")
    (tmp_path / "c.dat").write_text("1,2,3\n")
    names = {"date": ["date"], "symbol": ["symbol", "code"], "exchange": ["market"], "open": ["open"], "high": ["high"], "low": ["low"], "close": ["close"], "volume": ["volume", "vol"], "amount": ["amount", "amt"]}
    good, bad = files.normalize_company(files.company_files(spark, str(tmp_path), names))
    assert sorted((r.symbol, r.exchange, r.date, r.volume) for r in good.collect()) == [("000001.SZ", "SZ", D("2024-01-06"), 1.0), ("600000.SH", "SH", D("2024-01-05"), 1000.0)]
    assert sorted(r.reject for r in bad.collect()) == ["no_header", "unknown_exchange"]


def test_text_scans_and_payloads(spark, tmp_path):
    rows = profile(spark, [dict(date=D("2026-07-20"), symbol="000001.SZ", exchange="SZ")])
    (tmp_path / "SZ" / "2026" / "07").mkdir(parents=True)
    text = rows.withColumn("date", S.compact_date("date")).toPandas().to_csv(index=False)
    (tmp_path / "SZ" / "2026" / "07" / "20260720.csv").write_text(text)
    (tmp_path / "SZ" / "2026" / "07" / "note.csv").write_text(text)
    back = files.profiles(spark, str(tmp_path), ["SZ"], "2026-07-01", "2026-07-31").collect()
    assert len(back) == 1 and back[0].close == 10.0 and back[0].date == D("2026-07-20")
    assert files.stale_headers(spark, str(tmp_path / "SZ/2026/07/20260720.csv"), ["close", "gone"]).first().missing == ["gone"]
    (tmp_path / "list.txt").write_text("symbol\n# no\n\nAAPL,x\nMSFT\n")
    assert [r.symbol for r in files.symbol_list(spark, str(tmp_path / "list.txt")).collect()] == ["AAPL", "MSFT"]
    cache = tmp_path / "cache"
    cache.mkdir()
    (cache / "a.csv").write_text("date,close\n2024-01-02,1\n\n2024-01-03,2\n")
    s = files.cache_statistics(spark, str(cache)).first()
    assert (s.files, s.rows, s.first_date, s.last_date) == (1, 2, D("2024-01-02"), D("2024-01-03"))
    (cache / "b.csv.gz").write_bytes(gzip.compress(b"date,open,close\n2023-01-02,1,2\n"))
    size = sum(f.stat().st_size for f in cache.iterdir())
    s = files.cache_statistics(spark, str(cache)).first()
    assert (s.files, s.rows, s.bytes, s.first_date) == (2, 3, size, D("2023-01-02")) and files.cache_statistics(spark, str(cache), 1).first().rows == 2
    assert [(r.path.rsplit("/", 1)[-1], r.missing) for r in files.stale_headers(spark, str(cache), ["date", "open"]).collect()] == [("a.csv", ["open"])]
    bar = {"date": "2024-01-02T00:00:00.000Z", **dict.fromkeys(files._TIINGO, 1.5)}
    pay = spark.createDataFrame([("T", "stock", json.dumps([bar, bar | {"close": None}]))], "symbol string, asset_type string, json string")
    assert [(r.date, r.reject) for r in files.tiingo(pay).collect()] == [(D("2024-01-02"), None), (D("2024-01-02"), "missing_number")]
    snap = spark.createDataFrame([(json.dumps({"tables": [{"thscode": "a", "time": ["t1", "t2"], "table": {"p": ["1"]}}]}),)], "json string")
    assert [(r.time, r.p) for r in files.snapshots(snap, ["p"]).collect()] == [("t1", "1"), ("t2", None)]
    provider = spark.createDataFrame([("2024-01-02", "sz.000001", *["1"] * 16), ("", "sz.000001", *["1"] * 16)], [*files.BAOSTOCK])
    (r,) = files.baostock(provider, "qfq").collect()
    assert (r.symbol, r.board, r.trade_status, r.volume_unit) == ("000001.SZ", "main", 1, "share")


def test_sinks(spark, tmp_path):
    rows = profile(spark, [dict(date=D("2026-07-20"), symbol="000001.SZ", exchange="SZ"), dict(date=D("2026-07-21"), symbol="000001.SZ", exchange="SZ")])
    path = str(tmp_path / "p")
    sinks.by_date(rows, path)
    sinks.by_date(rows.filter("date = '2026-07-21'").withColumn("close", F.lit(9.0)), path)
    assert sorted(r.close for r in spark.read.parquet(path).collect()) == [9.0, 10.0]
    build = str(tmp_path / "b")
    sinks.build({"one": rows, "two": rows.limit(1)}, build)
    assert sinks.read_build(spark, build, "two").count() == 1
    out = spark.createDataFrame([("a", "fetched", None), ("b", "failed", "x")], "item string, status string, error string")
    m = sinks.run_manifest(out, "r").first()
    assert (m.status, m.failed) == ("completed_with_failures", 1) and sinks.run_manifest(out.filter("false"), "r").first().status == "completed_empty"
    sinks.by_suffix(rows, str(tmp_path / "x.csv.gz"))
    assert spark.read.option("header", True).csv(str(tmp_path / "x.csv.gz")).count() == 2
    bars = spark.range(70_000).select(F.lit(1).alias("frequency"), F.lit("sz").alias("exchange"), F.lit(D("2026-07-20")).alias("trade_date"), F.col("id").cast("string").alias("symbol"), F.lit("t").alias("trade_time"))
    sinks.minutes(bars, str(tmp_path / "m"))
    (file,) = (tmp_path / "m").rglob("*.parquet")
    assert [pq.ParquetFile(file).metadata.row_group(i).num_rows for i in range(2)] == [65_536, 70_000 - 65_536]
    tree = tmp_path / "tree"
    (tree / "SZ").mkdir(parents=True)
    (tree / "SZ" / "a b.csv").write_text("z\n\na\n")
    (tree / "c.csv").write_text("one")
    sinks.recompress(spark, str(tree), str(tmp_path / "packed"))
    packed = spark.read.text(str(tmp_path / "packed")).groupBy("file").agg(F.collect_list("value").alias("lines"))
    assert {r.file: r.lines for r in packed.collect()} == {"SZ/a b.csv": ["z", "", "a"], "c.csv": ["one"]}


def test_search(spark):
    rows = spark.createDataFrame([("us", "AAPL", "Apple"), ("cn", "000001.SZ", "Apex"), ("us", "XAP", "Other")], "market string, symbol string, name string")
    assert [r.symbol for r in search.search(rows, "ap").collect()] == ["000001.SZ", "AAPL", "XAP"]
    assert [r.symbol for r in search.search(rows).collect()] == ["AAPL", "XAP", "000001.SZ"]
    facts = spark.createDataFrame([("AAPL",)], "symbol string")
    assert {r.symbol for r in search.with_fundamentals(rows, facts, facts).filter("has_fundamentals").collect()} == {"AAPL"}


def test_minute_tree_reads_and_product_orders(spark, tmp_path):
    times = [dt.datetime(2024, 12, 31, 9, 31), dt.datetime(2024, 12, 31, 9, 32), dt.datetime(2025, 1, 2, 9, 31), dt.datetime(2025, 1, 2, 9, 32)]
    rows = spark.createDataFrame([(1, "sz", t.date(), s, t, float(i)) for s in ("000001.SZ", "000002.SZ") for i, t in enumerate(times)], "frequency int, exchange string, trade_date date, symbol string, trade_time timestamp, close double")
    path = str(tmp_path / "m")
    sinks.minutes(rows, path)
    newest = lambda n: [r.trade_time for r in files.newest_minutes(spark, path, "000001.sz", 1, n).collect()]
    assert newest(1) == times[:2:-1] and newest(3) == times[:0:-1] and newest(100) == times[::-1] and files.newest_minutes(spark, path, "999999.SZ", 1, 2).count() == 0
    placed = files.placed_minutes(spark, path).collect()
    assert all((r.path_parts.frequency, r.path_parts.exchange, r.path_parts.trade_date) == (1, "sz", r.trade_time.date()) for r in placed)
    by_place = sorted((r.file, r.place, r.symbol, r.trade_time) for r in placed)
    assert [x[2:] for x in by_place[:4]] == sorted(x[2:] for x in by_place[:4])
    assert files.read_minutes(spark, path, 1, "2024-01-01", "2025-12-31", limit=2).first().trade_time == times[-1]
    (tmp_path / "one.bin").write_bytes(b"abc")
    assert files.digests(spark, str(tmp_path / "one.bin")).first().sha256 == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    filings = spark.createDataFrame([("b", "", "2024-01-02"), ("a", "2024-01-01T10:00:00Z", "2024-01-01"), ("c", None, "2023-12-31")], "accession string, accepted_at string, filing_date string").coalesce(1)
    assert [r.accession for r in sinks.ordered(filings, "filings").collect()] == ["c", "a", "b"]
    keys = spark.createDataFrame([("s", "2024", "ttm", "2", "x"), ("s", "2024", "annual", "2", "x"), ("s", "2023", "ttm", "1", "x")], "symbol string, report_period string, period_type string, available_date string, accession string").coalesce(1)
    assert [(r.report_period, r.period_type) for r in sinks.ordered(keys, "standardized").collect()] == [("2023", "ttm"), ("2024", "annual"), ("2024", "ttm")]


def test_daily_update_replaces_touched_partitions(spark):
    row = lambda d, s, c: ("SZ", D(d), s, c, "qfq")
    kind = "exchange string, date date, symbol string, close double, adjust string"
    old = spark.createDataFrame([row("2026-07-01", "a", 1.0), row("2026-07-20", "a", 1.0), row("2026-07-20", "gone", 1.0)], kind)
    new = spark.createDataFrame([row("2026-07-01", "a", 9.0), row("2026-07-20", "a", 2.0), row("2026-07-21", "a", 3.0), row("2026-08-21", "a", 4.0)], kind)
    profile, history, touched = merge.update_daily(old, old, new, "2026-07-31", 5, "2020-01-01")
    at = lambda df: sorted((str(r.date), r.symbol, r.close) for r in df.collect())
    assert at(profile) == [("2026-07-01", "a", 1.0), ("2026-07-20", "a", 2.0), ("2026-07-21", "a", 3.0)]
    assert at(history) == [("2026-07-01", "a", 1.0), ("2026-07-20", "a", 2.0), ("2026-07-20", "gone", 1.0), ("2026-07-21", "a", 3.0)]
    assert sorted(str(r.date) for r in touched.collect()) == ["2026-07-20", "2026-07-21"]
