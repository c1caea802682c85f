"""Archive members by their index: what is opened, how large an archive may be, and two writers of one log."""

import io
import json
import threading
import zipfile

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql.datasource import EqualTo

from marketweave.sources import archive, commits, members


def bars(symbol, day="2010-01-04", n=6, price=10.0):
    times = pd.date_range(f"{day} 09:30", periods=n, freq="min", tz="Asia/Shanghai")
    frame = pd.DataFrame({"ts_code": symbol, "freq": "1min", "trade_time": times, "open": price, "close": price, "high": price, "low": price, "vol": range(n), "amount": 1.0})
    out = io.BytesIO()
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=False), out, row_group_size=3)
    return out.getvalue()


def packed(entries, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in entries.items():
            z.writestr(name, data)
    return out.getvalue()


def spoil(data, needle):
    """An archive in which the packed bytes of one member are wrong."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        at = z.getinfo(needle).header_offset + 30 + len(needle.encode()) + 4
    out = bytearray(data)
    out[at : at + 8] = b"\xff" * 8
    return bytes(out)


@pytest.fixture
def shanghai(spark):
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", was)


def put(root, year, period, data):
    (root / str(year)).mkdir(parents=True, exist_ok=True)
    (root / str(year) / f"A股1分钟历史行情_{period}.zip").write_bytes(data)


def test_only_the_members_asked_for_are_read(shanghai, tmp_path):
    entries = {f"2010/1分钟/{s}.parquet": bars(s) for s in ("600519.SH", "000001.SZ", "600000.SH")}
    put(tmp_path / "in", 2010, "2010", spoil(packed(entries), "2010/1分钟/000001.SZ.parquet"))
    index = members.settle_index(shanghai, archive.files(shanghai, str(tmp_path / "in")), str(tmp_path / "index"))
    assert sorted(r.symbol for r in index.collect()) == ["000001.SZ", "600000.SH", "600519.SH"]
    one = members.read_year(shanghai, str(tmp_path / "index"), 2010, 1, ["600519.sh"])
    assert [(r.member, r.ts_code, r.vol) for r in one.orderBy("vol").collect()] == [("600519.SH", "600519.SH", i) for i in range(6)]
    assert one.rdd.getNumPartitions() == 1
    with pytest.raises(Exception, match="size and checksum|decompress"):
        members.read_year(shanghai, str(tmp_path / "index"), 2010, 1).count()
    with pytest.raises(KeyError):
        members.read_year(shanghai, str(tmp_path / "index"), 2010, 1, ["999999.SH"])
    with pytest.raises(members.ArchiveError):
        members.read_year(shanghai, str(tmp_path / "index"), 2011, 1)


def test_rows_equal_those_of_whole_archives(shanghai, tmp_path):
    for month, day in (("201001", "2010-01-04"), ("201002", "2010-02-01"), ("201003", "2010-03-01")):
        put(tmp_path / "in", 2010, month, packed({f"{s}.parquet": bars(s, day) for s in ("600519.SH", "000001.SZ")}, zipfile.ZIP_STORED))
    members.settle_index(shanghai, archive.files(shanghai, str(tmp_path / "in")), str(tmp_path / "index"))
    for args in ({}, {"start": "2010-02-01"}, {"start": "2010-01-31", "end": "2010-02-28"}, {"symbols": ["000001.SZ"], "end": "2010-01-04"}):
        want = archive.read_year(shanghai, str(tmp_path / "in"), 2010, 1, **args)
        got = members.read_year(shanghai, str(tmp_path / "index"), 2010, 1, **args)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), args
    some = members.read_year(shanghai, str(tmp_path / "index"), 2010, 1, columns=["trade_time", "close"])
    assert some.columns == ["trade_time", "close"] and some.count() == 36


def test_months_outside_are_not_opened(shanghai, tmp_path):
    put(tmp_path / "in", 2010, "201001", spoil(packed({"600519.SH.parquet": bars("600519.SH")}), "600519.SH.parquet"))
    put(tmp_path / "in", 2010, "201002", packed({"600519.SH.parquet": bars("600519.SH", "2010-02-01")}))
    members.settle_index(shanghai, archive.files(shanghai, str(tmp_path / "in")), str(tmp_path / "index"))
    assert members.read_year(shanghai, str(tmp_path / "index"), 2010, 1, start="2010-02-01").count() == 6


def test_nested_archives(shanghai, tmp_path):
    inner = {s: packed({f"{y}/{s}.parquet": bars(s, f"{y}-01-04", price=float(y)) for y in (2010, 2011)}) for s in ("600001.SH", "000003.SZ")}
    put(tmp_path / "in", 2012, "2012", spoil(packed({f"{s}.zip": d for s, d in inner.items()}), "000003.SZ.zip"))
    members.settle_index(shanghai, archive.files(shanghai, str(tmp_path / "in")), str(tmp_path / "index"))
    path = [r.path for r in archive.files(shanghai, str(tmp_path / "in")).collect()]
    rows = members.read(shanghai, str(tmp_path / "index"), path, member_year=2011).filter("member = '600001.SH'")
    assert {(r.member, r.open) for r in rows.collect()} == {("600001.SH", 2011.0)} and rows.count() == 6


def test_an_archive_of_more_than_two_gigabytes(shanghai, tmp_path):
    """The file has a hole before the archive, so it takes no disk; the bytes read are counted."""
    data = packed({f"{s}.parquet": bars(s) for s in ("600519.SH", "000001.SZ")})
    put(tmp_path / "in", 2010, "2010", b"")
    name = tmp_path / "in/2010/A股1分钟历史行情_2010.zip"
    with name.open("wb") as f:
        f.seek((2 << 30) + 12345)
        f.write(data)
    index = members.settle_index(shanghai, archive.files(shanghai, str(tmp_path / "in")), str(tmp_path / "index"))
    assert index.first().archive_bytes > 2 << 30
    assert members.read_year(shanghai, str(tmp_path / "index"), 2010, 1, ["600519.SH"]).count() == 6

    class Counted(io.FileIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            Counted.taken += len(out)
            return out

    members.directory(Counted(str(name)))
    assert 0 < Counted.taken < 1000


def test_the_index_follows_the_archives(shanghai, tmp_path, monkeypatch):
    put(tmp_path / "in", 2010, "201001", packed({"600519.SH.parquet": bars("600519.SH")}))
    put(tmp_path / "in", 2010, "201002", packed({"600519.SH.parquet": bars("600519.SH", "2010-02-01")}))
    listed = lambda: archive.files(shanghai, str(tmp_path / "in"))
    members.settle_index(shanghai, listed(), str(tmp_path / "index"))
    put(tmp_path / "in", 2010, "201002", packed({"600519.SH.parquet": bars("600519.SH", "2010-02-01"), "000001.SZ.parquet": bars("000001.SZ", "2010-02-01")}))
    put(tmp_path / "in", 2010, "201003", packed({"600519.SH.parquet": bars("600519.SH", "2010-03-01")}))
    # an archive that has not changed is not read again: its bytes may be gone
    first = tmp_path / "in/2010/A股1分钟历史行情_201001.zip"
    first.write_bytes(b"x" * first.stat().st_size)
    got = members.settle_index(shanghai, listed(), str(tmp_path / "index"))
    assert sorted((r.month, r.symbol) for r in got.collect()) == [(1, "600519.SH"), (2, "000001.SZ"), (2, "600519.SH"), (3, "600519.SH")]
    first.unlink()
    assert members.settle_index(shanghai, listed(), str(tmp_path / "index")).filter("month = 1").isEmpty()


def test_members_of_a_task_follow_their_bytes(shanghai, tmp_path):
    put(tmp_path / "in", 2010, "2010", packed({f"{i:06d}.SH.parquet": bars(f"{i:06d}.SH") for i in range(20)}))
    members.settle_index(shanghai, archive.files(shanghai, str(tmp_path / "in")), str(tmp_path / "index"))
    _, content = commits.last(shanghai, str(tmp_path / "index/_log"))
    path = [r.path for r in archive.files(shanghai, str(tmp_path / "in")).collect()]
    options = {"index": f"{tmp_path}/index/{content['version']}", "archives": json.dumps(path), "zone": "UTC", "task_bytes": "20000"}
    reader = members._Reader(options, list(members.COLUMNS))
    parts = reader.partitions()
    assert sum(len(p.entries) for p in parts) == 20 and all(sum(e["unpacked"] for e in p.entries) <= 20_000 for p in parts) and 1 < len(parts) < 20
    assert list(reader.pushFilters([EqualTo(("member",), "000007.SH")])) == []
    assert [[e["symbol"] for e in p.entries] for p in reader.partitions()] == [["000007.SH"]]


def test_writers_at_once_have_an_order(spark, tmp_path):
    folder, done = f"{tmp_path}/log", []

    def writer(name):
        for i in range(5):
            done.append((commits.commit(spark, folder, lambda n, was: {"by": name, "i": i, "after": (was or {}).get("by")}), name))

    threads = [threading.Thread(target=writer, args=(f"w{k}",)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(n for n, _ in done) == list(range(1, 21))
    content = [commits.read(spark, folder, n) for n in range(1, 21)]
    assert all(content[n - 1]["by"] == name for n, name in done)
    assert all(content[i]["after"] == content[i - 1]["by"] for i in range(1, 20))
    assert commits.names(spark, folder) == [f"{n:012d}.json" for n in range(1, 21)]
