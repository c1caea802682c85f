"""Snapshots as lists of partitions that are stored once, their manifests' validation, and two writers at once."""

import datetime as dt
import json
import shutil
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketweave import schemas
from marketweave.operators import snapshot
from marketweave.sources import commits, sinks


def profile(spark, days, close=10.0):
    base = dict.fromkeys(schemas.names(schemas.PROFILE)) | dict(board="main", volume=100.0, volume_unit="share", amount=1000.0, trade_status=1, is_st=0, adjust="qfq", source="t", open=10.0, high=20.0, low=1.0, preclose=10.0, close=close)
    rows = [base | dict(date=dt.date(2026, 7, d), symbol=s, exchange=s[-2:]) for d in days for s in ("000001.SZ", "600000.SH", "600001.SH")]
    return spark.createDataFrame([tuple(r[n] for n in schemas.names(schemas.PROFILE)) for r in rows], schemas.PROFILE)


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet") if "/parts/" in str(f)}


def test_a_new_day_writes_its_partitions_only(spark, tmp_path):
    path = str(tmp_path)
    first = snapshot.publish(profile(spark, [20, 21]), path, ["SZ", "SH"])
    before = files(path)
    assert len(before) == 4
    second = snapshot.publish(profile(spark, [20, 21, 22]), path, ["SZ", "SH"])
    after = files(path)
    assert len(after) == 6 and all(after[f] == t for f, t in before.items())
    assert snapshot.resolve(spark, path).count() == 9 and snapshot.resolve(spark, path, first).count() == 6
    assert [snapshot.verify(spark, path, s).count() for s in (first, second)] == [0, 0]
    # one day is corrected: its partitions are new, the others shared
    third = snapshot.publish(profile(spark, [20, 22]).unionByName(profile(spark, [21], close=11.0)), path, ["SZ", "SH"])
    assert len(files(path)) == 8 and len({first, second, third}) == 3
    assert snapshot.resolve(spark, path, second).filter("close = 11").count() == 0 and snapshot.resolve(spark, path).filter("close = 11").count() == 3
    # the same content again, whatever its order, adds nothing
    number = commits.last(spark, f"{path}/_log")[0]
    assert snapshot.publish(profile(spark, [21, 20]).orderBy(F.rand(1)), path, ["SZ", "SH"]) == first
    assert commits.last(spark, f"{path}/_log")[0] == number and len(files(path)) == 8
    assert commits.names(spark, f"{path}/staging") == []


def test_a_blocked_profile_leaves_nothing(spark, tmp_path):
    with pytest.raises(snapshot.Blocked):
        snapshot.publish(profile(spark, [20]).withColumn("adjust", F.lit("raw")), str(tmp_path), ["SZ", "SH"])
    assert files(tmp_path) == {} and commits.last(spark, f"{tmp_path}/_log") == (0, None)
    with pytest.raises(KeyError):
        snapshot.resolve(spark, str(tmp_path))


def test_manifests_are_validated(spark, tmp_path):
    path = str(tmp_path)
    first = snapshot.publish(profile(spark, [20, 21]), path, ["SZ", "SH"])
    checks = lambda: {(r.check, r.scope) for r in snapshot.validate_manifest(spark, path, first).collect()}
    assert checks() == set()
    parts = snapshot.listed(spark, path, first)[1]
    gone = parts.filter("exchange = 'SZ' AND date = '2026-07-21'").first()["address"]
    shutil.move(f"{path}/parts/address={gone}", f"{path}/elsewhere")
    assert checks() == {("missing_partition", "SZ/2026-07-21")}
    assert {(r.exchange, str(r.date)) for r in snapshot.verify(spark, path, first).collect()} == {("SZ", "2026-07-21")}
    shutil.move(f"{path}/elsewhere", f"{path}/parts/address={gone}")
    rows = [r.asDict() for r in parts.collect()]
    rewrite = lambda rows: spark.createDataFrame(rows, parts.schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/partitions/snapshot_id={first}")
    rewrite([r | {"rows": r["rows"] + 1} if r["address"] == gone else r for r in rows])
    assert checks() == {("snapshot_id", first), ("rows", first)}
    rewrite([r | {"address": "0" * 64} if r["address"] == gone else r for r in rows])
    assert checks() == {("address", "SZ/2026-07-21"), ("missing_partition", "SZ/2026-07-21")}
    rewrite([r for r in rows if r["address"] != gone])
    assert checks() == {("snapshot_id", first), ("rows", first), ("partitions", first), ("incomplete_date", "2026-07-21")}
    rewrite([*rows, rows[0]])
    assert ("duplicate_partition", f"{rows[0]['exchange']}/{rows[0]['date']}") in checks()
    rewrite(rows)
    log = Path(path) / "_log/000000000001.json"
    log.write_text(json.dumps(json.loads(log.read_text()) | {"as_of": "2026-01-01"}))
    (log.parent / f".{log.name}.crc").unlink(missing_ok=True)
    assert checks() == {("as_of", first)}


def test_two_writers_of_builds(spark, tmp_path):
    path, ids = str(tmp_path / "b"), []

    def write(n):
        ids.append(sinks.build({"t": spark.range(n), "u": spark.range(1)}, path))

    threads = [threading.Thread(target=write, args=(n,)) for n in (3, 5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert {sinks.read_build(spark, path, "t", k).count() for k in (1, 2)} == {3, 5} and len(set(ids)) == 2
    assert sinks.read_build(spark, path, "t").count() == sinks.read_build(spark, path, "t", 2).count()
    with pytest.raises(KeyError):
        sinks.read_build(spark, path, "v")
