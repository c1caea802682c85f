"""A minute tree, spoiled in one place after another, as its footers tell it."""

import datetime as dt
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketweave.sources import files, footers, sinks


@pytest.fixture
def tree(spark, tmp_path):
    times = [(s, f, dt.datetime(2024, 1, d, 9, 30 + m)) for s in ("600000.SH", "000001.SZ") for f in (1, 5) for d in (2, 3) for m in range(4)]
    rows = spark.createDataFrame([(s, f, t, 1.0, 2.0, 0.5, 1.5, 10, 5.0) for s, f, t in times], "symbol string, frequency int, trade_time timestamp, open double, high double, low double, close double, volume long, amount double")
    rows = rows.withColumn("exchange", F.lower(F.substring_index("symbol", ".", -1))).withColumn("trade_date", F.to_date("trade_time"))
    was = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    sinks.minutes(rows.select("frequency", "exchange", "trade_date", "symbol", "trade_time", "open", "high", "low", "close", "volume", "amount"), str(tmp_path / "tree"))
    spark.conf.set("spark.sql.parquet.outputTimestampType", was)
    return tmp_path / "tree"


def one_file(tree, part):
    return next((tree / part).glob("*.parquet"))


PART = "frequency=1/exchange=sh/trade_date=2024-01-02"


def checks(spark, tree, **options):
    return sorted((r.check, r.scope) for r in footers.findings(footers.scan(spark, str(tree)), str(tree), **options).collect())


def test_a_sound_tree_and_its_numbers(spark, tree):
    found = footers.scan(spark, str(tree))
    assert found.count() == 8 and {(r.rows, r.row_groups, r.most_rows, tuple(r.codecs), r.problem) for r in found.collect()} == {(4, 1, 4, ("zstd",), None)}
    assert footers.null_counts(found).agg(F.sum("nulls")).first()[0] == 0
    assert checks(spark, tree) == []
    assert [(r["rank"], r.files) for r in footers.drift(found).collect()] == [(1, 8)]


def test_no_row_is_read(spark, tree):
    """Pages are overwritten by zeros; footers tell the same."""
    for f in tree.rglob("*.parquet"):
        data = bytearray(f.read_bytes())
        end = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
        data[4:end] = bytes(end - 4)
        f.write_bytes(bytes(data))
    assert checks(spark, tree) == []


def spoil(tree, change, codec="zstd", **options):
    f = one_file(tree, PART)
    table = change(pq.ParquetFile(f).read())
    pq.write_table(table, f, compression=codec, **options)
    (f.parent / f".{f.name}.crc").unlink(missing_ok=True)


def set_column(name, values):
    return lambda t: t.set_column(t.schema.get_field_index(name), name, values(t))


CASES = {
    "null_value": lambda tree: spoil(tree, set_column("close", lambda t: pa.array([None, 1.0, 1.0, None], pa.float64()))),
    "schema_mismatch": lambda tree: spoil(tree, set_column("volume", lambda t: t["volume"].cast(pa.int32()))),
    "codec_mismatch": lambda tree: spoil(tree, lambda t: t, codec="snappy"),
    "empty_partition": lambda tree: spoil(tree, lambda t: t.slice(0, 0)),
    "nulls_unknown": lambda tree: spoil(tree, lambda t: t, write_statistics=["symbol", "trade_time", "open", "high", "low", "close", "amount"]),
    "unreadable_file": lambda tree: one_file(tree, PART).write_bytes(b"PAR1 not parquet"),
    "duplicate_partition": lambda tree: shutil.copy(one_file(tree, PART), tree / PART / "again.parquet"),
}


@pytest.mark.parametrize("check", CASES)
def test_one_fault(spark, tree, check):
    CASES[check](tree)
    assert checks(spark, tree) == [(check, PART)]


def test_paths_groups_and_facts(spark, tree):
    (tree / "frequency=1/exchange=sh/trade_date=someday").mkdir()
    shutil.copy(one_file(tree, PART), tree / "frequency=1/exchange=sh/trade_date=someday/a.parquet")
    assert checks(spark, tree) == [("partition_path", "frequency=1/exchange=sh/trade_date=someday")]
    assert {c for c, _ in checks(spark, tree, row_group=3)} == {"partition_path", "large_row_group"}
    shutil.rmtree(tree / "frequency=1/exchange=sh/trade_date=someday")
    spoil(tree, lambda t: t.replace_schema_metadata({"build_id": "b7"}))
    got = footers.findings(footers.scan(spark, str(tree)), str(tree), facts={"build_id": "b7"}).collect()
    assert len(got) == 7 and {r.check for r in got} == {"metadata_mismatch"} and {r.detail for r in got} == {"build_id=none expected b7"}


def test_drift_is_counted_by_schema(spark, tree):
    CASES["schema_mismatch"](tree)
    got = footers.drift(footers.scan(spark, str(tree))).orderBy("rank").collect()
    assert [r.files for r in got] == [7, 1] and got[1].example.endswith(one_file(tree, PART).name)


def test_strict_reads(spark, tree):
    CASES["null_value"](tree)
    read = lambda frequency, day: files.read_minutes(spark, str(tree), frequency, day, day, exchange="sh", strict=True)
    assert read(1, "2024-01-03").count() == 4 and read(5, "2024-01-02").count() == 4
    with pytest.raises(footers.Unsound, match="null_value"):
        read(1, "2024-01-02")
