"""Vendor archives: ZIPs of per-symbol Parquet members, nested ZIPs for delisted names, and their inventory.

Archives are listed by Spark and read whole on executors through the binaryFile source, so any store that Spark reads
will do, and an archive must be under 2 GB; a task opens the archives dealt to it one at a time and yields one member's
rows at a time.
"""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SCHEMA = [("member", pa.string()), ("ts_code", pa.string()), ("freq", pa.string()), ("trade_time", pa.timestamp("us", "UTC")), ("open", pa.float64()), ("close", pa.float64()), ("high", pa.float64()), ("low", pa.float64()), ("vol", pa.int64()), ("amount", pa.float64())]
_DDL = "member string, ts_code string, freq string, trade_time timestamp, open double, close double, high double, low double, vol long, amount double"
# Fixed value: names of the vendor's archives carry the frequency in minutes and a year or year and month.
NAME = r"(\d+)分钟.*?_(\d{4})(\d{2})?\.zip$"


class ArchiveError(ValueError):
    pass


def files(spark: SparkSession, root: str) -> DataFrame:
    """path, frequency, year, month (null: whole year) and bytes of the archives under ``root``."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(root).select("path", F.col("length").alias("bytes"))
    name = F.url_decode("path")
    part = lambda i: F.nullif(F.regexp_extract(name, NAME, i), F.lit("")).try_cast("int")
    return rows.select("path", "bytes", part(1).alias("frequency"), part(2).alias("year"), part(3).alias("month")).filter("frequency is not null and year is not null")


def chosen(archives: DataFrame, year: int, frequency: int) -> DataFrame:
    """The archive of the whole year, else the monthly ones in order. Two of one period raise ArchiveError."""
    rows = archives.filter((F.col("year") == year) & (F.col("frequency") == frequency))
    twice = rows.groupBy("month").agg(F.count("*").alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ArchiveError(f"more than one archive of {year}, month {twice.first()['month']}")
    whole = F.bool_or(F.col("month").isNull()).over(Window.partitionBy("year", "frequency"))
    return rows.withColumn("_whole", whole).filter(~F.col("_whole") | F.col("month").isNull()).drop("_whole").orderBy("month")


def _members(content: bytes, nested: bool, wanted: set[str] | None) -> Iterator[tuple[str, bytes]]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in sorted(z.namelist()):
            symbol = re.sub(r"\.(zip|parquet)$", "", name.rsplit("/", 1)[-1])
            if nested and name.endswith(".zip"):
                if wanted is None or symbol in wanted:
                    for inner, data in _members(z.read(name), False, None):
                        yield f"{symbol}/{inner}", data
            elif not nested and name.endswith(".parquet") and (wanted is None or symbol in wanted):
                yield name, z.read(name)


def read(spark: SparkSession, paths: list[str], symbols: list[str] | None = None, start=None, end=None, nested: bool = False, year: int | None = None) -> DataFrame:
    """Rows of the archives' members in the vendor's columns, with ``member``: the symbol that the archive says it is.

    Symbols, dates (inclusive, in the session time zone) and, in nested archives, the year are applied where a member is
    opened: its Parquet reader takes only the canonical columns and the row groups of the dates, so no other row leaves a
    task. Members without a required column raise.
    """
    wanted = {s.upper() for s in symbols} if symbols else None
    zone = spark.conf.get("spark.sql.session.timeZone")
    first = None if start is None else pd.Timestamp(start, tz=zone)
    behind = None if end is None else pd.Timestamp(end, tz=zone) + pd.Timedelta(days=1)

    def rows_of(name: str, data: bytes) -> pa.Table:
        file = pq.ParquetFile(io.BytesIO(data))
        have = {f.name: f.type for f in file.schema_arrow}
        if missing := {n for n, _ in _SCHEMA[1:]} - set(have):
            raise ArchiveError(f"{name}: missing columns {sorted(missing)}")
        kind = have["trade_time"]
        bound = lambda t: pa.scalar(t if getattr(kind, "tz", None) else t.tz_localize(None), kind)
        limits = [("trade_time", op, bound(t)) for op, t in ((">=", first), ("<", behind)) if t is not None]
        return pq.read_table(io.BytesIO(data), columns=[n for n, _ in _SCHEMA[1:]], filters=limits or None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for name, data in _members(content.as_py(), nested, wanted):
                    if nested and year is not None and f"/{year}/" not in f"/{name}":
                        continue
                    t = rows_of(name, data)
                    time = t["trade_time"]
                    time = pc.assume_timezone(time, zone) if time.type.tz is None else time
                    symbol = name.split("/", 1)[0] if nested else re.sub(r"\.parquet$", "", name.rsplit("/", 1)[-1])
                    columns = [pa.array([symbol] * t.num_rows, pa.string()), *[(time if n == "trade_time" else t[n]).cast(k) for n, k in _SCHEMA[1:]]]
                    yield from pa.table(columns, schema=pa.schema(_SCHEMA)).to_batches(max_chunksize=65_536)

    # Spark deals files out by size; an archive is one row of the source, so one task opens it where it is read
    return spark.read.format("binaryFile").load(paths).select("content").mapInArrow(run, _DDL)


def read_year(spark: SparkSession, root: str, year: int, frequency: int, symbols: list[str] | None = None, start=None, end=None) -> DataFrame:
    """A year's rows from its archive or its monthly ones; months outside start to end are not opened. Symbols that are nowhere raise KeyError."""
    archives = chosen(files(spark, root), year, frequency)
    if start is not None:
        archives = archives.filter(F.col("month").isNull() | (F.col("month") >= F.when(F.year(F.lit(start).cast("date")) == year, F.month(F.lit(start).cast("date"))).otherwise(1)))
    if end is not None:
        archives = archives.filter(F.col("month").isNull() | (F.col("month") <= F.when(F.year(F.lit(end).cast("date")) == year, F.month(F.lit(end).cast("date"))).otherwise(12)))
    paths = [r["path"] for r in archives.select("path").collect()]  # a dozen a year
    if not paths:
        raise ArchiveError(f"no archive of {year} at {frequency} minutes")
    rows = read(spark, paths, symbols, start, end)
    if symbols:
        # the archives' directories are read, not their members
        have = {r["symbol"] for r in inventory(spark, paths).select(F.explode("symbols").alias("symbol")).filter(F.col("symbol").isin(*[s.upper() for s in symbols])).distinct().collect()}
        if lacking := sorted({s.upper() for s in symbols} - have):
            raise KeyError(f"not in the archives: {lacking}")
    return rows


def _bad(z: zipfile.ZipFile) -> list[str]:
    """All members whose CRC is wrong or that cannot be unpacked."""
    out = []
    for i in z.infolist():
        try:
            with z.open(i) as f:
                while f.read(1 << 20):
                    pass
        except (zipfile.BadZipFile, zlib.error, EOFError):
            out.append(i.filename)
    return out


def inventory(spark: SparkSession, paths: list[str] | str, deep: bool = False, nested: bool = False) -> DataFrame:
    """Per archive: members, parquet_members, bytes unpacked, symbols, problem; with ``deep`` bad_members (failed CRC; of nested archives outer:inner too) and sha256."""
    ddl = "path string, members int, parquet_members int, unpacked_bytes long, symbols array<string>, bad_members array<string>, sha256 string, problem string"
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.string()]

    def look(path: str, content: bytes) -> tuple:
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                infos = [i for i in z.infolist() if not i.is_dir()]
                end = ".zip" if nested else ".parquet"
                names = [i.filename for i in infos if i.filename.endswith(end)]
                symbols = sorted({n.rsplit("/", 1)[-1].removesuffix(end) for n in names})
                inner, bad = 0, []
                if nested:
                    for n in names:
                        with zipfile.ZipFile(io.BytesIO(z.read(n))) as y:
                            inner += sum(x.endswith(".parquet") for x in y.namelist())
                            bad += [f"{n}:{x}" for x in (_bad(y) if deep else [])]
                bad = [*(_bad(z) if deep else []), *bad]
                empty = [i.filename for i in infos if not i.file_size]
                return path, len(infos), inner if nested else len(names), sum(i.file_size for i in infos), symbols, bad, hashlib.sha256(content).hexdigest() if deep else None, "empty_members" if empty else None
        except (zipfile.BadZipFile, OSError) as e:
            return path, 0, 0, 0, [], [], None, f"unreadable: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [look(p.as_py(), c.as_py()) for p, c in zip(batch.column(0), batch.column(1), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [d.strip().split(" ")[0] for d in ddl.split(", ")])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(run, ddl)


def delivery(archives: DataFrame, frequencies: list[int], years: list[int]) -> DataFrame:
    """Per requested year and frequency: layout (annual, monthly, missing) and the months that a monthly delivery lacks."""
    spark = archives.sparkSession
    grid = spark.createDataFrame([(y, f) for y in years for f in frequencies], "year int, frequency int")
    have = archives.groupBy("year", "frequency").agg(F.bool_or(F.col("month").isNull()).alias("annual"), F.sort_array(F.collect_set("month")).alias("months"))
    layout = F.when(F.col("annual").isNull(), "missing").when(F.col("annual"), "annual").otherwise("monthly")
    gaps = F.when(layout == "monthly", F.array_except(F.sequence(F.lit(1), F.lit(12)), F.col("months"))).otherwise(F.array().cast("array<int>"))
    return grid.join(have, ["year", "frequency"], "left").select("year", "frequency", layout.alias("layout"), gaps.alias("missing_months"))
