"""Members of vendor archives as a Python data source, planned from an index of the archives' directories.

``settle_index`` reads each archive's directory, the bytes at its end, in a task, and writes where every member begins; later
runs read only archives that are new or have another size. Reads are planned from the index: members of symbols that a filter
leaves out are in no task, the others are dealt out by size, and a task reads only the bytes of its members. So archives may
have any size, a symbol costs its own member, and no content is read to plan.

A filter on ``member`` (the symbol that the archive says it is) chooses members; filters on ``trade_time`` choose row groups;
only the columns of the schema asked for are decoded. Stores are those that pyarrow opens; ``archive.read`` reads archives
whole from all others.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from . import commits

COLUMNS = {
    "member": pa.string(), "ts_code": pa.string(), "freq": pa.string(), "trade_time": pa.timestamp("us", "UTC"), "open": pa.float64(), "close": pa.float64(),
    "high": pa.float64(), "low": pa.float64(), "vol": pa.int64(), "amount": pa.float64(),
}
DDL = "member string, ts_code string, freq string, trade_time timestamp, open double, close double, high double, low double, vol long, amount double"
INDEX = "archive string, archive_bytes long, frequency int, year int, month int, member string, symbol string, nested boolean, offset long, packed long, unpacked long, method int, crc long"
#: Unpacked bytes of the members of one task.
TASK_BYTES = 64 << 20


class ArchiveError(ValueError):
    pass


def placed(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path there; letters that URIs may not have are allowed."""
    if path.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe="/:?=&@%~+,"))


def opened(path: str) -> pa.NativeFile:
    """A file of any store that pyarrow knows, for reads at any place."""
    store, inner = placed(path)
    return store.open_input_file(inner)


def directory(file: io.IOBase) -> list[zipfile.ZipInfo]:
    """Members of an archive; only its end is read."""
    with zipfile.ZipFile(file) as z:
        return [i for i in z.infolist() if not i.is_dir()]


def _symbol(member: str) -> str:
    return re.sub(r"\.(zip|parquet)$", "", member.rsplit("/", 1)[-1]).upper()


def packed_bytes(file: io.IOBase, offset: int, packed: int, unpacked: int, method: int, crc: int, name: str) -> bytes:
    """The content of one member by its place; its checksum must hold."""
    file.seek(offset)
    head = file.read(30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04":
        raise ArchiveError(f"{name}: no member at {offset}")
    file.seek(offset + 30 + sum(struct.unpack("<HH", head[26:30])))
    data = file.read(packed)
    if method == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(data, -15)
    elif method != zipfile.ZIP_STORED:
        raise ArchiveError(f"{name}: packed by method {method}")
    if len(data) != unpacked or zlib.crc32(data) != crc:
        raise ArchiveError(f"{name}: its bytes do not have the directory's size and checksum")
    return data


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.to_pylist():
            with opened(archive["path"]) as file:
                rows = [
                    {"archive": archive["path"], "archive_bytes": archive["bytes"], "frequency": archive["frequency"], "year": archive["year"], "month": archive["month"], "member": i.filename, "symbol": _symbol(i.filename),
                     "nested": i.filename.endswith(".zip"), "offset": i.header_offset, "packed": i.compress_size, "unpacked": i.file_size, "method": i.compress_type, "crc": i.CRC}
                    for i in directory(file) if i.filename.endswith((".parquet", ".zip"))
                ]
            if rows:
                kinds = {"frequency": pa.int32(), "year": pa.int32(), "month": pa.int32(), "method": pa.int32()}
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n)) for n in rows[0]], list(rows[0]))


def settle_index(spark: SparkSession, archives: DataFrame, target: str) -> DataFrame:
    """The index of ``archives`` (path, bytes, frequency, year, month) in ``target``, brought up to date; readers see the old one or the new one.

    Archives with the size that the last index has keep their rows; those that are gone lose them.
    """
    number, before = commits.last(spark, f"{target}/_log")
    listed = archives.select("path", "bytes", "frequency", "year", "month")
    fresh, kept = listed, None
    if before is not None:
        known = spark.read.parquet(f"{target}/{before['version']}")
        same = known.select(F.col("archive").alias("path"), F.col("archive_bytes").alias("bytes")).distinct()
        fresh = listed.join(same, ["path", "bytes"], "left_anti")
        kept = known.join(listed.select(F.col("path").alias("archive"), F.col("bytes").alias("archive_bytes")), ["archive", "archive_bytes"], "left_semi")
    tasks = spark.sparkContext.defaultParallelism
    rows = fresh.repartition(max(1, min(4 * tasks, fresh.count()))).mapInArrow(_look, INDEX)
    version = f"version-{uuid.uuid4().hex}"
    (rows if kept is None else rows.unionByName(kept.select(*rows.columns))).repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset").write.parquet(f"{target}/{version}")
    commits.commit(spark, f"{target}/_log", lambda n, was: {"version": version})
    return index(spark, target)


def index(spark: SparkSession, target: str) -> DataFrame:
    _, content = commits.last(spark, f"{target}/_log")
    if content is None:
        raise ArchiveError(f"no index in {target}")
    return spark.read.schema(INDEX).parquet(f"{target}/{content['version']}")


@dataclass
class Members(InputPartition):
    """Members of one archive that a task reads, as rows of the index."""

    archive: str
    entries: list[dict]


class _Reader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]) -> None:
        self.options, self.columns = dict(options), columns
        self.symbols: set[str] | None = None
        self.limits: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        signs = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("member",):
                some = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.symbols = some if self.symbols is None else self.symbols & some
            elif type(f) in signs and f.attribute == ("trade_time",):
                self.limits.append((signs[type(f)], f.value))
                yield f  # row groups are chosen here, rows by Spark too
            else:
                yield f

    def partitions(self) -> list[Members]:
        store, inner = placed(self.options["index"])
        rule = ds.field("archive").isin(json.loads(self.options["archives"]))
        if self.symbols is not None:
            rule &= ds.field("symbol").isin(sorted(self.symbols))
        rows = ds.dataset(inner, filesystem=store, format="parquet").to_table(filter=rule).sort_by([("archive", "ascending"), ("offset", "ascending")]).to_pylist()
        most, out, size = int(self.options.get("task_bytes", TASK_BYTES)), [], 0
        for r in rows:
            if not out or out[-1].archive != r["archive"] or size + r["unpacked"] > most:
                out.append(Members(r["archive"], []))
                size = 0
            out[-1].entries.append(r)
            size += r["unpacked"]
        return out

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        with opened(partition.archive) as file:
            for e in partition.entries:
                data = packed_bytes(file, e["offset"], e["packed"], e["unpacked"], e["method"], e["crc"], e["member"])
                for name, content in self._parquet(e, data):
                    yield from self._rows(e["symbol"], name, content)

    def _parquet(self, entry: dict, data: bytes) -> Iterator[tuple[str, bytes]]:
        if not entry["nested"]:
            yield entry["member"], data
            return
        year = self.options.get("member_year")
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for name in sorted(z.namelist()):
                if name.endswith(".parquet") and (year is None or f"/{year}/" in f"/{name}"):
                    yield f"{entry['member']}:{name}", z.read(name)

    def _rows(self, symbol: str, name: str, content: bytes) -> Iterator[pa.RecordBatch]:
        file = pq.ParquetFile(io.BytesIO(content))
        have = {f.name: f.type for f in file.schema_arrow}
        if missing := set(COLUMNS) - {"member"} - set(have):
            raise ArchiveError(f"{name}: missing columns {sorted(missing)}")
        zone, kind = self.options["zone"], have["trade_time"]

        def bound(t: object) -> pa.Scalar:
            t = pa.scalar(t, pa.timestamp("us", "UTC"))
            return (t if getattr(kind, "tz", None) else pc.local_timestamp(t.cast(pa.timestamp("us", zone)))).cast(kind)

        wanted = [c for c in self.columns if c != "member"]
        table = pq.read_table(io.BytesIO(content), columns=wanted or ["trade_time"], filters=[("trade_time", sign, bound(t)) for sign, t in self.limits] or None)
        arrays = []
        for c in self.columns:
            if c == "member":
                arrays.append(pa.array([symbol] * table.num_rows, pa.string()))
            else:
                x = table[c]
                x = pc.assume_timezone(x, zone) if c == "trade_time" and x.type.tz is None else x
                arrays.append(x.cast(COLUMNS[c]))
        yield from pa.table(arrays, names=self.columns).to_batches(max_chunksize=65_536)


class ArchiveMembers(DataSource):
    """Options: index (a version's folder), archives (JSON list of paths), zone, member_year, task_bytes."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return DDL

    def reader(self, schema) -> _Reader:
        return _Reader(self.options, schema.fieldNames())


def read(spark: SparkSession, target: str, archives: list[str], columns: list[str] | None = None, member_year: int | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Rows of the members of ``archives`` by the index in ``target``, in the vendor's columns or some of them; filters on member and trade_time choose what is opened."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArchiveMembers)
    _, content = commits.last(spark, f"{target}/_log")
    if content is None:
        raise ArchiveError(f"no index in {target}")
    kinds = dict(x.split(" ") for x in DDL.split(", "))
    rows = spark.read.format("archive_members").schema(", ".join(f"{c} {kinds[c]}" for c in columns or kinds))
    rows = rows.option("index", f"{target}/{content['version']}").option("archives", json.dumps(archives)).option("zone", spark.conf.get("spark.sql.session.timeZone")).option("task_bytes", task_bytes)
    return (rows if member_year is None else rows.option("member_year", member_year)).load()


def read_year(spark: SparkSession, target: str, year: int, frequency: int, symbols: list[str] | None = None, start=None, end=None, columns: list[str] | None = None) -> DataFrame:
    """A year's rows from its archive, or its monthly ones where there is none; months outside start to end (inclusive) are not opened.

    Two archives of one period raise ArchiveError; symbols that the index has nowhere in the year raise KeyError.
    """
    of_year = index(spark, target).filter((F.col("year") == year) & (F.col("frequency") == frequency))
    found = [tuple(r) for r in of_year.select("archive", "month").distinct().collect()]  # a dozen
    if len(found) != len({m for _, m in found}):
        raise ArchiveError(f"more than one archive of one period of {year}")
    if any(m is None for _, m in found):
        found = [x for x in found if x[1] is None]
    if not found:
        raise ArchiveError(f"no archive of {year} at {frequency} minutes")
    key = lambda day: str(day)[:7]
    period = lambda m: f"{year}-{m:02d}"
    paths = sorted(a for a, m in found if m is None or ((start is None or period(m) >= key(start)) and (end is None or period(m) <= key(end))))
    rows = read(spark, target, paths, columns)
    if symbols:
        upper = sorted({s.upper() for s in symbols})
        have = {r["symbol"] for r in of_year.filter(F.col("archive").isin([a for a, _ in found]) & F.col("symbol").isin(upper)).select("symbol").distinct().collect()}
        if lacking := sorted(set(upper) - have):
            raise KeyError(f"not in the archives: {lacking}")
        rows = rows.filter(F.col("member").isin(upper))
    if start is not None:
        rows = rows.filter(F.col("trade_time") >= F.lit(str(start)).cast("date").cast("timestamp"))
    if end is not None:
        rows = rows.filter(F.col("trade_time") < F.date_add(F.lit(str(end)).cast("date"), 1).cast("timestamp"))
    return rows
