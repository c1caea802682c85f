"""Scans of provider and product files. Schemas are given, never inferred; empty text is null."""

from __future__ import annotations

import csv as csv_module
import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as S


def csv(spark: SparkSession, path: str | list[str], ddl: str, strict: bool = True) -> DataFrame:
    """CSV (or gzip) with a header that must be the schema's columns in order, if ``strict``; with the file's path as ``_file``."""
    rows = spark.read.schema(ddl).option("header", True).option("enforceSchema", not strict).option("nullValue", "").option("emptyValue", "").option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return rows.csv(path).select("*", F.col("_metadata.file_path").alias("_file"))


def profiles(spark: SparkSession, root: str, exchanges: list[str], start=None, end=None) -> DataFrame:
    """Daily cross-sections ``{exchange}/YYYY/MM/YYYYMMDD.csv`` from start to end; other file names are left out. Partition dates come from the names and prune before parsing is asked for."""
    out = csv(spark, [f"{root}/{e}/*/*/*.csv" for e in exchanges], schemas.text_schema(schemas.PROFILE))
    stem = F.regexp_extract("_file", r"/(\d{8})\.csv$", 1)
    day = F.try_to_date(stem, "yyyyMMdd")
    out = out.filter(day.isNotNull())
    if start is not None:
        out = out.filter(day >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(day <= F.lit(end).cast("date"))
    return typed(out, schemas.PROFILE).drop("_file")


def typed(rows: DataFrame, ddl: str) -> DataFrame:
    """Text columns to the schema's types; what does not parse is null."""
    kinds = {p.strip().split(" ", 1)[0]: p.strip().split(" ", 1)[1] for p in schemas._split(ddl)}

    def one(name: str) -> Column:
        if name not in kinds:
            return F.col(name)
        kind = kinds[name]
        if kind == "date":
            return S.parse_date(name).alias(name)
        if kind == "boolean":
            return S.flag(name).alias(name)
        return (S.finite(F.col(name).try_cast("double")) if kind == "double" else S.blank_to_null(name).try_cast(kind)).alias(name)

    return rows.select(*map(one, rows.columns))


def partition_dates(rows: DataFrame, exchanges: list[str], every: bool = False) -> DataFrame:
    """Dates that some exchange has, or that every one has."""
    have = rows.select("exchange", "date").filter(F.col("exchange").isin(*exchanges)).distinct()
    counted = have.groupBy("date").agg(F.count("*").alias("n"))
    return (counted.filter(F.col("n") == len(exchanges)) if every else counted).select("date")


def symbol_caches(spark: SparkSession, path: str, ddl: str, strict: bool = True) -> DataFrame:
    """Per-symbol ``{SYMBOL}.csv.gz`` caches with the symbol of the file name as ``file_symbol``."""
    rows = csv(spark, path, schemas.text_schema(ddl), strict)
    return typed(rows, ddl).withColumn("file_symbol", F.regexp_extract("_file", r"/([^/]+?)\.csv(\.gz)?$", 1)).drop("_file")


def stale_headers(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Files whose header lacks required columns: path, missing. Of each file a task reads the first bytes, up to the end of its first line."""
    from .members import opened

    def head(path: str) -> str:
        with opened(path) as raw:
            packed = raw.read(2) == b"\x1f\x8b"
            raw.seek(0)
            with gzip.open(raw) if packed else raw as f:
                line = b""
                while b"\n" not in line and (more := f.read(4096)):
                    line += more
        return line.partition(b"\n")[0].decode("utf-8-sig", "replace").rstrip("\r")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([head(p) for p in batch.column(0).to_pylist()], pa.string())], ["path", "header"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").mapInArrow(run, "path string, header string")
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.transform(F.split("header", ","), lambda c: F.trim(c))))
    return files.select("path", missing.alias("missing")).filter(F.size("missing") > 0)


def cache_statistics(spark: SparkSession, path: str, most_files: int | None = None) -> DataFrame:
    """One row over CSV and CSV.GZ trees: files, rows (no header or blank lines), bytes of the files as stored, first and last date of the first column. ``most_files`` takes the first so many by path."""
    kept = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*").load(path).select("path", "length")
    lines = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter="*.csv*").select(F.col("_metadata.file_path").alias("file"), "value")
    if most_files is not None:
        kept = kept.orderBy("path").limit(most_files)
        lines = lines.join(kept.select(F.regexp_replace("path", "^file:/+", "").alias("name")), F.regexp_replace("file", "^file:/+", "") == F.col("name"), "left_semi")
    day = S.parse_date(F.substring_index("value", ",", 1))
    row = (F.trim("value") != "") & day.isNotNull()
    told = lines.agg(F.count_if(row).alias("rows"), F.min(F.when(row, day)).alias("first_date"), F.max(F.when(row, day)).alias("last_date"))
    return kept.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).join(told).select("files", "rows", "bytes", "first_date", "last_date")


def symbol_list(spark: SparkSession, path: str) -> DataFrame:
    """First column of a text file without blank lines, comments and header words."""
    word = F.trim(F.regexp_extract("value", r"^([^,\s]*)", 1))
    return spark.read.text(path).select(word.alias("symbol")).filter((F.col("symbol") != "") & ~F.col("symbol").startswith("#") & ~F.lower("symbol").isin("symbol", "code", "ticker"))


def company_files(spark: SparkSession, path: str, aliases: dict[str, list[str]]) -> DataFrame:
    """Delimited company files (txt, csv, tsv, dat) by their own headers: file, line, file_date and one text column per canonical name.

    The separator is the one of comma, tab, bar and semicolon that is commonest in the first line, else white space; a
    canonical column is the first of its aliases in the header. A file without any known header gives one row with
    ``reject``. Files are read whole, a task some of them.
    """
    columns = list(aliases)
    ddl = "file string, line int, file_date date, reject string, " + ", ".join(f"`{c}` string" for c in columns)

    def split(line: str, mark: str | None) -> list[str]:
        return [x.strip().strip('"') for x in (line.split() if mark is None else next(csv_module.reader([line], delimiter=mark, skipinitialspace=True), []))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import datetime

        fields = [("file", pa.string()), ("line", pa.int32()), ("file_date", pa.date32()), ("reject", pa.string()), *((c, pa.string()) for c in columns)]
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lines = content.decode("utf-8-sig", "replace").splitlines()
                first = next((i for i, x in enumerate(lines) if x.strip()), None)
                found = re.search(r"(\d{4})-?(\d{2})-?(\d{2})", name.rsplit("/", 1)[-1])
                try:
                    day = datetime.date(*map(int, found.groups())) if found else None
                except ValueError:
                    day = None
                if first is None:
                    continue
                mark = max(",\t|;", key=lines[first].count)
                mark = mark if lines[first].count(mark) else None
                header = [h.lower() for h in split(lines[first], mark)]
                place = {c: next((header.index(a.lower()) for a in names if a.lower() in header), None) for c, names in aliases.items()}
                if all(v is None for v in place.values()):
                    rows = [(name, first, day, "no_header", *[None] * len(columns))]
                else:
                    rows = []
                    for i, line in enumerate(lines[first + 1 :], first + 1):
                        if line.strip():
                            cells = split(line, mark)
                            rows.append((name, i, day, None, *(cells[p] if p is not None and p < len(cells) and cells[p] else None for p in place.values())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter(F.lower("path").rlike(r"\.(txt|csv|tsv|dat)$"))
    return files.select("path", "content").mapInArrow(run, ddl)


def normalize_company(rows: DataFrame, start=None, end=None, exchanges: list[str] | None = None, symbols: list[str] | None = None, aliases: dict[str, list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Typed bars, and rejected rows with a reason, of ``company_files`` with columns date, symbol, exchange, open, high, low, close, volume, amount."""
    number = ["open", "high", "low", "close", "volume", "amount"]
    symbol = S.normalize_symbol("symbol")
    out = rows.select("file", "line", F.coalesce(S.parse_date("date"), F.when(F.col("date").isNull(), F.col("file_date"))).alias("date"), symbol.alias("symbol"), S.infer_exchange(symbol, "exchange", aliases).alias("exchange"), *[S.clean_number(c).alias(c) for c in number], "reject")
    reason = F.coalesce("reject", F.when(F.col("date").isNull(), "invalid_date").when(F.col("symbol").isNull(), "missing_symbol").when(F.col("exchange") == "", "unknown_exchange"), *[F.when(F.col(c).isNull(), f"missing_{c}") for c in number])
    out = out.withColumn("reject", reason)
    good = out.filter("reject is null").drop("reject")
    if start is not None:
        good = good.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        good = good.filter(F.col("date") <= F.lit(end).cast("date"))
    if exchanges:
        good = good.filter(F.col("exchange").isin(*exchanges))
    if symbols:
        good = good.filter(F.col("symbol").isin(*[s.upper() for s in symbols]))
    return good, out.filter("reject is not null")


# -- provider payloads

_TIINGO = ["open", "high", "low", "close", "volume", "adjOpen", "adjHigh", "adjLow", "adjClose", "adjVolume", "divCash", "splitFactor"]


def tiingo(payloads: DataFrame) -> DataFrame:
    """US bars of JSON arrays; payloads: symbol, asset_type, json. ``reject`` where a number or the date is missing."""
    kind = "array<struct<date:string," + ",".join(f"{c}:double" for c in _TIINGO) + ">>"
    rows = payloads.select("symbol", "asset_type", F.inline(F.from_json("json", kind)))
    name = {"adjOpen": "adj_open", "adjHigh": "adj_high", "adjLow": "adj_low", "adjClose": "adj_close", "adjVolume": "adj_volume", "divCash": "dividend", "splitFactor": "split_factor"}
    bad = F.array_contains(F.array(*[F.col(c).isNull() for c in _TIINGO]), True)
    reject = F.when(S.parse_date_prefix("date").isNull(), "invalid_date").when(bad, "missing_number")
    return rows.select("symbol", "asset_type", S.parse_date_prefix("date").alias("date"), *[F.col(c).alias(name.get(c, c)) for c in _TIINGO], F.lit("tiingo").alias("source"), reject.alias("reject"))


def snapshots(payloads: DataFrame, indicators: list[str]) -> DataFrame:
    """Tick snapshots of JSON {tables: [{thscode, time: [], table: {indicator: []}}]}: code, time and the indicators; short series end in nulls."""
    kind = "struct<tables:array<struct<thscode:string,time:array<string>,table:map<string,array<string>>>>>"
    rows = payloads.select(F.explode(F.from_json("json", kind)["tables"]).alias("t")).select(F.col("t.thscode").alias("code"), "t.table", F.posexplode("t.time").alias("i", "time"))
    return rows.select("code", "time", *[F.try_element_at(F.try_element_at("table", F.lit(c)), F.col("i") + 1).alias(c) for c in indicators])


# Provider headers and their canonical names.
BAOSTOCK = {"date": "date", "code": "code", "open": "open", "high": "high", "low": "low", "close": "close", "preclose": "preclose", "volume": "volume", "amount": "amount", "turn": "turnover_rate", "pctChg": "pct_change", "peTTM": "pe_ttm", "pbMRQ": "pb_mrq", "psTTM": "ps_ttm", "pcfNcfTTM": "pcf_ncf_ttm", "tradestatus": "trade_status", "isST": "is_st"}
AKSHARE = {"日期": "date", "开盘": "open", "最高": "high", "最低": "low", "收盘": "close", "成交量": "volume", "成交额": "amount", "换手率": "turnover_rate", "涨跌幅": "pct_change"}


def baostock(rows: DataFrame, adjust: str) -> DataFrame:
    """Provider rows (text) to profile rows; rows without a date are left out."""
    named = rows.select(*[F.col(k).alias(v) for k, v in BAOSTOCK.items()]).filter(S.blank_to_null("date").isNotNull())
    symbol = S.from_provider_code("code")
    full = named.withColumns({"symbol": symbol, "exchange": F.substring_index(symbol, ".", -1), "board": S.board(symbol), "volume_unit": F.lit("share"), "adjust": F.lit(adjust), "source": F.lit("baostock")})
    return typed(full.select(*schemas.names(schemas.PROFILE)), schemas.PROFILE)


def akshare(rows: DataFrame, adjust: str) -> DataFrame:
    """Provider rows with Chinese headers and a symbol column to profile rows; volume counts hands."""
    named = rows.select("symbol", *[F.col(k).alias(v) for k, v in AKSHARE.items()])
    symbol = S.normalize_symbol("symbol")
    rest = {n: F.lit(None).cast("string") for n in schemas.names(schemas.PROFILE) if n not in named.columns}
    full = named.withColumns(rest | {"symbol": symbol, "exchange": F.substring_index(symbol, ".", -1), "board": S.board(symbol), "volume_unit": F.lit("hand"), "adjust": F.lit(adjust), "source": F.lit("akshare")})
    return typed(full.select(*schemas.names(schemas.PROFILE)), schemas.PROFILE)


def index_daily(rows: DataFrame, source: str = "baostock") -> DataFrame:
    named = rows.select("date", S.from_provider_code("code").alias("symbol"), "open", "high", "low", "close", "preclose", "volume", "amount", F.col("pctChg").alias("pct_change"), F.lit(source).alias("source"))
    return typed(named, schemas.INDEX_DAILY)


def five_minute(rows: DataFrame, symbol: Column | str, exchange: Column | str, adjust: str) -> DataFrame:
    """Provider 5-minute rows to bars with trade_time, trade_date, exchange and adjust."""
    time = S.five_minute_time("time")
    number = [S.clean_number(c).alias(c) for c in ("open", "high", "low", "close", "volume", "amount")]
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return rows.select(as_col(symbol).alias("symbol"), time.alias("trade_time"), F.to_date(time).alias("trade_date"), as_col(exchange).alias("exchange"), *number, F.lit(adjust).alias("adjust"))


def read_minutes(spark: SparkSession, path: str, frequency: int, start, end, symbols: list[str] | None = None, exchange: str | None = None, first_minute: int | None = None, last_minute: int | None = None, limit: int | None = None, strict: bool = False) -> DataFrame:
    """Bars of the production tree (partitioned by frequency, exchange, trade_date). Partition columns prune; symbol and time reach the Parquet filters. With a limit the newest bars come first. The exchange follows from the symbols; another one is an error.

    ``strict``: the footers of the partitions read are looked at first; nulls, other columns or types than the product's, and files that cannot be read raise.
    """
    suffixes = sorted({s.rsplit(".", 1)[-1].lower() for s in symbols or []})
    if exchange and suffixes and suffixes != [exchange.lower()]:
        raise ValueError(f"symbols of {suffixes} do not belong to {exchange}")
    rows = spark.read.parquet(path).filter((F.col("frequency") == frequency) & F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if suffixes or exchange:
        rows = rows.filter(F.col("exchange").isin(*(suffixes or [exchange.lower()])))
    if symbols:
        rows = rows.filter(F.col("symbol").isin(*[s.upper() for s in symbols]))
    if strict:
        from . import footers

        part = F.col("part")
        chosen = footers.scan(spark, path).withColumn("part", S.partition_parts("path")).filter((part["frequency"] == frequency) & part["trade_date"].between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        if suffixes or exchange:
            chosen = chosen.filter(part["exchange"].isin(*(suffixes or [exchange.lower()])))
        footers.require(chosen.drop("part"), path)
    m = S.minute_of_day("trade_time")
    if first_minute is not None:
        rows = rows.filter(m >= first_minute)
    if last_minute is not None:
        rows = rows.filter(m <= last_minute)
    return rows.orderBy(F.desc("trade_time"), "symbol").limit(limit) if limit else rows


def digests(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes and sha256 of every file under ``path``."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def placed_minutes(spark: SparkSession, path: str) -> DataFrame:
    """All bars of the production tree with their file, their place in it, and ``path_parts``: what the path says of them."""
    file = F.col("_metadata.file_path")
    return spark.read.parquet(path).select("*", file.alias("file"), F.col("_metadata.row_index").alias("place"), S.partition_parts(file).alias("path_parts"))


def newest_minutes(spark: SparkSession, path: str, symbol: str, frequency: int, rows: int) -> DataFrame:
    """The last ``rows`` bars of a symbol, newest first; years are opened from the last one on until there are enough."""
    exchange = symbol.rsplit(".", 1)[-1].lower()
    own = spark.read.parquet(path).filter((F.col("frequency") == frequency) & (F.col("exchange") == exchange))
    have = own.filter(F.col("symbol") == symbol.upper())
    years = [r["year"] for r in own.select(F.year("trade_date").alias("year")).distinct().orderBy(F.desc("year")).collect()]  # partition values only
    for year in years:
        part = have.filter(F.col("trade_date") >= F.make_date(F.lit(year), F.lit(1), F.lit(1)))
        if part.count() >= rows:
            have = part
            break
    return have.orderBy(F.desc("trade_time")).limit(rows)
