"""Writers: partitioned bars, symbol files, reports, manifests, multi-table builds."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits

#: Orders of the products' files.
ORDERS = {
    "filings": ["accepted_or_filed", "filing_date", "accession"],
    "facts": ["available_date", "accepted_at", "filed_date", "accession", "taxonomy", "tag", "unit", "start_date", "end_date", "frame", "value", "row_id"],
    "standardized": ["symbol", "report_period", "period_type", "available_date", "accession"],
}


def ordered(rows: DataFrame, product: str) -> DataFrame:
    """Rows of each partition in the product's order; blanks first."""
    if product == "filings":
        first = F.coalesce(F.nullif("accepted_at", F.lit("")), F.col("filing_date").cast("string"))
        return rows.withColumn("accepted_or_filed", first).sortWithinPartitions(*[F.asc_nulls_first(c) for c in ORDERS[product]]).drop("accepted_or_filed")
    return rows.sortWithinPartitions(*[F.asc_nulls_first(c) for c in ORDERS[product]])


def _dynamic(writer):
    return writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def by_date(profile: DataFrame, path: str, form: str = "parquet", sep: str = ",") -> None:
    """Cross-sections partitioned by exchange and date; partitions in ``profile`` are replaced, others stay. One file each."""
    rows = profile.repartition("exchange", "date").sortWithinPartitions("exchange", "date", "symbol")
    out = _dynamic(rows.write).partitionBy("exchange", "date")
    out.parquet(path) if form == "parquet" else out.option("header", True).option("sep", sep).csv(path)


def five_minutes(rows: DataFrame, path: str) -> None:
    """5-minute bars by adjust, exchange and trade_date as gzip CSV."""
    keys = ["adjust", "exchange", "trade_date"]
    _dynamic(rows.repartition(*keys).sortWithinPartitions(*keys, "symbol", "trade_time").write).partitionBy(*keys).option("header", True).option("compression", "gzip").csv(path)


def minutes(rows: DataFrame, path: str) -> None:
    """Minute bars by frequency, exchange and trade_date: zstd, row groups of 65,536 rows, sorted by symbol and time so that symbol statistics skip row groups; times in microseconds, which have statistics too."""
    keys = ["frequency", "exchange", "trade_date"]
    out = _dynamic(rows.repartition(*keys).sortWithinPartitions(*keys, "symbol", "trade_time").write).partitionBy(*keys).option("compression", "zstd").option("parquet.block.row.count.limit", 65_536)
    kind, conf = "spark.sql.parquet.outputTimestampType", rows.sparkSession.conf
    was = conf.get(kind)
    try:
        conf.set(kind, "TIMESTAMP_MICROS")
        out.parquet(path)
    finally:
        conf.set(kind, was)


def by_symbol(rows: DataFrame, path: str, order: list[str], form: str = "csv") -> None:
    """One sorted file per symbol (gzip CSV, or Parquet)."""
    out = _dynamic(rows.repartition("symbol").sortWithinPartitions("symbol", *order).write).partitionBy("symbol")
    out.option("header", True).option("compression", "gzip").csv(path) if form == "csv" else out.parquet(path)


def symbol_files(rows: DataFrame, path: str, order: list[str], form: str = "csv") -> None:
    """One file ``{symbol}.csv.gz`` or ``{symbol}.parquet`` for each symbol, with equal bytes whenever its rows are equal; files of other symbols stay.

    Rows are sorted by ``order`` and then by all other columns. Files are written aside and put in their places one by one.
    """
    spark, staged = rows.sparkSession, f"{path}/_staging-{uuid.uuid4().hex}"
    rest = [c for c in rows.columns if c not in ("symbol", *order)]
    out = rows.withColumn("_symbol", F.col("symbol")).repartition("_symbol").sortWithinPartitions("_symbol", *order, *rest).write.partitionBy("_symbol")
    end = "csv.gz" if form == "csv" else "parquet"
    try:
        out.option("header", True).option("compression", "gzip").csv(staged) if form == "csv" else out.parquet(staged)

        def place(folder: str) -> None:
            (file,) = [n for n in commits.names(spark, f"{staged}/{folder}") if n.startswith("part-")]
            commits.replace(spark, f"{staged}/{folder}/{file}", f"{path}/{folder.removeprefix('_symbol=')}.{end}")

        with ThreadPoolExecutor(16) as pool:
            list(pool.map(place, [n for n in commits.names(spark, staged) if n.startswith("_symbol=")]))
    finally:
        commits.delete(spark, staged)


def calendar(rows: DataFrame, path: str) -> None:
    _dynamic(rows.repartition("year").sortWithinPartitions("date").write).partitionBy("year").option("header", True).csv(path)


def text_lists(rows: DataFrame) -> DataFrame:
    """Array columns as text joined by semicolons, booleans as 1 and 0: the form for CSV."""
    return rows.select(*[F.array_join(F.transform(n, lambda x: x.cast("string")), ";").alias(n) if t.startswith("array") else F.col(n).cast("int").cast("string").alias(n) if t == "boolean" else F.col(n) for n, t in rows.dtypes])


def build(tables: dict[str, DataFrame], path: str) -> str:
    """Several tables under one build id, then one numbered commit: readers that go by the commits see all of them or none, and of two writers at once both builds, in the order of their numbers."""
    spark = next(iter(tables.values())).sparkSession
    build_id = uuid.uuid4().hex
    for name, rows in tables.items():
        rows.write.parquet(f"{path}/{name}/build_id={build_id}")
    at = dt.datetime.now(dt.timezone.utc).isoformat()
    commits.commit(spark, f"{path}/_log", lambda number, before: {"build_id": build_id, "tables": sorted(tables), "built_at": at})
    return build_id


def read_build(spark: SparkSession, path: str, name: str, number: int | None = None) -> DataFrame:
    """A table of the last complete build, or of one by its number."""
    content = commits.last(spark, f"{path}/_log")[1] if number is None else commits.read(spark, f"{path}/_log", number)
    if content is None or name not in content["tables"]:
        raise KeyError(f"no build of {name} in {path}")
    return spark.read.parquet(f"{path}/{name}/build_id={content['build_id']}")


def report(findings: DataFrame, summary: DataFrame, path: str) -> None:
    """Findings as CSV and a one-row summary as JSON."""
    text_lists(findings).write.mode("overwrite").option("header", True).csv(f"{path}/findings")
    summary.write.mode("overwrite").json(f"{path}/summary")


def run_manifest(outcomes: DataFrame, run_id: str) -> DataFrame:
    """One row for a run of (item, status fetched/cached/failed, error): counts, status and an order-free hash of the failures."""
    n = lambda s: F.count_if(F.col("status") == s)
    failure = F.when(F.col("status") == "failed", F.conv(F.substring(F.md5(F.concat_ws("\u001f", "item", F.coalesce("error", F.lit("")))), 1, 15), 16, 10).cast("decimal(20,0)"))
    out = outcomes.agg(F.count("*").alias("total"), n("fetched").alias("fetched"), n("cached").alias("cached"), n("failed").alias("failed"), F.sha2(F.coalesce(F.sum(failure).cast("string"), F.lit("")), 256).alias("failures_hash"))
    status = F.when(F.col("total") == 0, "completed_empty").when(F.col("failed") > 0, "completed_with_failures").otherwise("completed")
    return out.select(F.lit(run_id).alias("run_id"), status.alias("status"), "total", "fetched", "cached", "failed", "failures_hash")


def write_run(outcomes: DataFrame, run_id: str, path: str) -> None:
    run_manifest(outcomes, run_id).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    outcomes.filter("status = 'failed'").write.mode("overwrite").option("header", True).csv(f"{path}/failures")


def by_suffix(rows: DataFrame, path: str) -> None:
    """csv, csv.gz or parquet by the path's suffix."""
    if path.endswith(".parquet"):
        rows.write.parquet(path)
    elif path.endswith((".csv", ".csv.gz")):
        rows.write.option("header", True).option("compression", "gzip" if path.endswith(".gz") else "none").csv(path)
    else:
        raise ValueError(f"unknown suffix: {path}")


def recompress(spark: SparkSession, source: str, target: str) -> None:
    """A plain text tree as gzip: one file in a folder ``file={path under source}`` for each, its lines unchanged and in order; the last one ends with a line break."""
    files = spark.read.text(source, wholetext=True, recursiveFileLookup=True).select("value", F.col("_metadata.file_path").alias("path"))
    root = spark._jvm.org.apache.hadoop.fs.Path(source)
    base = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath().rstrip("/") + "/"
    name = F.substring_index(F.url_decode("path"), base, -1)
    files.select(F.regexp_replace("value", r"\n\z", "").alias("value"), name.alias("file")).write.partitionBy("file").option("compression", "gzip").text(target)
