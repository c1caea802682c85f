"""Parquet trees judged by their footers: schema, codec, row groups, nulls and what the builder wrote down, without a row being read.

Files are listed by Spark; tasks read each file's last bytes and give a row for it. Findings are joins and aggregations over
these rows, so a tree of any number of files costs one small read for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.findings import COLUMNS, roll_up
from .members import opened

SCHEMA = (
    "path string, bytes long, problem string, rows long, row_groups int, most_rows long, codecs array<string>, fields array<struct<name: string, type: string>>, "
    "nulls array<struct<name: string, nulls: long>>, facts map<string, string>"
)
#: Columns of the minute tree's files: name and type. Fixed values.
MINUTES = [("symbol", "string"), ("trade_time", "timestamp[us, tz=UTC]"), ("open", "double"), ("high", "double"), ("low", "double"), ("close", "double"), ("volume", "int64"), ("amount", "double")]
ROW_GROUP = 65_536


def _footer(path: str, size: int) -> dict:
    row = {"path": path, "bytes": size, "problem": None, "rows": None, "row_groups": None, "most_rows": None, "codecs": [], "fields": [], "nulls": [], "facts": []}
    try:
        with opened(path) as file:
            meta = pq.read_metadata(file)
        schema = meta.schema.to_arrow_schema()
        groups = [g for g in map(meta.row_group, range(meta.num_row_groups)) if g.num_rows]
        nulls: dict[str, int | None] = {}
        for g in groups:
            for j in range(g.num_columns):
                c = g.column(j)
                n = c.statistics.null_count if c.statistics is not None and c.statistics.has_null_count else None
                name = c.path_in_schema.split(".", 1)[0]
                nulls[name] = None if n is None or nulls.get(name, 0) is None else nulls.get(name, 0) + n
        facts = {k.decode(errors="replace"): v.decode(errors="replace") for k, v in (meta.metadata or {}).items() if k != b"ARROW:schema"}
        row |= {"rows": meta.num_rows, "row_groups": len(groups), "most_rows": max((g.num_rows for g in groups), default=0), "codecs": sorted({g.column(j).compression.lower() for g in groups for j in range(g.num_columns)}),
                "fields": [{"name": f.name, "type": str(f.type)} for f in schema], "nulls": [{"name": k, "nulls": v} for k, v in nulls.items()], "facts": list(facts.items())}
    except (pa.ArrowException, OSError, EOFError) as e:
        row["problem"] = f"{type(e).__name__}: {e}"[:300]
    return row


def scan(spark: SparkSession, root: str, files_a_task: int = 200) -> DataFrame:
    """A row for each Parquet file under ``root``; ``problem`` tells why a footer could not be read (null: it could)."""
    kinds = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("problem", pa.string()), ("rows", pa.int64()), ("row_groups", pa.int32()), ("most_rows", pa.int64()), ("codecs", pa.list_(pa.string())),
                       ("fields", pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))), ("nulls", pa.list_(pa.struct([("name", pa.string()), ("nulls", pa.int64())]))), ("facts", pa.map_(pa.string(), pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if rows := [_footer(r["path"], r["bytes"]) for r in batch.to_pylist()]:
                yield from pa.Table.from_pylist(rows, schema=kinds).to_batches()

    # of the file source only the listing is asked for, no content
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root).select("path", F.col("length").alias("bytes"))
    tasks = max(1, -(-listed.count() // files_a_task))
    return listed.repartition(max(tasks, spark.sparkContext.defaultParallelism)).mapInArrow(run, SCHEMA)


def null_counts(footers: DataFrame) -> DataFrame:
    """path, column, nulls; null where a row group does not tell."""
    return footers.select("path", F.inline("nulls")).select("path", F.col("name").alias("column"), "nulls")


def drift(footers: DataFrame) -> DataFrame:
    """Each schema that files have, the commonest first: fields, files, an example path and ``rank`` from 1."""
    by = footers.filter("problem is null").groupBy("fields").agg(F.count("*").alias("files"), F.min("path").alias("example"))
    listed = by.agg(F.sort_array(F.collect_list(F.struct((-F.col("files")).alias("n"), "example", "fields"))).alias("x"))  # one entry a schema
    return listed.select(F.posexplode("x").alias("k", "x")).select((F.col("k") + 1).alias("rank"), (-F.col("x.n")).alias("files"), F.col("x.example").alias("example"), F.col("x.fields").alias("fields"))


def _one(rows: DataFrame, check: str, scope: Column, detail: Column, count: Column | int = 1, severity: str = "error") -> DataFrame:
    n = F.lit(count) if isinstance(count, int) else count
    return rows.select(F.lit(severity).alias("severity"), F.lit(check).alias("check"), scope.alias("scope"), n.cast("long").alias("count"), F.lit(None).cast("long").alias("total"), F.lit(None).cast("double").alias("max_abs_diff"), F.col("path").alias("example"), detail.cast("string").alias("detail"))


def findings(footers: DataFrame, root: str, fields: list[tuple[str, str]] = MINUTES, codec: str = "zstd", row_group: int = ROW_GROUP, facts: dict[str, str] | None = None) -> DataFrame:
    """Findings of a minute tree (frequency, exchange and trade_date in its paths), from ``scan``:

    unreadable files, paths that name no partition, partitions of several files, empty files, other columns or types than
    ``fields``, nulls (columns without counts: ``nulls_unknown``), other codecs, larger row groups than ``row_group``, and
    ``facts`` that the footers must have (a build id, a schema version) but do not.
    """
    base = root.rstrip("/")
    part = S.partition_parts("path")
    rows = footers.withColumn("part", part).withColumn("scope", F.regexp_extract("path", r"(frequency=[^/]*/exchange=[^/]*/trade_date=[^/]*)/", 1))
    rows = rows.withColumn("scope", F.when(F.col("scope") == "", F.substring_index("path", base.rsplit("/", 1)[-1] + "/", -1)).otherwise(F.col("scope")))
    scope = F.col("scope")
    good = rows.filter("problem is null")
    placed = F.col("part.frequency").isNotNull() & F.col("part.exchange").isNotNull() & F.col("part.trade_date").isNotNull()
    out = _one(rows.filter("problem is not null"), "unreadable_file", scope, F.col("problem"))
    out = out.unionByName(_one(rows.filter(~placed), "partition_path", scope, F.col("path")))
    several = rows.filter(placed).groupBy("part", "scope").agg(F.count("*").alias("files"), F.min("path").alias("path")).filter("files > 1")
    out = out.unionByName(_one(several, "duplicate_partition", scope, F.concat(F.col("files").cast("string"), F.lit(" files")), F.col("files")))
    out = out.unionByName(_one(good.filter("rows = 0"), "empty_partition", scope, F.lit("no rows")))
    want = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in fields])
    have = F.transform(F.col("fields"), lambda x: F.concat_ws(" ", x["name"], x["type"]))
    other = ~F.col("fields").eqNullSafe(want)
    out = out.unionByName(_one(good.filter(other), "schema_mismatch", scope, F.array_join(have, ", ")))
    nulls = good.select("path", "scope", F.inline("nulls")).filter("nulls > 0 or nulls is null")
    out = out.unionByName(_one(nulls.filter("nulls > 0"), "null_value", scope, F.concat_ws(" ", "name", F.col("nulls").cast("string")), F.col("nulls")))
    out = out.unionByName(_one(nulls.filter("nulls is null"), "nulls_unknown", scope, F.col("name"), severity="warning"))
    out = out.unionByName(_one(good.filter((F.size("codecs") > 0) & ~F.col("codecs").eqNullSafe(F.array(F.lit(codec)))), "codec_mismatch", scope, F.array_join("codecs", ",")))
    out = out.unionByName(_one(good.filter(F.col("most_rows") > row_group), "large_row_group", scope, F.col("most_rows"), severity="warning"))
    if facts:
        told = F.concat_ws(", ", *[F.when(~F.col("facts")[k].eqNullSafe(F.lit(v)), F.concat(F.lit(f"{k}="), F.coalesce(F.col("facts")[k], F.lit("none")), F.lit(f" expected {v}"))) for k, v in facts.items()])
        out = out.unionByName(_one(good.withColumn("told", told).filter("told <> ''"), "metadata_mismatch", scope, F.col("told")))
    return out.select(*COLUMNS)


class Unsound(ValueError):
    """Files of a tree do not fit each other or the product."""


def require(footers: DataFrame, root: str, **options) -> None:
    """Raise Unsound with an example if the footers have an error."""
    wrong = findings(footers, root, **options).filter("severity = 'error'")
    if (n := roll_up(wrong).first()["errors"]):
        first = wrong.orderBy("check", "scope").first()
        raise Unsound(f"{n} findings, for example {first['check']} in {first['scope']}: {first['detail']}")
