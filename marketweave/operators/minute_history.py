"""A history of minute builds by year that can be stopped and gone on with: builds, their validation and the ledger of both.

The ledger is a log of numbered commits, each the state that a year has reached: building, built, validated or failed, with
the attempt, its folder, its numbers and what went wrong. A year's state is its last commit. Every attempt has a folder of its
own, so what failed stays to be looked at; a year that was built but not validated is only validated; validated years are
passed over. A run names a range of years, and the history's range is the widest of all runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import commits, files, footers, sinks
from . import minute, minute_audit
from .findings import COLUMNS

STATE = "number long, year int, attempt int, status string, folder string, rows long, partitions long, first_date date, last_date date, errors long, warnings long, error string"


class Failed(RuntimeError):
    """A year could not be built or validated."""


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """All states in the order in which they were reached."""
    last = commits.last(spark, f"{root}/_log")[0]
    names = [x.strip().split(" ")[0] for x in STATE.split(",")]
    rows = []
    for n in range(1, last + 1):  # some for each year and attempt
        content = commits.read(spark, f"{root}/_log", n)
        if "year" in content:
            rows.append(tuple({"number": n, **content}.get(c) for c in names))
    text = STATE.replace("first_date date, last_date date", "first_date string, last_date string")
    return spark.createDataFrame(rows, text).withColumns({c: F.col(c).cast("date") for c in ("first_date", "last_date")})


def states(spark: SparkSession, root: str) -> dict[int, dict]:
    """The last state of each year."""
    return {r["year"]: r.asDict() for r in ledger(spark, root).orderBy("number").collect()}


def years(spark: SparkSession, root: str) -> tuple[int, int] | None:
    """First and last year that any run has asked for."""
    last = commits.last(spark, f"{root}/_log")[0]
    asked = [c for c in (commits.read(spark, f"{root}/_log", n) for n in range(1, last + 1)) if "first" in c]
    return (min(c["first"] for c in asked), max(c["last"] for c in asked)) if asked else None


def _commit(spark: SparkSession, root: str, **content) -> None:
    commits.commit(spark, f"{root}/_log", lambda number, before: content)


def validate(spark: SparkSession, tree: str, told: DataFrame) -> DataFrame:
    """Findings of a built year: of its footers, and of its rows against their roll-ups and ``told`` (the build's numbers by frequency)."""
    return footers.findings(footers.scan(spark, tree), tree).unionByName(minute_audit.production(files.placed_minutes(spark, tree), told)).select(*COLUMNS)


def run(spark: SparkSession, root: str, first: int, last: int, source: Callable[[int], DataFrame], registry: DataFrame | None = None) -> dict[int, dict]:
    """Build and validate the years from ``first`` to ``last`` that are not validated yet; ``source`` gives a year's canonical 1-minute bars.

    The first year that fails ends the run with Failed; running again goes on with it. Findings of an attempt are kept in
    ``audit`` beside the builds; errors and warnings both fail a year. Returns the last state of each year.
    """
    _commit(spark, root, first=first, last=last)
    for year in range(first, last + 1):
        now = states(spark, root).get(year, {"status": None, "attempt": 0})
        if now["status"] == "validated":
            continue
        attempt, folder = now["attempt"], now.get("folder")
        try:
            if now["status"] != "built":
                attempt += 1
                folder = f"build/year={year}/attempt={attempt}"
                _commit(spark, root, year=year, attempt=attempt, status="building", folder=folder)
                made = minute.build(source(year), registry)
                if unresolved := made["unresolved"].take(1):
                    raise Failed(f"unresolved, for example {unresolved[0].asDict()}")
                sinks.minutes(made["bars"].select("frequency", "exchange", "trade_date", *minute.COLUMNS), f"{root}/{folder}")
                minute.build_statistics(spark.read.parquet(f"{root}/{folder}")).write.mode("overwrite").parquet(f"{root}/told/year={year}/attempt={attempt}")
                _commit(spark, root, year=year, attempt=attempt, status="built", folder=folder)
            told = spark.read.parquet(f"{root}/told/year={year}/attempt={attempt}")
            audit = f"{root}/audit/year={year}/attempt={attempt}"
            validate(spark, f"{root}/{folder}", told).write.mode("overwrite").parquet(audit)
            n = spark.read.parquet(audit).agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings")).first().asDict()
            s = told.agg(F.sum("rows").alias("rows"), F.sum("partitions").alias("partitions"), F.min("first_date").cast("string").alias("first_date"), F.max("last_date").cast("string").alias("last_date")).first().asDict()
            if n["errors"] or n["warnings"]:
                raise Failed(f"{n['errors']} errors and {n['warnings']} warnings in {audit}")
            _commit(spark, root, year=year, attempt=attempt, status="validated", folder=folder, **n, **s)
        except Exception as e:
            _commit(spark, root, year=year, attempt=attempt, status="failed", folder=folder, error=f"{type(e).__name__}: {e}"[:500])
            raise Failed(f"{year}, attempt {attempt}: {e}") from e
    return states(spark, root)


def read(spark: SparkSession, root: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Bars of the validated years, of each its validated attempt."""
    chosen = [s for y, s in sorted(states(spark, root).items()) if s["status"] == "validated" and (first is None or y >= first) and (last is None or y <= last)]
    if not chosen:
        raise KeyError("no validated year")
    out = None
    for s in chosen:
        rows = spark.read.parquet(f"{root}/{s['folder']}")
        out = rows if out is None else out.unionByName(rows)
    return out


def audit(spark: SparkSession, root: str, first: int | None = None, last: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Findings of the whole history with their ``year`` (null: of the history), and one roll-up row by year: stored findings of each year's last attempt, and years that are missing, not validated or have other dates than committed."""
    span = years(spark, root)
    if span is None:
        raise KeyError(f"no history in {root}")
    first, last = first or span[0], last or span[1]
    now = {y: s for y, s in states(spark, root).items() if first <= y <= last}
    found = None
    for y, s in sorted(now.items()):
        path = f"{root}/audit/year={y}/attempt={s['attempt']}"
        if commits.exists(spark, path):
            rows = spark.read.parquet(path).withColumn("year", F.lit(y))
            found = rows if found is None else found.unionByName(rows)
    valid = [f"{root}/{s['folder']}" for s in now.values() if s["status"] == "validated"]
    parts = None
    for p in valid:
        rows = spark.read.parquet(p).select("exchange", "trade_date").distinct()
        parts = rows if parts is None else parts.unionByName(rows)
    parts = parts if parts is not None else spark.createDataFrame([], "exchange string, trade_date date")
    told = spark.createDataFrame([(y, s["status"], s["first_date"], s["last_date"]) for y, s in now.items()], "year int, status string, first_date date, last_date date")
    whole = minute_audit.history(parts, told, first, last).withColumn("year", F.lit(None).cast("int"))
    found = whole.unionByName(found) if found is not None else whole
    kind = lambda s: F.count_if(F.col("severity") == s)
    summary = found.withColumn("year", F.coalesce("year", F.col("scope").try_cast("int"))).groupBy("year").agg(kind("error").alias("errors"), kind("warning").alias("warnings"))
    asked = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year")).join(told.select("year", "status"), "year", "left")
    rolled = asked.join(summary, "year", "left").select("year", F.coalesce("status", F.lit("missing")).alias("status"), F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("warnings", F.lit(0)).alias("warnings"))
    return found.select("year", *COLUMNS), rolled
