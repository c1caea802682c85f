"""Versioned snapshots of daily partitions: publish gate, repair, content digest, manifest, verification."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..settled import settle
from ..sources import commits
from .pit import prior_price

PRICES = ["open", "high", "low", "close"]
KEY = ["exchange", "date"]


class Blocked(ValueError):
    """A partition does not pass the gate."""


def repair_suspended(profile: DataFrame) -> DataFrame:
    """Suspended rows (trade_status 0): missing open to close become 0; a missing preclose the prior price of the symbol.

    ``backfill`` tells what was done; ``no_prior_price`` marks rows that had nothing to take, which the gate stops.
    """
    rows = prior_price(profile)
    suspended = F.col("trade_status") == 0
    blank = F.lit(True)
    for c in PRICES:
        blank = blank & F.col(c).isNull()
    fill = suspended & blank
    none = fill & F.col("preclose").isNull()
    out = {c: F.when(fill, F.lit(0.0)).otherwise(F.col(c)) for c in PRICES} | {"preclose": F.when(none, F.col("prior_price")).otherwise(F.col("preclose"))}
    what = F.when(none & F.col("prior_price").isNull(), "no_prior_price").when(none, "prior_price").when(fill, "zero_ohlc")
    kept = [c for c in profile.columns if c not in out]
    return rows.select(*kept, *[v.alias(c) for c, v in out.items()], what.alias("backfill"), F.when(none, F.col("prior_date")).alias("backfill_date"))


def violations(profile: DataFrame, adjust: str = "qfq") -> DataFrame:
    """One row per (exchange, date, symbol) and rule that it breaks."""
    number = lambda c: S.finite(F.col(c).cast("double"))
    o, h, low, c, pre = (number(x) for x in (*PRICES, "preclose"))
    any_null = o.isNull() | h.isNull() | low.isNull() | c.isNull() | pre.isNull()
    tradable = F.col("trade_status") == 1
    copies = profile.groupBy(*KEY, "symbol").agg((F.count("*") > 1).alias("_repeated"))
    suffix = F.upper(F.substring_index("symbol", ".", -1))
    active = lambda x: F.col(x).isNull() & tradable | (number(x) < 0)
    rules = {
        "symbol": ~F.coalesce(F.col("symbol").rlike(r"^\d{6}\.(SZ|SH|BJ)$"), F.lit(False)),
        "exchange": suffix != F.upper("exchange"),
        "duplicate_symbol": F.col("_repeated"),
        "missing_price": any_null,
        "preclose": pre <= 0,
        "trade_status": ~F.coalesce(F.col("trade_status").isin(0, 1), F.lit(False)),
        "tradable_price": tradable & (F.least(o, h, low, c) <= 0),
        "envelope": (low > F.least(o, c)) | (h < F.greatest(o, c)),
        "activity": active("volume") | active("amount"),
        "adjust": ~F.col("adjust").eqNullSafe(adjust),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]))
    return profile.join(copies, [*KEY, "symbol"]).select(*KEY, "symbol", F.explode(found).alias("rule"))


def partition_digest(profile: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per partition its rows and a digest that does not depend on their order and combines before the shuffle."""
    columns = columns or sorted(c for c in profile.columns if c not in KEY)
    # a value has a mark before it, so that an empty text is not a null
    text = F.concat_ws("\u001f", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns])
    number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")
    sums = profile.groupBy(*KEY).agg(F.count("*").alias("rows"), F.sum(number).cast("decimal(38,0)").alias("_sum"))
    return sums.select(*KEY, "rows", F.sha2(F.concat_ws(":", F.col("rows").cast("string"), F.col("_sum").cast("string")), 256).alias("digest"))


def latest_dates(profile: DataFrame, exchanges: list[str], count: int) -> DataFrame:
    """The last ``count`` dates that every exchange has; fewer raise Blocked."""
    if count <= 0:
        raise ValueError("count must be over 0")
    whole = profile.filter(F.col("exchange").isin(*exchanges)).groupBy("date").agg(F.countDistinct("exchange").alias("n")).filter(F.col("n") == len(exchanges)).select("date").orderBy(F.desc("date")).limit(count)
    if whole.count() < count:
        raise Blocked(f"fewer than {count} complete dates")
    return whole


def identity(parts: DataFrame, level: str = "PASS") -> DataFrame:
    """One row: snapshot_id, level, as_of, partitions and rows of partition digests. The id is a hash over the years' hashes, and these over their sorted partitions, so no task sees all of them."""
    if level not in ("PASS", "RESEARCH_ONLY"):
        raise ValueError(f"unknown level {level}")
    line = F.concat_ws(":", "exchange", F.date_format("date", "yyyy-MM-dd"), F.col("rows").cast("string"), "digest")
    years = parts.groupBy(F.date_format("date", "yyyy").alias("year")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "|"), 256).alias("digest"), F.max("date").alias("as_of"), F.count("*").alias("partitions"), F.sum("rows").alias("rows"))
    listed = F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "year", "digest"))), "|")
    out = years.agg(listed.alias("years"), F.max("as_of").alias("as_of"), F.sum("partitions").alias("partitions"), F.sum("rows").alias("rows"))
    return out.select(F.sha2(F.concat(F.lit(level), F.lit("|"), "years"), 256).alias("snapshot_id"), F.lit(level).alias("level"), "as_of", "partitions", "rows")


def manifest(profile: DataFrame, level: str = "PASS", columns: list[str] | None = None) -> DataFrame:
    """``identity`` of a profile's partitions by ``partition_digest``."""
    return identity(partition_digest(profile, columns), level)


def _address() -> Column:
    """Where a partition is stored: a hash of its exchange, date and digest."""
    return F.sha2(F.concat_ws(":", "exchange", F.date_format("date", "yyyy-MM-dd"), "digest"), 256)


def publish(profile: DataFrame, path: str, exchanges: list[str], level: str = "PASS") -> str:
    """Publish a profile as a snapshot: a list of partitions, each of which is stored once, under its content's address.

    Partitions that some snapshot has are neither written nor gated again. The others are written aside, gated and digested
    as they stand there, and moved to their addresses; then the list is written, and a numbered commit makes it visible. A
    partition that another writer stored meanwhile is the same one. The same content again leaves all as it is.
    """
    spark = profile.sparkSession
    parts = settle(partition_digest(profile).withColumn("address", _address()), "digests")
    lacking = parts.groupBy("date").agg(F.countDistinct("exchange").alias("n")).filter(F.col("n") < len(exchanges)).take(1)
    if lacking:
        raise Blocked(f"an exchange is missing on {lacking[0]['date']}")
    found = identity(parts, level).first()
    snapshot = found["snapshot_id"]
    listed = f"{path}/partitions/snapshot_id={snapshot}"
    if _committed(spark, path, snapshot) is not None:
        return snapshot
    stored = spark.createDataFrame([(n.removeprefix("address="),) for n in commits.names(spark, f"{path}/parts") if n.startswith("address=")], "address string")
    fresh = settle(parts.join(stored, "address", "left_anti"), "fresh")
    staged = f"{path}/staging/{uuid.uuid4().hex}"
    try:
        if not fresh.isEmpty():
            rows = profile.join(fresh.select(*KEY, "address"), KEY)
            rows.repartition("address").write.partitionBy("address").parquet(staged)
            there = spark.read.schema(T.StructType([*profile.schema.fields, T.StructField("address", T.StringType())])).parquet(staged)
            if bad := violations(there.drop("address")).take(1):
                raise Blocked(f"violations, for example {bad[0].asDict()}")
            now = partition_digest(there.drop("address")).select(_address().alias("address"))
            if not now.exceptAll(fresh.select("address")).isEmpty() or not fresh.select("address").exceptAll(now).isEmpty():
                raise OSError("the profile changed while it was written")
            for name in commits.names(spark, staged):
                if name.startswith("address="):
                    commits.rename(spark, f"{staged}/{name}", f"{path}/parts/{name}")
        parts.repartition(1).sortWithinPartitions(*KEY).write.mode("overwrite").parquet(listed)
        told = {"snapshot_id": snapshot, "level": level, "as_of": str(found["as_of"]), "partitions": found["partitions"], "rows": found["rows"], "schema": profile.schema.json(), "exchanges": sorted(exchanges)}
        commits.commit(spark, f"{path}/_log", lambda number, before: told)
        return snapshot
    finally:
        commits.delete(spark, staged)


def _committed(spark: SparkSession, path: str, snapshot: str) -> dict | None:
    """The first commit of a snapshot; the log has one small file for each publication."""
    for n in range(1, commits.last(spark, f"{path}/_log")[0] + 1):
        if (content := commits.read(spark, f"{path}/_log", n))["snapshot_id"] == snapshot:
            return content
    return None


def listed(spark: SparkSession, path: str, snapshot: str | None = None) -> tuple[dict, DataFrame]:
    """What was committed of a snapshot (default: the last one), and its partitions: exchange, date, rows, digest, address."""
    told = commits.last(spark, f"{path}/_log")[1] if snapshot is None else _committed(spark, path, snapshot)
    if told is None:
        raise KeyError(f"no snapshot {snapshot or ''} in {path}")
    return told, spark.read.schema("exchange string, date date, rows long, digest string, address string").parquet(f"{path}/partitions/snapshot_id={told['snapshot_id']}")


def resolve(spark: SparkSession, path: str, snapshot: str | None = None) -> DataFrame:
    """Rows of a pinned snapshot, or of the one published last."""
    told, parts = listed(spark, path, snapshot)
    there = set(commits.names(spark, f"{path}/parts"))
    folders = [f"{path}/parts/address={r['address']}" for r in parts.select("address").collect() if f"address={r['address']}" in there]
    schema = T.StructType.fromJson(json.loads(told["schema"]))
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def verify(spark: SparkSession, path: str, snapshot: str) -> DataFrame:
    """Partitions whose rows or digest differ from the manifest, or that only one side has; empty if all is well."""
    stored = listed(spark, path, snapshot)[1].select(*KEY, F.col("rows").alias("want_rows"), F.col("digest").alias("want_digest"))
    now = partition_digest(resolve(spark, path, snapshot)).select(F.col("exchange").cast("string").alias("exchange"), F.col("date").cast("date").alias("date"), "rows", "digest")
    return stored.join(now, KEY, "full_outer").filter(~F.col("rows").eqNullSafe(F.col("want_rows")) | ~F.col("digest").eqNullSafe(F.col("want_digest")))


def validate_manifest(spark: SparkSession, path: str, snapshot: str) -> DataFrame:
    """Findings of a stored manifest, without reading rows: an id that its partitions do not give, other counts or dates than committed, repeated partitions, dates that lack an exchange, addresses that are not their content's, and partitions that are not stored."""
    told, parts = listed(spark, path, snapshot)
    one = lambda rows, check, scope, detail: rows.select(F.lit("error").alias("severity"), F.lit(check).alias("check"), scope.cast("string").alias("scope"), detail.cast("string").alias("detail"))
    now = identity(parts, told["level"])
    out = one(now.filter(F.col("snapshot_id") != snapshot), "snapshot_id", F.lit(snapshot), F.col("snapshot_id"))
    for c in ("partitions", "rows", "as_of"):
        out = out.unionByName(one(now.filter(~F.col(c).cast("string").eqNullSafe(F.lit(str(told[c])))), c, F.lit(snapshot), F.concat(F.lit(f"{told[c]} committed, "), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(" listed"))))
    key = F.concat_ws("/", "exchange", F.col("date").cast("string"))
    out = out.unionByName(one(parts.groupBy(*KEY).count().filter("count > 1"), "duplicate_partition", key, F.col("count")))
    dates = parts.groupBy("date").agg(F.array_join(F.array_except(F.array(*map(F.lit, told["exchanges"])), F.collect_set("exchange")), ",").alias("lacking"))
    out = out.unionByName(one(dates.filter("lacking <> ''"), "incomplete_date", F.col("date"), F.col("lacking")))
    out = out.unionByName(one(parts.filter(F.col("address") != _address()), "address", key, F.col("address")))
    stored = spark.createDataFrame([(n.removeprefix("address="),) for n in commits.names(spark, f"{path}/parts") if n.startswith("address=")], "address string")
    return out.unionByName(one(parts.join(stored, "address", "left_anti"), "missing_partition", key, F.col("address")))


def evidence_issues(partitions: DataFrame, evidence: DataFrame) -> DataFrame:
    """Partitions (exchange, date, evidence_hash) whose run (hash, exchange, start_date, end_date, status, failed) is absent, not completed, has failures, or does not cover them."""
    e = evidence.select(F.col("hash").alias("evidence_hash"), F.col("exchange").alias("e_exchange"), "start_date", "end_date", "status", "failed")
    joined = partitions.join(e, "evidence_hash", "left")
    issue = F.when(F.col("status").isNull(), "missing_evidence").when(F.col("status") != "completed", "not_completed").when(F.col("failed") > 0, "failures").when(F.col("e_exchange") != F.col("exchange"), "other_exchange").when(~F.col("date").between(F.col("start_date"), F.col("end_date")), "date_not_covered")
    return joined.withColumn("issue", issue).filter("issue is not null").select("exchange", "date", "evidence_hash", "issue")
