"""Keyed merges of incoming deliveries into what is there, and set checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..settled import settle
from ..sources import commits, sinks


class InvalidKeys(ValueError):
    pass


#: Bytes of a delta's keys that may be broadcast, as measured.
BROADCAST_BYTES = 24_000_000


def _last(rows: DataFrame, keys: list[str], order: list[Column], descending: bool = True) -> DataFrame:
    """One row of each key, the greatest (or least) by ``order`` and then by its other columns: one exchange and one sort, of ``rows`` only."""
    rest = [F.col(c) for c in rows.columns if c not in keys]
    by = [c.desc() if descending else c.asc() for c in [*order, *rest]]
    if not by:
        return rows.select(*keys).distinct()
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).filter("_rank = 1").drop("_rank")


def _keyed_join(rows: DataFrame, few: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``rows`` that have (left_semi) or have not (left_anti) a key of the settled ``few``, nulls being equal: by a broadcast of measured size, beyond it by hashes of ``few``. Neither sorts ``rows``."""
    size = few.agg(F.sum(sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) + 24 for k in keys), F.lit(16)).cast("long"))).first()[0] or 0
    small = few.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    small = F.broadcast(small) if size <= BROADCAST_BYTES else small.hint("shuffle_hash")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(small, same, how)


def _resolved(existing: DataFrame, keys: list[str], order: list[Column], seen: str | None = None) -> DataFrame:
    """``existing`` with one row a key. Keys are counted without their rows; only rows of keys that repeat are ranked, and take the least ``seen`` of their key."""
    again = settle(existing.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys), "repeated")
    if again.isEmpty():
        return existing
    some = _keyed_join(existing, again, keys, "left_semi")
    if seen:
        some = some.withColumn(seen, F.min(seen).over(Window.partitionBy(*keys)))
    return _keyed_join(existing, again, keys, "left_anti").unionByName(_last(some, keys, order))


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column] | None = None, unique: bool = False) -> DataFrame:
    """Union by key in which incoming rows win; columns that only one side has are null on the other.

    Of several rows with one key on a side, the last by ``order`` wins (default: the greatest row); with ``unique`` the
    existing rows are known to have none, as those that an upsert wrote. The work that needs order or a shuffle of rows is
    that of the delivery: it is settled, and existing rows pass unless they have one of its keys.
    """
    delta = settle(_last(incoming, keys, order or []), "delta")
    kept = _keyed_join(existing if unique else _resolved(existing, keys, order or []), delta, keys, "left_anti")
    out = kept.unionByName(delta, allowMissingColumns=True)
    return out.select(*keys, *[c for c in out.columns if c not in keys])


def upsert_keep_first_seen(existing: DataFrame, incoming: DataFrame, keys: list[str], seen: str = "retrieved_at", unique: bool = False) -> DataFrame:
    """As ``upsert``, but a key that was there keeps its first ``seen`` value; only the existing rows of the delivery's keys are looked up for it."""
    delta = settle(_last(incoming, keys, []), "delta")
    first = _keyed_join(existing, delta, keys, "left_semi").groupBy(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)]).agg(F.min(seen).alias("_seen"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_s{i}"))
    delta = settle(delta.join(first, same, "left").withColumn(seen, F.coalesce("_seen", seen)).drop("_seen", *[f"_s{i}" for i in range(len(keys))]), "delta-seen")
    kept = _keyed_join(existing if unique else _resolved(existing, keys, [], seen), delta, keys, "left_anti")
    out = kept.unionByName(delta, allowMissingColumns=True)
    return out.select(*keys, *[c for c in out.columns if c not in keys])


def strict_upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """As ``upsert``; incomplete keys on either side, or repeated ones among the existing, raise InvalidKeys."""
    wrong = key_findings(existing, keys).filter("repeated or incomplete").unionByName(key_findings(incoming, keys).filter("incomplete")).take(1)
    if wrong:
        raise InvalidKeys(f"bad keys, for example {wrong[0].asDict()}")
    return upsert(existing, incoming, keys, unique=True)


def key_findings(rows: DataFrame, keys: list[str]) -> DataFrame:
    incomplete = F.array_contains(F.array(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), "")
    return rows.groupBy(*keys).agg((F.count("*") > 1).alias("repeated")).withColumn("incomplete", incomplete)


def latest_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by the order columns."""
    return _last(rows, keys, [F.col(c) for c in order])


def earliest_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _last(rows, keys, [F.col(c) for c in order], descending=False)


def union_first(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of all sources; for a key the first source that has it, others only add."""
    out = None
    for k, df in enumerate(sources):
        df = df.withColumn("_side", F.lit(k))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in (*keys, "_side")]
    return _last(out, keys, [F.col("_side")], descending=False).select(*keys, *rest)


def fill_blanks(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer union by key; a new value replaces the old one unless it is null or empty."""
    values = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    a = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in old.columns if c not in keys])
    b = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in new.columns if c not in keys])
    joined = a.join(b, keys, "full_outer")

    def pick(c: str) -> Column:
        sides = []
        if c in new.columns:
            is_text = dict(new.dtypes)[c] == "string"
            sides.append(F.nullif(F.col(f"_n_{c}"), F.lit("")) if is_text else F.col(f"_n_{c}"))
        if c in old.columns:
            sides.append(F.col(f"_o_{c}"))
        return F.coalesce(*sides).alias(c)

    return joined.select(*keys, *map(pick, values))


def merge_versions(rows: DataFrame, keys: list[str], metrics: list[str], sequence: str, flags: str | None = None) -> DataFrame:
    """One row per key: for each metric the first value that is not null by ``sequence``; flags are united."""
    order = F.col(sequence)
    out = [F.min_by(m, F.when(F.col(m).isNotNull(), order)).alias(m) for m in metrics]
    if flags:
        out.append(F.sort_array(F.array_distinct(F.flatten(F.collect_list(flags)))).alias(flags))
    return rows.groupBy(*keys).agg(*out)


def changed_actions(existing: DataFrame, incoming: DataFrame, keys: tuple[str, ...] = ("asset_type", "symbol")) -> DataFrame:
    """Assets whose delivery changes a dividend or split: an action on either side of a row that is new or differs."""
    old = existing.select(*keys, "date", F.col("dividend").alias("old_dividend"), F.col("split_factor").alias("old_split"), F.lit(True).alias("there"))
    joined = incoming.select(*keys, "date", "dividend", "split_factor").join(old, [*keys, "date"], "left")
    action = (F.col("dividend") != 0) | (F.col("split_factor") != 1) | (F.coalesce("old_dividend", F.lit(0.0)) != 0) | (F.coalesce("old_split", F.lit(1.0)) != 1)
    differs = F.col("there").isNull() | ~F.col("dividend").eqNullSafe(F.col("old_dividend")) | ~F.col("split_factor").eqNullSafe(F.col("old_split"))
    return joined.groupBy(*keys).agg(F.bool_or(action & differs).alias("changed")).filter("changed").select(*keys)


def incremental_us(existing: DataFrame, incoming: DataFrame, refreshed: DataFrame, findings=None) -> tuple[DataFrame, DataFrame]:
    """Merged US bars, and the assets to fetch in full.

    Assets with a changed action take their rows from ``refreshed``, if it has any, and stay as they are otherwise. An
    asset whose merged rows have an error keeps its old rows (``findings``: rows -> findings with scope asset_type/symbol).
    """
    keys = ["asset_type", "symbol"]
    changed = changed_actions(existing, incoming)
    whole = refreshed.join(changed, keys, "left_semi")
    waiting = changed.join(whole.select(*keys).distinct(), keys, "left_anti")
    kept = existing.join(whole.select(*keys).distinct(), keys, "left_anti")
    merged = upsert(kept, incoming.join(changed, keys, "left_anti"), [*keys, "date"]).select(*existing.columns).unionByName(whole.select(*existing.columns))
    if findings is not None:
        bad = findings(merged).filter("severity = 'error'").select(F.substring_index("scope", "/", 1).alias("asset_type"), F.substring_index("scope", "/", -1).alias("symbol")).distinct()
        merged = merged.join(bad, keys, "left_anti").unionByName(existing.join(bad, keys, "left_semi"))
    return merged, waiting


def update_window(configured: Column, latest: Column, end: Column, lookback: int) -> tuple[Column, Column]:
    """First and last date of an incremental update."""
    from ..functions.scalars import overlap_start

    return overlap_start(configured, latest, lookback), end


def update_daily(profile: DataFrame, history: DataFrame, incoming: DataFrame, end, lookback: int, full_start) -> tuple[DataFrame, DataFrame, DataFrame]:
    """An incremental update: the profile, the symbols' histories, and the (exchange, date) partitions that were replaced.

    Per exchange the window goes from ``lookback`` days before its last date (``full_start`` where it has none) to ``end``;
    incoming rows outside are left out. Partitions of the window that have incoming rows are replaced whole; histories are
    merged by (symbol, date, adjust), incoming rows first.
    """
    from ..functions.scalars import overlap_start

    last = profile.groupBy("exchange").agg(F.max("date").alias("_last"))
    inside = incoming.join(last, "exchange", "left").withColumn("_first", overlap_start(F.lit(full_start).cast("date"), F.col("_last"), lookback))
    new = inside.filter(F.col("date").between(F.col("_first"), F.lit(end).cast("date"))).drop("_last", "_first")
    touched = new.select("exchange", "date").distinct()
    kept = profile.join(touched, ["exchange", "date"], "left_anti")
    return kept.unionByName(new, allowMissingColumns=True), upsert(history, new, ["symbol", "date", "adjust"]), touched


def update_daily_files(spark: SparkSession, profile_path: str, history_path: str, incoming: DataFrame, end, lookback: int, full_start) -> DataFrame:
    """``update_daily`` on stored trees; returns the (exchange, date) partitions that were written.

    The profile (by exchange and date) gets the partitions of the window that have incoming rows, replaced whole; the
    histories (by symbol) those of symbols with incoming rows, merged by (symbol, date, adjust). Dates already there come from
    the names of partitions. Files of all other partitions stay as they are. Histories are written after the profile; an
    update that broke off is done again by running it again.
    """
    from ..functions.scalars import overlap_start

    if commits.exists(spark, profile_path):
        last = spark.read.parquet(profile_path).groupBy("exchange").agg(F.max("date").alias("_last"))
    else:
        last = spark.createDataFrame([], "exchange string, _last date")
    inside = incoming.join(last, "exchange", "left").withColumn("_first", overlap_start(F.lit(full_start).cast("date"), F.col("_last"), lookback))
    new = settle(inside.filter(F.col("date").between(F.col("_first"), F.lit(end).cast("date"))).drop("_last", "_first"), "daily-delta")
    touched = settle(new.select("exchange", "date").distinct(), "touched")
    if touched.isEmpty():
        return touched
    sinks.by_date(new, profile_path)
    symbols = settle(new.select("symbol").distinct(), "symbols")
    merged = _last(new, ["symbol", "date", "adjust"], [])
    if commits.exists(spark, history_path):
        # of the stored histories only the folders of these symbols are read
        own = spark.read.schema(new.schema).parquet(history_path).join(F.broadcast(symbols) if symbols.count() <= 100_000 else symbols, "symbol", "left_semi")
        merged = upsert(own, merged, ["symbol", "date", "adjust"], unique=True).select(*new.columns)
    sinks.by_symbol(settle(merged, "histories"), history_path, ["date", "adjust"], form="parquet")
    return touched


def overlap(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on both sides; must be empty for disjoint sets."""
    return a.select(*keys).intersect(b.select(*keys))


def unknown(requested: DataFrame, available: DataFrame, keys: list[str]) -> DataFrame:
    """Requested keys that are not available."""
    return requested.select(*keys).distinct().join(available.select(*keys).distinct(), keys, "left_anti")


def period_gaps(universe: DataFrame, seen: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """(symbol, year, quarter) of the requested grid that has not been seen."""
    grid = universe.select("symbol").distinct().withColumn("year", F.explode(F.sequence(F.lit(first_year), F.lit(last_year)))).withColumn("quarter", F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))))
    return grid.join(seen.select("symbol", "year", "quarter").distinct(), ["symbol", "year", "quarter"], "left_anti")


def coverage(universe: DataFrame, cached: DataFrame, end) -> DataFrame:
    """Per symbol whether its cache reaches the requested end, or its delisting date if that is earlier; universe: symbol, delisting_date."""
    last = cached.groupBy("symbol").agg(F.max("date").alias("last_date"))
    need = F.least(F.lit(end).cast("date"), F.coalesce("delisting_date", F.lit(end).cast("date")))
    return universe.join(last, "symbol", "left").select("symbol", "last_date", need.alias("required_date"), F.coalesce(F.col("last_date") >= need, F.lit(False)).alias("covered"))


def with_board(profile: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The profile with its board column filled in, and per (exchange, date) how many rows that changes."""
    from ..functions.scalars import board

    old = F.col("board") if "board" in profile.columns else F.lit(None).cast("string")
    new = board("symbol")
    changes = profile.select("exchange", "date", (~old.eqNullSafe(new)).alias("changed")).groupBy("exchange", "date").agg(F.count_if("changed").alias("changed_rows")).filter("changed_rows > 0")
    if "board" in profile.columns:
        return profile.withColumn("board", new), changes
    at = profile.columns.index("exchange") + 1
    return profile.select(*profile.columns[:at], new.alias("board"), *profile.columns[at:]), changes


def numbered(rows: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")
