"""Point-in-time reads: as-of selections, prior values, year-over-year matches, consecutive periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VERSION = ["available_date", "accepted_at", "accession"]


class NothingVisible(ValueError):
    pass


def select_snapshot(observations: DataFrame, decision_date, column: str = "observed_date") -> DataFrame:
    """Rows of the latest observation on or before the decision date; none raises NothingVisible."""
    visible = observations.filter(F.col(column) <= F.lit(decision_date).cast("date"))
    latest = visible.agg(F.max(column)).first()[0]
    if latest is None:
        raise NothingVisible(f"no observation on or before {decision_date}")
    return visible.filter(F.col(column) == F.lit(latest))


def as_of_dates(observations: DataFrame, dates: DataFrame, keys: list[str], column: str = "observed_date") -> DataFrame:
    """For every (keys, decision_date) the row latest on or before it; decisions before any observation have none.

    One union and one window instead of a range join: linear, whatever the number of dates.
    """
    rest = [c for c in observations.columns if c not in (*keys, column)]
    facts = observations.select(*keys, F.col(column).alias("_at"), F.lit(0).alias("_ask"), F.struct(F.col(column), *rest).alias("_row"))
    asks = dates.select(*keys, F.col("decision_date").alias("_at"), F.lit(1).alias("_ask"), F.lit(None).cast(facts.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy(*keys).orderBy("_at", "_ask").rowsBetween(Window.unboundedPreceding, 0)
    found = facts.unionByName(asks).withColumn("_found", F.last("_row", ignorenulls=True).over(w)).filter("_ask = 1 and _found is not null")
    return found.select(*keys, F.col("_at").alias("decision_date"), "_found.*")


def active_symbols(master: DataFrame, decision_date) -> DataFrame:
    """Symbols active in the security master observed latest on or before the decision date."""
    return select_snapshot(master, decision_date).filter("status_as_of = 'active'").select("symbol").distinct()


def latest_as_of(rows: DataFrame, as_of, keys: tuple[str, ...] = ("symbol",), stale_days: int = 180) -> DataFrame:
    """Per key the latest version of the latest report period visible at ``as_of``, its age in days and whether it is stale."""
    day = F.lit(as_of).cast("date")
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct("report_period", *VERSION, *[c for c in rest if c not in ("report_period", *VERSION)])
    best = rows.filter(F.col("available_date") <= day).groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*")
    age = F.datediff(day, F.col("report_period"))
    return best.withColumn("age_days", age).withColumn("stale", age > stale_days)


def latest_as_of_dates(rows: DataFrame, dates: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """The same for a table of (keys, as_of): versions sorted by availability, running greatest period."""
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct("report_period", *VERSION, *[c for c in rest if c not in ("report_period", *VERSION)])
    facts = rows.select(*keys, F.col("available_date").alias("_at"), F.lit(0).alias("_ask"), F.struct(order.alias("k"), F.struct(*rest).alias("v")).alias("_row"))
    asks = dates.select(*keys, F.col("as_of").alias("_at"), F.lit(1).alias("_ask"), F.lit(None).cast(facts.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy(*keys).orderBy("_at", "_ask").rowsBetween(Window.unboundedPreceding, 0)
    return facts.unionByName(asks).withColumn("_best", F.max("_row").over(w)).filter("_ask = 1 and _best is not null").select(*keys, F.col("_at").alias("as_of"), "_best.v.*")


def prior_price(profile: DataFrame) -> DataFrame:
    """Per row ``prior_price`` and its date: the latest earlier valid close of the symbol, else that row's preclose."""
    valid = lambda c: F.coalesce(F.col(c) > 0, F.lit(False)) & ~F.isnan(F.col(c).cast("double")) & (F.col(c).cast("double") < float("inf"))
    price = F.when(valid("close"), F.col("close")).when(valid("preclose"), F.col("preclose"))
    w = Window.partitionBy("exchange", "symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    known = F.last(F.when(price.isNotNull(), F.struct(price.alias("price"), F.col("date").alias("date"))), ignorenulls=True).over(w)
    return profile.withColumn("_prior", known).withColumn("prior_price", F.col("_prior.price")).withColumn("prior_date", F.col("_prior.date")).drop("_prior")


def prior_year(rows: DataFrame, metric: str, period_type: str = "period_type", fiscal_period: str = "fiscal_period") -> DataFrame:
    """``prior_value`` and ``yoy`` of each row: of rows of the same symbol and kind, visible at the time, 330 to 400 days before, the nearest to 365 days, then the latest available."""
    rows = rows.withColumn("_id", F.struct("report_period", *VERSION))
    now = rows.select("symbol", period_type, fiscal_period, "report_period", "available_date", "_id", F.col(metric).alias("value"))
    old = rows.filter(F.col(metric).isNotNull()).select("symbol", period_type, F.col(fiscal_period).alias("_fp"), F.col("report_period").alias("_end"), F.col("available_date").alias("_available"), F.col(metric).alias("_value"), F.col("accepted_at").alias("_accepted"), F.col("accession").alias("_accession"))
    # equal months apart narrow the interval to three equi-joined year-month buckets
    month = lambda c: F.year(c) * 12 + F.month(c)
    asks = now.filter("value is not null").withColumn("_m", F.explode(F.sequence(month("report_period") - 14, month("report_period") - 10)))
    gap = F.datediff("report_period", "_end")
    pairs = asks.join(old.withColumn("_m", month("_end")), ["symbol", period_type, "_m"]).filter(gap.between(330, 400) & (F.col("_available") <= F.col("available_date")) & ((F.col(period_type) != "quarterly") | (F.col(fiscal_period) == F.col("_fp"))))
    nearest = F.struct(F.abs(gap - 365), -F.datediff("_available", F.lit("1970-01-01").cast("date")), "_accepted", "_accession")
    best = pairs.groupBy("symbol", period_type, "_id").agg(F.min_by("_value", nearest).alias("prior_value"))
    out = rows.join(best, ["symbol", period_type, "_id"], "left").drop("_id")
    ratio = (F.col(metric).cast("decimal(24,4)") / F.nullif(F.col("prior_value").cast("decimal(24,4)"), F.lit(0).cast("decimal(24,4)")) - 1).cast("decimal(20,8)")
    return out.withColumn("yoy", ratio)


def consecutive_quarters(rows: DataFrame, labels: bool = True) -> DataFrame:
    """Per row of (symbol, report_period, fiscal_period) whether it ends four consecutive quarters: gaps of 45 to 150 days, a span of 250 to 430, labels that follow each other."""
    w = Window.partitionBy("symbol").orderBy("report_period")
    number = F.substring("fiscal_period", 2, 1).try_cast("int")
    step = F.lag("report_period").over(w)
    rows = rows.withColumn("_gap", F.datediff("report_period", step).between(45, 150)).withColumn("_next", F.coalesce(number % 4 == F.lag(number).over(w) % 4 + F.when(F.lag(number).over(w) % 4 == 3, -3).otherwise(1), F.lit(not labels)))
    ok = F.col("_gap") & (F.col("_next") if labels else F.lit(True))
    rows = rows.withColumn("_ok", ok)
    three = F.count_if(F.col("_ok")).over(w.rowsBetween(-2, 0)) == 3
    span = F.datediff("report_period", F.lag("report_period", 3).over(w)).between(250, 430)
    return rows.withColumn("consecutive", F.coalesce(three & span, F.lit(False))).drop("_gap", "_next", "_ok")


def contiguous(selected: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row: selected dates, the calendar dates between first and last of them, and whether these are all selected."""
    picked = selected.select("date").distinct()
    days = calendar.select("date").distinct().join(picked.withColumn("picked", F.lit(True)), "date", "left")
    ranked = days.withColumn("n", F.row_number().over(Window.orderBy("date"))).filter("picked")
    return ranked.agg(F.count("*").alias("selected"), (F.max("n") - F.min("n") + 1).alias("span")).withColumn("contiguous", F.col("selected") == F.col("span"))
