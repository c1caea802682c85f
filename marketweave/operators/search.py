"""Reads for exploring: instruments, facts and filings, with ranking and paging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fact_filter(facts: DataFrame, query: str = "", taxonomy: str | None = None, unit: str | None = None, form: str | None = None) -> DataFrame:
    """Exact taxonomy, unit and form; ``query`` anywhere in tag, label, description, accession or form, in any case."""
    for c, v in (("taxonomy", taxonomy), ("unit", unit), ("form", form)):
        if v:
            facts = facts.filter(F.col(c) == v)
    if query:
        hit = F.lit(False)
        for c in ("tag", "label", "description", "accession", "form"):
            if c in facts.columns:
                hit = hit | F.coalesce(F.lower(c).contains(query.lower()), F.lit(False))
        facts = facts.filter(hit)
    return facts


def filing_filter(filings: DataFrame, form: str | None = None) -> DataFrame:
    return filings.filter(F.col("form") == form) if form else filings


def page(rows: DataFrame, order: list, offset: int, limit: int) -> tuple[DataFrame, int]:
    """A page of the ordered rows, and how many there are in all."""
    return rows.orderBy(*order).offset(offset).limit(limit), rows.count()


def page_after(rows: DataFrame, order: list[tuple[str, bool]], limit: int, after: dict | None = None) -> DataFrame:
    """The next page behind ``after``, the last row of the page before (None: the first page); order: columns that tell rows apart, and whether each descends.

    Nulls come first in ascending and last in descending columns. What lies before the cursor is left out by a filter on the
    first column too, which prunes row groups of sorted files, so later pages read less and not more; how many rows there
    are is ``rows.count()``, and not asked for here.
    """
    keys = [F.desc(c) if down else F.asc(c) for c, down in order]
    if after is not None:
        behind, same = F.lit(False), F.lit(True)
        for c, down in order:
            value = F.lit(after[c]).cast(rows.schema[c].dataType)
            if after[c] is None:
                further = F.lit(False) if down else F.col(c).isNotNull()
            else:
                further = F.coalesce(F.col(c) < value, F.lit(True)) if down else F.coalesce(F.col(c) > value, F.lit(False))
            behind = behind | (same & further)
            same = same & F.col(c).eqNullSafe(value)
        name, down = order[0]
        if after[name] is not None:
            value = F.lit(after[name]).cast(rows.schema[name].dataType)
            rows = rows.filter((F.col(name) <= value) | F.col(name).isNull() if down else F.col(name) >= value)
        rows = rows.filter(behind)
    return rows.orderBy(*keys).limit(limit)


def fact_series(facts: DataFrame, taxonomy: str, tag: str, unit: str) -> DataFrame:
    """Facts of one concept per symbol with the label of the last one, and whether the value can be drawn."""
    rows = facts.filter((F.col("taxonomy") == taxonomy) & (F.col("tag") == tag) & (F.col("unit") == unit))
    label = rows.groupBy("symbol").agg(F.max_by("label", F.struct("end_date", "available_date", "accession")).alias("series_label"))
    value = F.col("value").cast("string").try_cast("double")
    return rows.join(label, "symbol").withColumn("point", F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value))


def fact_summary(facts: DataFrame) -> DataFrame:
    """Per symbol: facts, distinct concepts, ranges of end and available dates, latest retrieval."""
    return facts.groupBy("symbol").agg(F.count("*").alias("facts"), F.countDistinct("taxonomy", "tag").alias("concepts"), F.min("end_date").alias("first_end"), F.max("end_date").alias("last_end"), F.min("available_date").alias("first_available"), F.max("available_date").alias("last_available"), F.max("retrieved_at").alias("last_retrieved"))


def value_counts(facts: DataFrame, columns: tuple[str, ...] = ("taxonomy", "unit", "form", "fiscal_period")) -> DataFrame:
    """field, value, count for each of the columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    return facts.select(F.inline(pairs)).groupBy("field", "value").agg(F.count("*").alias("count"))


def top_concepts(facts: DataFrame, n: int = 12) -> DataFrame:
    return facts.groupBy("taxonomy", "tag", "unit").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "taxonomy", "tag", "unit").limit(n)


def instruments(metadata: DataFrame, from_files: DataFrame, from_archives: DataFrame) -> DataFrame:
    """market, symbol, name and source: metadata first, files and archives only add."""
    from .merge import union_first

    return union_first([metadata, from_files, from_archives], ["market", "symbol"])


def with_fundamentals(rows: DataFrame, facts: DataFrame, filings: DataFrame) -> DataFrame:
    """has_fundamentals: a US stock that both facts and filings know."""
    a = facts.select("symbol").distinct().withColumn("_a", F.lit(True))
    b = filings.select("symbol").distinct().withColumn("_b", F.lit(True))
    out = rows.join(a, "symbol", "left").join(b, "symbol", "left")
    us = (F.col("market") == "us") & (F.coalesce("asset_type", F.lit("")) == "stock") if "asset_type" in rows.columns else F.col("market") == "us"
    return out.withColumn("has_fundamentals", F.coalesce(us & F.col("_a") & F.col("_b"), F.lit(False))).drop("_a", "_b")


def search(rows: DataFrame, query: str = "", market: str | None = None, limit: int = 20) -> DataFrame:
    """Instruments with the query in symbol or name; symbol prefixes first, then name prefixes, then by symbol. Without a query US ones first."""
    if market:
        rows = rows.filter(F.col("market") == market)
    q = query.strip().upper()
    symbol, name = F.upper("symbol"), F.upper(F.coalesce("name", F.lit("")))
    if not q:
        return rows.orderBy(F.when(F.col("market") == "us", 0).otherwise(1), "symbol").limit(limit)
    rank = F.when(symbol.startswith(q), 0).when(name.startswith(q), 1).otherwise(2)
    return rows.filter(symbol.contains(q) | name.contains(q)).orderBy(rank, "symbol").limit(limit)


def with_names(rows: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """``column`` from a table of symbols; Spark broadcasts that table where it is small."""
    return rows.join(names.select("symbol", column).dropDuplicates(["symbol"]), "symbol", "left")
