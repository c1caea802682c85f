"""SEC payloads: submissions and company facts to typed filings and facts, and their validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .findings import Check, file_order, run_checks, with_identity
from .merge import upsert_keep_first_seen

# Forms that are kept.
FORMS = ["10-K", "10-K/A", "10-Q", "10-Q/A", "8-K", "8-K/A", "20-F", "20-F/A", "40-F", "40-F/A", "6-K", "6-K/A"]
FACT_KEY = ["symbol", "cik", "taxonomy", "tag", "unit", "start_date", "end_date", "value", "filed_date", "form", "fiscal_year", "fiscal_period", "frame", "accession"]

_ARRAYS = "accessionNumber array<string>, filingDate array<string>, reportDate array<string>, acceptanceDateTime array<string>, form array<string>, primaryDocument array<string>, isXBRL array<string>, isInlineXBRL array<string>"
_FACT = "struct<start:string,end:string,val:decimal(38,12),accn:string,fy:string,fp:string,form:string,filed:string,frame:string>"
_FACTS = f"cik string, entityName string, facts map<string,map<string,struct<label:string,description:string,units:map<string,array<{_FACT}>>>>>"


def columnar(tables: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of structs of parallel arrays (column ``t``); unequal lengths give one row with ``reject``."""
    sizes = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(f"t.{c}").isNotNull(), F.size(F.col(f"t.{c}"))) for c in columns])))
    rest = [c for c in tables.columns if c != "t"]
    good = tables.filter(F.size(sizes) <= 1).select(*rest, F.inline(F.arrays_zip(*[F.coalesce(F.col(f"t.{c}"), F.array().cast("array<string>")).alias(c) for c in columns]))).withColumn("reject", F.lit(None).cast("string"))
    bad = tables.filter(F.size(sizes) > 1).select(*rest, *[F.lit(None).cast("string").alias(c) for c in columns], F.lit("unequal_lengths").alias("reject"))
    return good.unionByName(bad)


def filings(payloads: DataFrame) -> DataFrame:
    """payloads: symbol, cik, sequence (history files by number, the recent block last), recent (boolean), json, retrieved_at.

    Kept forms only; of an accession in several tables the one of the highest sequence stays. Rows that cannot be used
    have ``reject``.
    """
    names = [x.split()[0] for x in _ARRAYS.split(", ")]
    kind = f"struct<{', '.join(x.replace(' ', ':', 1) for x in _ARRAYS.split(', '))}>"
    deep = F.from_json("json", f"filings struct<recent {kind}>")["filings"]["recent"]
    tables = payloads.withColumn("t", F.when(F.col("recent"), deep).otherwise(F.from_json("json", _ARRAYS))).drop("json", "recent")
    rows = columnar(tables, names)
    form = F.upper(F.trim("form"))
    accepted = S.accepted_local("acceptanceDateTime")
    reject = F.coalesce(F.col("reject"), F.when(S.blank_to_null("accessionNumber").isNull(), "missing_accession").when(S.parse_date("filingDate").isNull(), "bad_filing_date").when(S.blank_to_null("acceptanceDateTime").isNotNull() & accepted.isNull(), "bad_acceptance_time"))
    out = rows.filter(form.isin(*FORMS) | F.col("reject").isNotNull()).select("symbol", "cik", F.trim("accessionNumber").alias("accession"), form.alias("form"), S.parse_date("filingDate").alias("filing_date"), S.parse_date("reportDate").alias("report_date"), accepted.alias("accepted_at"), F.trim("primaryDocument").alias("primary_document"), S.flag("isXBRL").alias("is_xbrl"), S.flag("isInlineXBRL").alias("is_inline_xbrl"), "retrieved_at", "sequence", reject.alias("reject"))
    good = out.filter("reject is null")
    rest = [c for c in good.columns if c not in ("symbol", "accession")]
    best = good.groupBy("symbol", "accession").agg(F.max_by(F.struct(*rest), F.struct("sequence", *rest)).alias("r")).select("symbol", "accession", "r.*")
    return best.unionByName(out.filter("reject is not null")).drop("sequence")


def facts(payloads: DataFrame, filing_rows: DataFrame) -> DataFrame:
    """payloads: symbol, cik, json, retrieved_at; filing_rows: symbol, accession, accepted_at. Numbers are exact decimals.

    The availability date is the local date of acceptance, else the filing date; row_id hashes the identifying fields.
    """
    parsed = payloads.withColumn("p", F.from_json("json", _FACTS)).select("symbol", "cik", "retrieved_at", F.explode("p.facts").alias("taxonomy", "tags"))
    tags = parsed.select("symbol", "cik", "retrieved_at", "taxonomy", F.explode("tags").alias("tag", "t"))
    units = tags.select("symbol", "cik", "retrieved_at", "taxonomy", "tag", "t.label", "t.description", F.explode("t.units").alias("unit", "rows"))
    rows = units.select("symbol", "cik", "retrieved_at", "taxonomy", "tag", "label", "description", "unit", F.inline("rows")).filter(F.upper(F.trim("form")).isin(*FORMS))
    typed = rows.select("symbol", "cik", "taxonomy", "tag", "label", "description", "unit", S.parse_date("start").alias("start_date"), S.parse_date("end").alias("end_date"), F.col("val").alias("value"), S.parse_date("filed").alias("filed_date"), F.upper(F.trim("form")).alias("form"), F.col("fy").alias("fiscal_year"), F.col("fp").alias("fiscal_period"), "frame", F.col("accn").alias("accession"), "retrieved_at")
    accepted = filing_rows.groupBy("symbol", "accession").agg(F.max("accepted_at").alias("accepted_at"))
    linked = typed.join(accepted, ["symbol", "accession"], "left").withColumn("available_date", S.available_date("accepted_at", "filed_date"))
    return with_row_id(linked).dropDuplicates(["row_id"])


def with_row_id(rows: DataFrame) -> DataFrame:
    return rows.withColumn("row_id", S.row_hash(*[S.decimal_text(c) if c == "value" else F.col(c) for c in FACT_KEY]))


def merge_filings(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return upsert_keep_first_seen(existing, incoming, ["symbol", "accession"])


def merge_facts(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return upsert_keep_first_seen(existing, incoming, ["row_id"])


def _empty(*names: str) -> Column:
    return F.array_contains(F.array(*[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]), "")


# What the products say of their source.
FILING_SOURCE = "sec.edgar.submissions"
FACT_SOURCE = "sec.edgar.companyfacts"


def validate_filings(rows: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Identity, forms, duplicates, dates and flags by symbol; where there are such columns, other sources than the product's and rows out of its order (``place``); with a ``universe`` (symbol, cik) ciks that are not the symbol's."""
    counted = rows.join(rows.groupBy("symbol", "accession").agg(F.count("*").alias("_n")), ["symbol", "accession"])
    key = F.col("accession")
    offset = F.col("accepted_at").rlike(r"[+-]\d{2}:\d{2}$")
    checks = [
        Check("identity", _empty("symbol", "cik", "accession", "form"), example=key), Check("unsupported_form", ~F.col("form").isin(*FORMS), example=key), Check("duplicate_accession", F.col("_n") > 1, example=key),
        Check("missing_filing_date", F.col("filing_date").isNull(), example=key), Check("accepted_without_offset", F.col("accepted_at").isNotNull() & ~offset, example=key), Check("missing_flag", F.col("is_xbrl").isNull() | F.col("is_inline_xbrl").isNull(), example=key),
    ]
    order = [F.coalesce(F.nullif("accepted_at", F.lit("")), F.col("filing_date").cast("string")), "filing_date", "accession"]
    return _with_product_checks(counted, checks, key, FILING_SOURCE, universe).unionByName(file_order(rows, ["symbol"], order))


def _with_product_checks(rows: DataFrame, checks: list[Check], key: Column, source: str, universe: DataFrame | None) -> DataFrame:
    if "source" in rows.columns:
        checks = [*checks, Check("source", ~F.col("source").eqNullSafe(source), example=key)]
    if universe is not None:
        rows, checks = with_identity(rows, universe), [*checks, Check("cik", ~F.col("cik").eqNullSafe(F.col("_cik")), example=key)]
    return run_checks(rows, checks, ["symbol"])


def validate_facts(rows: DataFrame, filing_rows: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Identity, dates, availability rule, recomputed row_id, duplicates; warnings for facts without a filing or known before their end; source, order and cik as in ``validate_filings``."""
    counts = rows.groupBy("row_id").agg(F.count("*").alias("_n"))
    linked = filing_rows.select("symbol", "accession").distinct().withColumn("_linked", F.lit(True))
    checked = with_row_id(rows.withColumnRenamed("row_id", "_id")).withColumnRenamed("row_id", "_again").withColumnRenamed("_id", "row_id").join(counts, "row_id").join(linked, ["symbol", "accession"], "left")
    key = F.col("row_id")
    rule = S.available_date("accepted_at", "filed_date")
    checks = [
        Check("identity", _empty("symbol", "cik", "taxonomy", "tag", "unit", "accession"), example=key), Check("missing_date", F.col("end_date").isNull() | F.col("filed_date").isNull() | F.col("available_date").isNull(), example=key),
        Check("start_after_end", F.col("start_date") > F.col("end_date"), example=key), Check("missing_value", F.col("value").isNull(), example=key), Check("available_date_rule", ~F.col("available_date").eqNullSafe(rule), example=key),
        Check("row_id", F.col("_again") != F.col("row_id"), example=key), Check("duplicate_row_id", F.col("_n") > 1, example=key), Check("unlinked_accession", F.col("_linked").isNull(), "warning", example=key), Check("available_before_end", F.col("available_date") < F.col("end_date"), "warning", example=key),
    ]
    order = ["available_date", "accepted_at", "filed_date", "accession", "taxonomy", "tag", "unit", "start_date", "end_date", "frame", "value", "row_id"]
    return _with_product_checks(checked, checks, key, FACT_SOURCE, universe).unionByName(file_order(rows, ["symbol"], [c for c in order if c in rows.columns]))
