"""Schemas of the products, as Spark DDL text."""

from __future__ import annotations

PROFILE = "date date, symbol string, exchange string, board string, open double, high double, low double, close double, preclose double, volume double, volume_unit string, amount double, turnover_rate double, pct_change double, pe_ttm double, pb_mrq double, ps_ttm double, pcf_ncf_ttm double, trade_status int, is_st int, adjust string, source string"
MINUTE_BAR = "symbol string, trade_time timestamp, open double, high double, low double, close double, volume long, amount double"
VENDOR_MINUTE = "ts_code string, freq string, trade_time timestamp, open double, close double, high double, low double, vol long, amount double"
US_DAILY = "symbol string, asset_type string, date date, open double, high double, low double, close double, volume double, adj_open double, adj_high double, adj_low double, adj_close double, adj_volume double, dividend double, split_factor double, source string"
INDEX_DAILY = "date date, symbol string, open double, high double, low double, close double, preclose double, volume double, amount double, pct_change double, source string"
FILING = "symbol string, cik string, accession string, form string, filing_date date, report_date date, accepted_at string, primary_document string, is_xbrl boolean, is_inline_xbrl boolean, source string, retrieved_at string"
FACT = "row_id string, symbol string, cik string, taxonomy string, tag string, label string, description string, unit string, start_date date, end_date date, value decimal(38,12), filed_date date, accepted_at string, available_date date, form string, fiscal_year string, fiscal_period string, frame string, accession string, source string, retrieved_at string"
CALENDAR = "date date, market string, is_trading_day boolean, source string, observed_at string"
SECURITY_MASTER = "observed_at string, symbol string, exchange string, name string, board string, listing_date date, delisting_date date, status_as_of string, st_status string, base_price_limit_pct string, price_limit_rule string, price_limit_status string, source string"
INDUSTRY = "classification_date date, provider_update_date date, retrieved_at string, symbol string, exchange string, name string, industry string, classification string, source string"
MARKET_FLOW = "date date, symbol string, source string, northbound_net_amount double, margin_balance double, short_balance double, etf_flow_amount double, free_float_shares double, unlock_shares double"


def names(ddl: str) -> list[str]:
    """Column names in order."""
    return [part.strip().split(" ", 1)[0] for part in _split(ddl)]


def text_schema(ddl: str) -> str:
    """The same columns as text."""
    return ", ".join(f"{n} string" for n in names(ddl))


def _split(ddl: str) -> list[str]:
    out, depth, part = [], 0, ""
    for c in ddl:
        depth += c in "(<"
        depth -= c in ")>"
        if c == "," and not depth:
            out.append(part)
            part = ""
        else:
            part += c
    return [*out, part]


def compare(columns: list[str], required: list[str]) -> tuple[list[str], list[str]]:
    """Sorted missing and extra columns."""
    return sorted(set(required) - set(columns)), sorted(set(columns) - set(required))
