"""Column functions: dates, symbols, numbers, flags, tolerances and session grids. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def _c(x: Col) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x: Col) -> Column:
    """Trimmed text; empty is null."""
    return F.nullif(F.trim(_c(x)), F.lit(""))


# -- dates


def parse_date(x: Col) -> Column:
    """Date from YYYYMMDD, YYYY-M-D or YYYY/M/D; anything else is null."""
    text = blank_to_null(x)
    return (
        F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))
        .when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d"))
        .when(text.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), F.try_to_date(text, "yyyy/M/d"))
    )


def parse_date_prefix(x: Col) -> Column:
    """Date of the first ten characters (ISO timestamps), else of a compact date."""
    text = blank_to_null(x)
    return F.coalesce(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"), parse_date(text))


def parse_date_strict(x: Col) -> Column:
    """Date only of exactly eight digits once dashes are gone."""
    text = F.replace(_c(x), F.lit("-"), F.lit(""))
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))


def compact_date(x: Col) -> Column:
    return F.date_format(_c(x), "yyyyMMdd")


def date_from_name(x: Col) -> Column:
    """The first eight-digit date in a file name."""
    return F.try_to_date(F.nullif(F.regexp_extract(_c(x), r"(\d{8})", 1), F.lit("")), "yyyyMMdd")


def is_weekday(x: Col) -> Column:
    return F.weekday(_c(x)) < 5


def weekday_dates(start: Col, end: Col) -> Column:
    """Array of the weekdays from start to end; empty if end is before start."""
    days = F.when(_c(start) <= _c(end), F.sequence(_c(start), _c(end), F.expr("interval 1 day")))
    return F.coalesce(F.filter(days, lambda d: F.weekday(d) < 5), F.array().cast("array<date>"))


def date_chunks(start: Col, end: Col, days: int) -> Column:
    """Array of (start, end) chunks of at most ``days`` days that cover start to end."""
    firsts = F.when(_c(start) <= _c(end), F.sequence(_c(start), _c(end), F.expr(f"interval {int(days)} days")))
    return F.transform(firsts, lambda d: F.struct(d.alias("start"), F.least(F.date_add(d, days - 1), _c(end)).alias("end")))


def overlap_start(configured: Col, latest: Col, lookback: int) -> Column:
    """First date to ask for again: ``lookback`` days before the latest known one, never before the configured start."""
    return F.coalesce(F.greatest(_c(configured), F.date_sub(_c(latest), lookback)), _c(configured))


def five_minute_time(time: Col) -> Column:
    """Timestamp from provider digits YYYYMMDDhhmmssSSS; fractions are dropped."""
    return F.try_to_timestamp(F.substring(F.regexp_replace(_c(time), r"\D", ""), 1, 14), F.lit("yyyyMMddHHmmss"))


def accepted_local(x: Col) -> Column:
    """Acceptance time text with offset: 14 digits are New York local time; ISO text must carry its offset; else null.

    The first ten characters are the availability date in the text's own offset.
    """
    text = blank_to_null(x)
    local = F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))
    minutes = F.round((F.unix_timestamp(local) - F.unix_timestamp(F.to_utc_timestamp(local, "America/New_York"))) / 60).cast("int")
    offset = F.concat(F.when(minutes < 0, "-").otherwise("+"), F.lpad(F.floor(F.abs(minutes) / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0"))
    digits = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), offset)
    iso = F.regexp_replace(text, "Z$", "+00:00")
    good = iso.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?[+-]\d{2}:\d{2}$")
    return F.when(text.rlike(r"^\d{14}$"), digits).when(good, iso)


def available_date(accepted: Col, filed: Col) -> Column:
    return F.coalesce(F.try_to_date(F.substring(_c(accepted), 1, 10), "yyyy-MM-dd"), _c(filed))


# -- symbols


def normalize_symbol(x: Col) -> Column:
    """``600000.SH`` from the suffix spellings SZE, SSE, XSHE, XSHG and from bare six-digit codes by first digit."""
    text = F.upper(F.trim(_c(x)))
    for old, new in ((".SZE", ".SZ"), (".SSE", ".SH"), (".XSHE", ".SZ"), (".XSHG", ".SH")):
        text = F.replace(text, F.lit(old), F.lit(new))
    bare = text.rlike(r"^\d{6}$")
    return F.when(bare & text.rlike("^[023]"), F.concat(text, F.lit(".SZ"))).when(bare & text.rlike("^[69]"), F.concat(text, F.lit(".SH"))).otherwise(text)


def infer_exchange(symbol: Col, given: Col | None = None, aliases: dict[str, list[str]] | None = None) -> Column:
    """Exchange from a given market name or alias, else from the symbol's suffix; empty text if neither tells."""
    aliases = aliases or {"SZ": [".SZ"], "SH": [".SH"], "BJ": [".BJ"]}
    out = F.lit(None).cast("string")
    if given is not None:
        market = F.upper(F.trim(_c(given)))
        for exchange, names in aliases.items():
            out = F.coalesce(out, F.when(market.isin(exchange, *[n.upper().lstrip(".") for n in names]), exchange))
    for exchange, names in aliases.items():
        for n in names:
            out = F.coalesce(out, F.when(F.upper(_c(symbol)).endswith(n.upper()), exchange))
    return F.coalesce(out, F.lit(""))


def board(symbol: Col) -> Column:
    """Board bucket by code prefix; empty text for what is no exchange symbol."""
    # Code prefixes of the boards.
    text = F.upper(F.trim(_c(symbol)))
    code = F.substring_index(text, ".", 1)
    exchange = F.substring(text, F.length(code) + 2, F.length(text))
    three = F.substring(code, 1, 3)
    sz = F.when(three.isin("300", "301"), "chi_next").when(three == "002", "sme").when(three == "200", "b_share").when(three.isin("000", "001", "003"), "main").otherwise("other")
    sh = F.when(three == "688", "star").when(three == "900", "b_share").when(three.isin("600", "601", "603", "605"), "main").otherwise("other")
    good = text.contains(".") & code.rlike(r"^\d{6}$")
    return F.when(~good, "").when(exchange == "SZ", sz).when(exchange == "SH", sh).when(exchange == "BJ", "beijing").otherwise("")


def is_a_share(symbol: Col, exchanges: tuple[str, ...] = ("SZ", "SH")) -> Column:
    """A-share by code prefix. ``exchanges`` may add BJ, which the default leaves out."""
    # Code prefixes of A-shares.
    text = F.upper(F.trim(_c(symbol)))
    rules = {"SZ": r"^(000|001|002|003|300|301).*\.SZ$", "SH": r"^(600|601|603|605|688).*\.SH$", "BJ": r"^\d{6}\.BJ$"}
    out = F.lit(False)
    for e in exchanges:
        out = out | text.rlike(rules[e])
    return F.coalesce(out, F.lit(False))


def to_provider_code(symbol: Col) -> Column:
    """``sz.000001`` from ``000001.SZ``."""
    parts = F.split(F.upper(F.trim(_c(symbol))), r"\.")
    return F.concat(F.lower(F.try_element_at(parts, F.lit(2))), F.lit("."), F.try_element_at(parts, F.lit(1)))


def from_provider_code(code: Col) -> Column:
    """``000001.SZ`` from ``sz.000001``; codes are padded to six digits."""
    parts = F.split(F.trim(_c(code)), r"\.")
    return F.concat(F.lpad(F.try_element_at(parts, F.lit(2)), 6, "0"), F.lit("."), F.upper(F.try_element_at(parts, F.lit(1))))


def provider_alias(symbol: Col) -> Column:
    """US provider spelling: dots become dashes."""
    return F.translate(_c(symbol), ".", "-")


def us_symbol(x: Col) -> Column:
    """Upper-case symbol of letters, digits, dots and dashes, or null."""
    text = F.upper(F.trim(_c(x)))
    return F.when(text.rlike(r"^[A-Z0-9][A-Z0-9.\-]*$"), text)


def asset_type(x: Col) -> Column:
    text = F.lower(F.trim(_c(x)))
    return F.when(text.isin("stock", "etf"), text)


def cik(x: Col) -> Column:
    """Ten digits, zero-padded, or null."""
    text = F.trim(_c(x))
    return F.when(text.rlike(r"^\d{1,10}$"), F.lpad(text, 10, "0"))


# -- numbers and flags


def finite(x: Col) -> Column:
    """The number if it is finite, else null."""
    x = _c(x)
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def clean_number(x: Col) -> Column:
    """Finite double from text with thousands commas; null words and bad text are null."""
    text = F.replace(F.trim(_c(x)), F.lit(","), F.lit(""))
    return finite(F.when(~text.isin("", "NA", "N/A", "NULL", "None", "nan"), text.try_cast("double")))


def safe_float(x: Col, default: float | None = None) -> Column:
    """Double from text; what is no number is the default."""
    value = F.nanvl(F.trim(_c(x).cast("string")).try_cast("double"), F.lit(None).cast("double"))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def decimal_text(x: Col) -> Column:
    """Plain text of a decimal: no exponent, no trailing zeros, no negative zero."""
    text = _c(x).cast("decimal(38,12)").cast("string")
    trimmed = F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text)
    return F.when(_c(x) == 0, "0").otherwise(trimmed)


def flag(x: Col) -> Column:
    """Boolean of 1/true/yes and 0/false/no (any case); empty is false; else null."""
    text = F.lower(F.trim(_c(x).cast("string")))
    return F.when(text.isin("1", "true", "yes", "y", "on"), True).when(text.isin("0", "false", "no", "n", "off", ""), False)


def percent_to_decimal(x: Col) -> Column:
    return (blank_to_null(x).try_cast("decimal(20,8)") / F.lit(100)).cast("decimal(20,8)")


def statement_type(quarter: Col) -> Column:
    return F.when(_c(quarter) == 4, "annual").when(_c(quarter) == 2, "semiannual").when(_c(quarter).isin(1, 3), "quarterly")


def first_filled(*xs: Col) -> Column:
    return F.coalesce(*[blank_to_null(x) for x in xs])


def safe_ratio(num: Col, den: Col, kind: str = "decimal(24,4)") -> Column:
    """Quotient with at least ten decimals; null if a side is missing or the divisor is 0."""
    return (_c(num).cast(kind) / F.nullif(_c(den).cast(kind), F.lit(0).cast(kind))).cast("decimal(38,10)")


def tolerance(field: str, value: Col) -> Column:
    """Allowed difference of a field whose left value is ``value``."""
    # Tolerances of prices, volume and amount.
    if field in ("vol", "volume"):
        return F.greatest(F.lit(10.0), F.lit(1e-8) * F.abs(_c(value)))
    if field == "amount":
        return F.greatest(F.lit(200.0), F.lit(1e-8) * F.abs(_c(value)))
    return F.lit(0.005)


def expenditure(x: Col) -> Column:
    return F.abs(_c(x))


def row_hash(*xs: Col) -> Column:
    """SHA-256 of the fields joined by U+001F; null counts as empty."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(_c(x).cast("string"), F.lit("")) for x in xs]), 256)


# -- financial periods and classes


def period_class(start: Col, end: Col, form: Col, fiscal_period: Col) -> Column:
    """instant, annual, quarter, h1_ytd, nine_month_ytd or ambiguous, by duration in days (both ends count)."""
    # Day ranges, tested in this order.
    days = F.datediff(_c(end), _c(start)) + 1
    yearly = (_c(fiscal_period) == "FY") | F.regexp_replace(_c(form), "/A$", "").isin("10-K", "20-F", "40-F")
    return (
        F.when(_c(start).isNull(), "instant")
        .when(days.between(300, 390) & F.coalesce(yearly, F.lit(False)), "annual")
        .when(days.between(60, 120), "quarter")
        .when(days.between(150, 220), "h1_ytd")
        .when(days.between(230, 300), "nine_month_ytd")
        .when(days.between(300, 390), "annual")
        .otherwise("ambiguous")
    )


def quarter_label(periods: Col, classes: Col) -> Column:
    """Q1..Q4 of a group of contexts from the arrays of their fiscal periods and classes."""
    p, c = _c(periods), _c(classes)
    has = lambda x, v: F.coalesce(F.array_contains(x, v), F.lit(False))
    return F.when(has(p, "Q1"), "Q1").when(has(p, "Q2") | has(c, "h1_ytd"), "Q2").when(has(p, "Q3") | has(c, "nine_month_ytd"), "Q3").when(has(p, "FY"), "Q4")


def business_model(sector: Col, industry: Col) -> Column:
    s, i = F.lower(F.trim(_c(sector))), F.lower(F.trim(_c(industry)))
    return (
        F.when(i.contains("bank"), "bank")
        .when(i.contains("insurance") | i.contains("financial") | i.contains("holdings"), "insurance")
        .when(i.contains("reit") | (s == "real estate"), "reit")
        .when((s == "utilities") | i.contains("utilit"), "utility")
        .otherwise("non_financial")
    )


def price_limit(board_name: Col) -> Column:
    """Struct of base_price_limit_pct, price_limit_rule and price_limit_status of a board."""
    # Base limits of the boards.
    b = _c(board_name)
    pct = F.when(b.isin("chi_next", "star"), "0.20").when(b.isin("main", "sme"), "0.10").when(b == "beijing", "0.30").otherwise("")
    rule = F.when(pct == "", "unknown").otherwise(F.concat(b, F.lit("_"), F.round(pct.try_cast("double") * 100).cast("int").cast("string"), F.lit("pct_base")))
    status = F.when(pct == "", "unavailable").otherwise("requires_st_ipo_and_corporate_action_overrides")
    return F.struct(pct.alias("base_price_limit_pct"), rule.alias("price_limit_rule"), status.alias("price_limit_status"))


def listing_status(listed: Col, delisted: Col, as_of: Col) -> Column:
    return F.when(_c(listed) > _c(as_of), "not_listed").when(_c(delisted) <= _c(as_of), "delisted").otherwise("active")


# -- sessions


def minute_of_day(time: Col) -> Column:
    return F.hour(_c(time)) * 60 + F.minute(_c(time))


def session_grid(frequency: int, exchange: str = "") -> list[int]:
    """Minutes of the day at which bars of a frequency end: 09:30, to 11:30, to 15:00, and for BJ to 15:30."""
    grid = [570, *range(570 + frequency, 691, frequency), *range(780 + frequency, 901, frequency)]
    if exchange.upper() == "BJ":
        grid += list(range(900 + frequency, 931, frequency)) or [930]
    return grid


def on_grid(minute: Col, frequency: int | Column, exchange: Col) -> Column:
    """Whether a bar may end at this minute; arithmetic, no lookup."""
    m, f = _c(minute), F.lit(frequency)
    base = (m == 570) | ((m > 570) & (m <= 690) & ((m - 570) % f == 0)) | ((m > 780) & (m <= 900) & ((m - 780) % f == 0))
    late = (m > 900) & (m <= 930) & F.when(f < 60, (m - 900) % f == 0).otherwise(m == 930)
    return base | (late & (F.upper(_c(exchange)) == "BJ"))


def bars_per_day(frequency: Col, exchange: Col) -> Column:
    f, bj = _c(frequency), F.upper(_c(exchange)) == "BJ"
    base = F.lit(1) + F.floor(F.lit(120) / f) * 2
    return (base + F.when(bj, F.greatest(F.floor(F.lit(30) / f), F.lit(1))).otherwise(0)).cast("int")


def session_bucket(minute: Col, frequency: Col) -> Column:
    """Minute at which the bar of ``frequency`` that holds this minute ends; minutes outside the sessions stay themselves."""
    m, f = _c(minute), _c(frequency)
    up = lambda base: (F.lit(base) + F.ceil((m - F.lit(base)) / f) * f).cast("int")
    return F.when((m > 570) & (m <= 690), up(570)).when((m > 780) & (m <= 900), up(780)).when((m > 900) & (m <= 930), F.least(up(900), F.lit(930))).otherwise(m)


def partition_parts(path: Col) -> Column:
    """Struct of frequency, exchange and trade_date that a minute file's path says; null parts where it does not."""
    part = lambda pattern: F.nullif(F.regexp_extract(_c(path), pattern, 1), F.lit(""))
    return F.struct(part(r"/frequency=(\d+)/").try_cast("int").alias("frequency"), part(r"/exchange=([a-z]+)/").alias("exchange"), F.try_to_date(part(r"/trade_date=(\d{4}-\d{2}-\d{2})/"), "yyyy-MM-dd").alias("trade_date"))


def number_text(x: Col) -> Column:
    """A finite number of 1e-8 to 1e17 as plain text with ten significant digits at most and no trailing zeros; 0 is 0."""
    v = _c(x).cast("double")
    scale = F.pow(F.lit(10.0), F.lit(9) - F.floor(F.log10(F.abs(v))))
    text = (F.rint(v * scale) / scale).cast("decimal(38,18)").cast("string")
    return F.when(v == 0, "0").otherwise(F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", ""))
