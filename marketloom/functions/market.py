"""Column functions of the market-data model: tickers, stamps, safe numbers, labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.fundamentals import SPACE

INDIA = "Asia/Kolkata"
# Depositary receipts by home symbol, and the stance of each signal.
ADR_TICKERS = {"INFY": "INFY", "TCS": "TCSFY", "WIPRO": "WIT"}
STANCES = {"BUY": "bullish", "SELL": "bearish", "HOLD": "neutral"}
TRUE_TEXTS = ("1", "true", "True", "yes", "YES")


def lookup(key: Column, of: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for x in chain(*of.items()))), key)


def exchange_ticker(symbol: Column, exchange: Column) -> Column:
    """``SYM.NS`` or ``SYM.BO``; another exchange fails the query."""
    e = F.upper(F.trim(exchange))
    s = F.upper(F.trim(symbol))
    return F.when(e == "NSE", F.concat(s, F.lit(".NS"))).when(e == "BSE", F.concat(s, F.lit(".BO"))).otherwise(F.raise_error(F.concat(F.lit("unknown exchange: "), F.coalesce(e, F.lit("null")))))


def dotted_symbol(symbol: Column) -> Column:
    """Upper case, ``.NS`` where there is no suffix; null for blanks and the word SYMBOL."""
    s = F.upper(F.trim(symbol))
    return F.when(s.isin("", "SYMBOL"), None).when(F.contains(s, F.lit(".")), s).otherwise(F.concat(s, F.lit(".NS")))


def adr_ticker(symbol: Column) -> Column:
    return lookup(F.split_part(symbol, F.lit("."), F.lit(1)), ADR_TICKERS)


def instrument_key(exchange: Column, symbol: Column) -> Column:
    return F.concat_ws(":", exchange, symbol)


def symbol_of_key(key: Column) -> Column:
    """The symbol of ``EX:SYM`` without the suffix of the trade-to-trade series."""
    return F.regexp_replace(F.upper(F.trim(F.regexp_replace(key, "^[^:]*:", ""))), "(?i)-BE$", "")


def bar_time_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def exchange_date(ts: Column, zone: str = INDIA) -> Column:
    """The calendar date on the exchange's clock."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def trading_day_bar_time(ts: Column) -> Column:
    """The exchange's calendar date, labelled as midnight UTC."""
    return F.concat(F.date_format(exchange_date(ts), "yyyy-MM-dd"), F.lit("T00:00:00+00:00"))


def nav_date_iso(text: Column) -> Column:
    """ISO date of the three forms that NAV files use; null for others."""
    t = F.trim(text)
    d = F.coalesce(*(F.try_to_date(t, f) for f in ("dd-MM-yyyy", "dd-MMM-yyyy", "yyyy-MM-dd")))
    return F.date_format(d, "yyyy-MM-dd")


def finite(x: Column) -> Column:
    """A double with NaN and the infinities as null."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def finite_or_zero(x: Column) -> Column:
    return F.coalesce(finite(x), F.lit(0.0))


def figure(text: Column) -> Column:
    """A figure of a fundamentals page: grouping and percent sign dropped, dashes and words null."""
    t = strip(F.translate(text, ",%", ""))
    return finite(F.when(t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), t.try_cast("double")))


def strip(text: Column) -> Column:
    """No white space of any kind at the ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def flag(text: Column) -> Column:
    return F.trim(text).isin(*TRUE_TEXTS)


def first_filled(*columns: Column) -> Column:
    """The first column that is neither null, blank nor a dash."""
    return F.coalesce(*(F.when(~F.trim(c).isin("", "-"), F.trim(c)) for c in columns))


def clip(x: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def label(score: Column, threshold: float) -> Column:
    """BUY above, SELL below the threshold; HOLD on it and inside."""
    return F.when(score > threshold, "BUY").when(score < -threshold, "SELL").when(score.isNotNull(), "HOLD")


def signed_strength(score: Column, threshold: float) -> Column:
    return clip(score / threshold, -1.0, 1.0) if threshold > 0 else F.lit(0.0)


def stance(signal: Column) -> Column:
    return lookup(signal, STANCES)


def company_url(base: str, symbol: Column, consolidated: bool = True) -> Column:
    return F.concat(F.lit(f"{base}/company/"), F.upper(F.trim(symbol)), F.lit("/consolidated/" if consolidated else "/"))
