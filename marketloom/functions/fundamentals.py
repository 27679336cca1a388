"""Column functions for company fundamentals: metric names, reporting periods and numbers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels of the fundamentals pages and the column each one fills.
METRIC_ALIASES = {
    "sales": "sales",
    "revenue": "sales",
    "expenses": "expenses",
    "operating profit": "operating_profit",
    "opm %": "opm_pct",
    "other income": "other_income",
    "interest": "interest",
    "depreciation": "depreciation",
    "profit before tax": "profit_before_tax",
    "tax %": "tax_pct",
    "net profit": "net_profit",
    "eps in rs": "eps",
    "dividend payout %": "dividend_payout_pct",
    "equity capital": "equity_capital",
    "reserves": "reserves",
    "borrowings": "borrowings",
    "borrowing": "borrowings",
    "other liabilities": "other_liabilities",
    "total liabilities": "total_liabilities",
    "fixed assets": "fixed_assets",
    "cwip": "cwip",
    "investments": "investments",
    "other assets": "other_assets",
    "total assets": "total_assets",
    "cash from operating activity": "cash_from_operating",
    "cash from investing activity": "cash_from_investing",
    "cash from financing activity": "cash_from_financing",
    "net cash flow": "net_cash_flow",
    "debtor days": "debtor_days",
    "inventory days": "inventory_days",
    "days payable": "days_payable",
    "cash conversion cycle": "cash_conversion_cycle",
    "working capital days": "working_capital_days",
    "roce %": "roce_pct",
    "roe %": "roe",
    "roe": "roe",
    "promoters": "promoters_pct",
    "fiis": "fiis_pct",
    "diis": "diis_pct",
    "public": "public_pct",
    "no. of shareholders": "shareholders",
}

# The metric columns of each fundamentals table.
_RESULTS = ("sales", "expenses", "operating_profit", "opm_pct", "other_income", "interest", "depreciation", "profit_before_tax", "tax_pct", "net_profit", "eps", "dividend_payout_pct")
_HOLDERS = ("promoters_pct", "fiis_pct", "diis_pct", "public_pct", "shareholders")
TABLE_METRICS = {
    "quarterly_results": _RESULTS,
    "profit_loss": _RESULTS,
    "balance_sheet": ("equity_capital", "reserves", "borrowings", "other_liabilities", "total_liabilities", "fixed_assets", "cwip", "investments", "other_assets", "total_assets"),
    "cash_flow": ("cash_from_operating", "cash_from_investing", "cash_from_financing", "net_cash_flow"),
    "ratios": ("debtor_days", "inventory_days", "days_payable", "cash_conversion_cycle", "working_capital_days", "roce_pct", "roe"),
    "shareholding_quarterly": _HOLDERS,
    "shareholding_yearly": _HOLDERS,
}

# Metrics that a page may name in two ways, the second standing in where the first is missing.
SYNONYMS = {"sales": "revenue", "borrowings": "borrowing"}

MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
_FULL = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
#: White space as Python's ``\s`` has it for text.
SPACE = r"[\s\x0B\x1C-\x1F\x85   -     　]"


def squeeze(c: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def norm_label(label: Column) -> Column:
    """A label without ``+``, with single blanks, in lower case."""
    return F.lower(squeeze(F.replace(label, F.lit("+"), F.lit(""))))


def metric_of(key: Column) -> Column:
    """The metric column of a normalised label."""
    alias = F.create_map(*(F.lit(x) for x in chain(*METRIC_ALIASES.items())))
    snake = F.regexp_replace(F.regexp_replace(key, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(key.isNull(), None).otherwise(F.coalesce(F.try_element_at(alias, key), F.when(snake == "", "metric").otherwise(snake)))


def metric_name(label: Column) -> Column:
    """The metric column of a label: its alias, else snake case, else ``metric``; null stays null."""
    return metric_of(norm_label(label))


_MONTH = "|".join(f"{f[:3].upper()}(?:{f[3:].upper()})?" for f in _FULL).replace("SEP(?:TEMBER)?", "SEP(?:T|TEMBER)?")
_NAMED = rf"^({_MONTH})[ \-]?'?([0-9]{{4}}|[0-9]{{2}})$"
_NUMBERED = r"^[0-9]{4}[-/]?(0[1-9]|1[0-2])$"


def period_of(t: Column) -> Column:
    """period_name of a text in upper case without extra blanks."""
    month = F.initcap(F.lower(F.substring(t, 1, 3)))
    century = F.when(F.substring(t, -4, 4).rlike("^[0-9]{4}$"), F.substring(t, -4, 4)).otherwise(F.concat(F.lit("20"), F.substring(t, -2, 2)))
    number = F.substring(t, -2, 2).try_cast("int")
    by_number = F.try_element_at(F.array(*(F.lit(m) for m in MONTHS)), number)
    return (
        F.when(t == "TTM", F.lit("TTM"))
        .when(t.rlike(_NAMED), F.concat(month, F.lit(" "), century))
        .when(t.rlike(_NUMBERED), F.concat(by_number, F.lit(" "), F.substring(t, 1, 4)))
    )


def period_name(text: Column) -> Column:
    """``Mon YYYY`` or ``TTM`` out of the ways a period is written; null for anything else."""
    return period_of(F.upper(squeeze(text)))


_DIGITS = r"(?:[0-9][0-9,]*\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]{1,2})?"
_NUMBER = rf"^{SPACE}*(?:\({SPACE}*{_DIGITS}{SPACE}*%?{SPACE}*\)|[-+−–—]?{SPACE}*{_DIGITS}){SPACE}*%?{SPACE}*$"
#: Characters that a number's text loses; the minus signs and the opening bracket become a minus.
_MINUSES, _DROPPED = "−–—(", ")+,% \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0" + "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def plain_number(text: Column) -> Column:
    """A number's text without grouping, percent sign, plus or bracketed minus; null where it is none."""
    return F.when(text.rlike(_NUMBER), F.translate(text, _MINUSES + _DROPPED, "-" * len(_MINUSES)))


def hundredths(text: Column) -> Column:
    """A figure times 100 as a whole number, half away from zero; null where it is no number."""
    return F.round(plain_number(text).try_cast("decimal(30,8)") * 100, 0).try_cast("long")
