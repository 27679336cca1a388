"""The lake's tables: names, layouts, keys and how they are written."""

from __future__ import annotations

from pyspark.sql import types as T

from marketloom.functions.fundamentals import TABLE_METRICS
from marketloom.operators.lake import Lake, TableSpec, conform

_KINDS = {"s": T.StringType(), "d": T.DoubleType(), "l": T.LongType(), "b": T.BooleanType(), "t": T.TimestampType(), "a": T.ArrayType(T.StringType())}


def _layout(**columns: str) -> T.StructType:
    """Columns of each kind (s text, d double, l long, b boolean, t time, a list of texts), in the order given."""
    return T.StructType([T.StructField(c, _KINDS[kind]) for kind, names in columns.items() for c in names.split()])


# The stored tables, their columns and keys.
_PRICE = T.StructType([*_layout(s="symbol exchange interval bar_time"), *_layout(d="open high low close volume"), *_layout(s="source")])
_PREDICTION = T.StructType([*_layout(s="symbol exchange bar_time signal direction"), *_layout(d="score confidence path_return gap origin_price"), *_layout(s="origin_time source")])
_SPECS = [
    TableSpec("equity_universe", T.StructType([*_layout(s="exchange symbol company_name isin series listing_date"), *_layout(d="face_value"), *_layout(s="exchange_code")])),
    TableSpec("mf_listings", _layout(s="tradingsymbol dividend_type", b="purchase_allowed redemption_allowed", d="minimum_purchase_amount purchase_amount_multiplier minimum_additional_purchase_amount minimum_redemption_quantity redemption_quantity_multiplier last_price")),
    TableSpec("price_history", _PRICE, ["symbol", "exchange", "interval", "bar_time"], "merge"),
    TableSpec("price_predictions", _PREDICTION, ["symbol", "exchange", "bar_time"], "merge"),
    TableSpec("nav_history", _layout(l="scheme_code", s="nav_date isin scheme_name source", d="nav"), ["scheme_code", "nav_date"], "merge"),
    TableSpec("companies", _layout(s="company_id company_name news_url stocks_url")),
    TableSpec("articles", _layout(s="url heading content date", a="companies", t="ingested_at"), ["url"], "merge"),
    *(TableSpec(t, T.StructType([*_layout(s="symbol financial_period"), *(T.StructField(c, T.DoubleType()) for c in metrics), *_layout(t="ingested_at")]), ["symbol", "financial_period"], "merge") for t, metrics in TABLE_METRICS.items()),
]
TABLES = {s.name: s for s in _SPECS}


def layout_of(lake: Lake, name: str) -> TableSpec:
    """The table's spec in the columns that its files have, where there are any: what is stored wins over what is declared.

    Stored columns that aren't declared are doubles, as metrics are.
    """
    spec = TABLES[name]
    if not lake.version(spec):
        return spec
    known = {f.name: f for f in spec.layout}
    return TableSpec(name, T.StructType([known.get(c, T.StructField(c, T.DoubleType())) for c in lake.columns(spec)]), spec.keys, spec.disposition)


__all__ = ["TABLES", "conform", "layout_of"]
