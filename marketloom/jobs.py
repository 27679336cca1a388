"""Loads from captured files into the lake, one function each; ``JOBS`` names them with what they need first."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.market import trading_day_bar_time
from marketloom.operators import articles, lake, predict, statements
from marketloom.operators.lake import Lake
from marketloom.operators.series import clean_bars
from marketloom.session import written
from marketloom.settings import Settings, selected
from marketloom.sources import listings, nav_text, pages, prices, quotes
from marketloom.tables import TABLES, layout_of


@dataclass(frozen=True)
class Context:
    spark: SparkSession
    lake: Lake
    settings: Settings
    #: Folder of captured files by kind: nse, bse, funds, nav, history, bars, quotes, pages, news, index.
    captured: dict[str, str]
    now: dt.datetime

    @property
    def stamp(self) -> str:
        return self.now.isoformat()

    def put(self, table: str, rows: DataFrame, order: list[str] | None = None, **how) -> int:
        return self.lake.write(TABLES[table], rows, order, **how)


def load_listings(c: Context) -> dict[str, int]:
    u = listings.universe(listings.nse_master(c.spark, c.captured["nse"]), listings.bse_master(c.spark, c.captured["bse"]))
    return {"equity_universe": c.put("equity_universe", u, allow_empty=False)}


def load_funds(c: Context) -> dict[str, int]:
    return {"mf_listings": c.put("mf_listings", listings.fund_master(c.spark, c.captured["funds"]), allow_empty=False)}


def load_nav(c: Context) -> dict[str, int]:
    """Both writers of the NAV table: the daily file, then the histories of the schemes asked for."""
    daily = nav_text.read_daily(c.spark, c.captured["nav"])
    out = c.put("nav_history", daily, ["source"])
    if "history" in c.captured:
        codes = prices.scheme_codes(daily, c.spark, None, c.settings.scheme_codes, c.settings.limit)
        rows = nav_text.read_history(c.spark, c.captured["history"]).join(codes.select("scheme_code"), "scheme_code", "left_semi")
        out = c.put("nav_history", rows, ["source"])
    return {"nav_history": out}


def entries(c: Context) -> DataFrame:
    s = c.settings
    return prices.resolve_entries(c.spark, c.lake.read(TABLES["equity_universe"]), setting=s.symbols, exchange=s.exchange, limit_setting=s.limit)


def load_prices(c: Context) -> dict[str, int]:
    s = c.settings
    bars = prices.captured_bars(c.spark.read.parquet(c.captured["bars"]), entries(c), s.start or None, s.end or None, s.period, c.now)
    return {"price_history": c.put("price_history", prices.price_rows(bars, s.interval, "captured"))}


def load_quotes(c: Context) -> dict[str, int]:
    got = c.spark.read.schema("key string, seq long, payload string").json(c.captured["quotes"])
    rows = quotes.quote_rows(got, trading_day_bar_time(F.lit(c.stamp).cast("timestamp")))
    return {"price_history": c.put("price_history", rows)}


def load_predictions(c: Context) -> dict[str, int]:
    """A prediction for each listing with a whole context of hourly bars, under its first daily bar of the load."""
    if not c.settings.predictions:
        return {}
    history = c.lake.read(TABLES["price_history"])
    hourly = history.where("interval = '1h'").select(F.concat_ws(":", "exchange", "symbol").alias("symbol"), F.lit(0).cast("long").alias("feed_id"), F.col("bar_time").try_cast("timestamp").alias("timestamp"), F.coalesce("open", "close").alias("open"), "close", F.coalesce("volume", F.lit(0.0)).alias("volume"))
    b = clean_bars(hourly, order=("ts",))
    none = c.spark.createDataFrame([], "series_name string, trade_date date, known_at timestamp, obs_id long, day_return double")
    signals, _, _ = predict.predictions(b, none, calibrate=c.settings.calibrate, missing="skip")
    days = history.where("interval = '1d'").groupBy(F.concat_ws(":", "exchange", "symbol").alias("symbol")).agg(F.min("bar_time").alias("bar_time"))
    rows = signals.join(days, "symbol").select(F.split_part("symbol", F.lit(":"), F.lit(2)).alias("symbol"), F.split_part("symbol", F.lit(":"), F.lit(1)).alias("exchange"), "bar_time", "signal", "direction", "score", "confidence", "path_return", "gap", "origin_price", F.date_format("origin_time", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("origin_time"), F.lit("marketloom").alias("source"))
    return {"price_predictions": c.put("price_predictions", rows)}


def load_statements(c: Context) -> dict[str, int]:
    """The seven tables of captured company pages (Parquet of symbol, consolidated, html), in the columns each table has."""
    cells = written(pages.fundamentals(c.spark.read.parquet(c.captured["pages"])), "cells")
    out = {}
    for name in (t for t in TABLES if TABLES[t].keys == ["symbol", "financial_period"]):
        frame = statements.canonical(name, pages.fundamentals_table(cells, name))
        out[name] = c.lake.write(layout_of(c.lake, name), lake.stamped(frame, c.stamp))
    return out


def load_companies(c: Context) -> dict[str, int]:
    found = pages.companies(c.spark.read.parquet(c.captured["index"]))
    return {"companies": c.put("companies", found.limit(c.settings.limit) if c.settings.limit else found)}


def load_articles(c: Context) -> dict[str, int]:
    new = pages.stories(c.spark.read.parquet(c.captured["news"]))
    rows = articles.with_existing(new, c.lake.read(TABLES["articles"]))
    return {"articles": c.put("articles", lake.stamped(rows, c.stamp))}


#: Every load, with the loads that must come before it.
JOBS: dict[str, tuple[Callable[[Context], dict[str, int]], tuple[str, ...]]] = {
    "listings": (load_listings, ()),
    "funds": (load_funds, ()),
    "nav": (load_nav, ()),
    "prices": (load_prices, ("listings",)),
    "quotes": (load_quotes, ("listings",)),
    "predictions": (load_predictions, ("prices", "quotes")),
    "statements": (load_statements, ("listings",)),
    "companies": (load_companies, ()),
    "articles": (load_articles, ("companies",)),
}


def run(c: Context, asked: list[str] | None = None) -> dict[str, dict[str, int]]:
    """Runs the jobs asked for (all by default) in an order that their needs allow; the versions each one wrote."""
    done: dict[str, dict[str, int]] = {}
    todo = selected(asked, JOBS)
    while todo:
        ready = [j for j in todo if not set(JOBS[j][1]) & set(todo)]
        for j in ready:
            done[j] = JOBS[j][0](c)
        todo = [j for j in todo if j not in done]
    return done
