import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketloom import __main__ as command
from marketloom import jobs, tables
from marketloom.functions.names import names_of
from marketloom.operators import articles, statements
from marketloom.operators.lake import Lake, TableSpec
from marketloom.session import checkpoint_dir
from marketloom.settings import Settings, selected
from marketloom.sources import pages, prices, quotes

NOW = dt.datetime(2024, 7, 1, 12, tzinfo=dt.timezone.utc)
PAGE = "<section id='ratios'><table><tr><th></th><th>Mar 2023</th><th>TTM</th></tr><tr><td>ROE %</td><td>12.5%</td><td>-</td></tr><tr><td>Debtor Days</td><td>1,200</td><td>7</td></tr><tr><td>Own metric</td><td>1</td><td>2</td></tr></table></section>"
NEWS = "<div class='eachStory'><h3>{}</h3><a href='/a/articleshow/1.cms'>x</a><p>{}</p></div>"


@pytest.fixture()
def context(spark, tmp_path):
    checkpoint_dir(spark)
    d = tmp_path

    def put(name, text):
        (d / name).write_text(text)
        return str(d / name)

    listed = ["SYMBOL, NAME OF COMPANY, SERIES, DATE OF LISTING, FACE VALUE", "ABC,Abc  Ltd,EQ,2001-01-01,10", "ABC,Other,BE,2001-01-01,10", "DEF,Def Ltd,EQ,2002-01-01,x"]
    scrips = [{"Issuer_Name": " ", "Scrip_Name": "Abc  Limited", "scrip_id": " abc", "ISIN_NUMBER": "ine1", "GROUP": "A", "FACE_VALUE": "2", "SCRIP_CD": "5"}, {"Issuer_Name": "Fund", "Scrip_Name": "F", "scrip_id": "FND", "ISIN_NUMBER": "INF2", "GROUP": "F", "FACE_VALUE": "2", "SCRIP_CD": "6"}]
    stamps = prices.session_stamps(600, dt.datetime(2024, 6, 28, 16))
    close = 100 * np.exp(np.cumsum(np.random.default_rng(1).normal(0.001, 0.002, 600)))
    pd.DataFrame({"symbol": "ABC", "exchange": "NSE", "ts": [t.isoformat() + "+05:30" for t in stamps], "Open": close, "High": close, "Low": close, "Close": close, "Volume": 5.0}).to_parquet(d / "bars.parquet")
    pd.DataFrame({"symbol": ["abc"], "consolidated": [True], "html": [PAGE]}).to_parquet(d / "pages.parquet")
    pd.DataFrame({"page_url": ["https://e.org/x", "https://e.org/y"], "company_name": ["Zed", "Abc"], "page_no": [1, 2], "html": [NEWS.format("Old", "first"), NEWS.format("New", "")]}).to_parquet(d / "news.parquet")
    pd.DataFrame({"page_no": [1], "page_url": ["https://e.org/i"], "html": ["<div class='companyLC'><ul class='companyList'><li><a href='/abc/stocks/companyid-7.cms'>Abc Share Price</a></li></ul></div>"]}).to_parquet(d / "index.parquet")
    captured = {
        "nse": put("nse.csv", "\n".join(listed)),
        "bse": put("bse.json", json.dumps(scrips)),
        "funds": put("funds.csv", "tradingsymbol,purchase_allowed,last_price,dividend_type\nF1,1,10.5,growth\nF2,0,,payout"),
        "nav": put("nav.txt", "Open Ended\n101;INE5;-;A; B;10.5;01-Apr-2024\n102;-;-;C;N.A.;01-Apr-2024"),
        "history": put("history.json", json.dumps({"status": "SUCCESS", "meta": {"scheme_code": 101, "scheme_name": "A; B", "isin_growth": "INE5", "isin_div_reinvestment": None}, "data": [{"date": "02-04-2024", "nav": "11"}, {"date": "bad", "nav": "1"}]})),
        "quotes": put("quotes.json", json.dumps({"key": "NSE:ABC-BE", "seq": 1, "payload": '{"last_price": 1}'}) + "\n" + json.dumps({"key": "NSE:ABC", "seq": 2, "payload": '{"last_price": 9, "ohlc": {"open": 8}, "volume_traded": 4}'})),
        "bars": str(d / "bars.parquet"),
        "pages": str(d / "pages.parquet"),
        "news": str(d / "news.parquet"),
        "index": str(d / "index.parquet"),
    }
    return jobs.Context(spark, Lake(spark, str(d / "lake")), Settings.read({"MARKETLOOM_LIMIT": "50", "MARKETLOOM_CALIBRATE": "off"}), captured, NOW)


def test_all_loads_fill_the_lake_and_can_be_repeated(context):
    done = jobs.run(context)
    assert list(done)[0] == "listings" and set(done) == set(jobs.JOBS)
    read = lambda t: context.lake.read(tables.TABLES[t])
    first = {t: sorted(map(str, read(t).drop("ingested_at").collect())) for t in tables.TABLES}
    assert {(r.exchange, r.symbol, r.company_name, r.face_value) for r in read("equity_universe").collect()} == {("NSE", "ABC", "Abc Ltd", 10.0), ("NSE", "DEF", "Def Ltd", None), ("BSE", "ABC", "Abc Limited", 2.0)}
    assert {(r.tradingsymbol, r.purchase_allowed, r.last_price) for r in read("mf_listings").collect()} == {("F1", True, 10.5), ("F2", False, None)}
    assert {(r.scheme_code, r.nav_date, r.nav, r.source) for r in read("nav_history").collect()} == {(101, "2024-04-01", 10.5, "amfi"), (101, "2024-04-02", 11.0, "mfapi")}
    daily = read("price_history").where("interval = '1d'").collect()
    assert [(r.symbol, r.close, r.open, r.volume, r.bar_time) for r in daily] == [("ABC", 9.0, 8.0, 4.0, "2024-07-01T00:00:00+00:00")]
    assert read("price_history").where("interval = '1h'").count() == 600
    p = read("price_predictions").collect()
    assert [(r.symbol, r.exchange, r.bar_time, r.signal) for r in p] == [("ABC", "NSE", "2024-07-01T00:00:00+00:00", "BUY")]
    assert {(r.symbol, r.financial_period, r.roe, r.debtor_days) for r in read("ratios").collect()} == {("ABC", "Mar 2023", 12.5, 1200.0), ("ABC", "TTM", None, 7.0)}
    assert [(r.heading, r.content, r.companies) for r in read("articles").collect()] == [("New", "first", ["Abc", "Zed"])]
    assert [(r.company_id, r.company_name) for r in read("companies").collect()] == [("7", "Abc")]
    jobs.run(context, ["nav", "prices", "quotes", "statements", "articles"])
    assert {t: sorted(map(str, read(t).drop("ingested_at").collect())) for t in tables.TABLES} == first


def test_stored_layout_wins_over_the_declared_one(spark, tmp_path):
    store = Lake(spark, str(tmp_path / "lake"))
    assert tables.layout_of(store, "ratios") == tables.TABLES["ratios"]
    old = spark.createDataFrame([("A", "TTM", 1.0, 2.0)], "symbol string, financial_period string, roe double, gone double")
    store.write(TableSpec("ratios", old.schema, ["symbol", "financial_period"], "merge"), old)
    assert tables.layout_of(store, "ratios").layout.fieldNames() == ["symbol", "financial_period", "roe", "gone"]


def test_settings_and_selection():
    s = Settings.read({"MARKETLOOM_LIMIT": " 7 ", "MARKETLOOM_BATCHED": "No", "MARKETLOOM_SYMBOLS": "a,b", "OTHER": "x"})
    assert (s.limit, s.batched, s.symbols, s.predictions, s.calibrate) == (7, False, "a,b", True, False)
    for bad in ({"MARKETLOOM_LIMIT": "0"}, {"MARKETLOOM_LIMIT": "x"}, {"MARKETLOOM_BATCHED": "maybe"}):
        with pytest.raises(ValueError):
            Settings.read(bad)
    with pytest.raises(ValueError, match="lake_root"):
        s.required("symbols", "lake_root")
    assert selected(None, ["a", "b"]) == ["a", "b"] and selected(["b", "z"], ["a", "b"]) == ["b"]


def test_command_lists_queries(capsys):
    assert command.main(["list"]) == 0
    assert "p1_found" in capsys.readouterr().out.split()


def test_entries_take_precedence_in_order(spark):
    u = spark.createDataFrame([("NSE", "b"), ("BSE", "a"), ("NSE", "b"), ("NSE", " ")], "exchange string, symbol string")
    got = lambda **k: [(r.exchange, r.symbol) for r in prices.resolve_entries(spark, u, **k).orderBy("seq", "exchange", "symbol").collect()]
    assert got() == [("BSE", "A"), ("NSE", "B")] and got(exchange="nse") == [("NSE", "B")] and got(exchange="ALL", limit=1) == [("BSE", "A")]
    assert got(setting="x, BSE:y,x, ", limit_setting=1) == [("NSE", "X")]
    assert got(symbols=["q", "bse: r", "Q", ""], setting="x", limit_setting=1, exchange="BOTH") == [("NSE", "Q"), ("BSE", "R")]
    assert got(symbols=[" "], setting="x") == [("NSE", "X")]
    assert got(entries=[("bse", "z")], symbols=["q"]) == [("BSE", "Z")]


def test_batches_are_retried_then_fall_back(spark):
    keys = spark.createDataFrame([(f"k{i}", i) for i in range(10)] + [(None, 99)], "key string, seq long").coalesce(1)

    def fetch(block):
        if "k4" in block:
            raise OSError("down")
        return {k: "full" for k in block if k != "k0"}

    def last_price(block):
        return {k: "last" for k in block if k != "k5"}

    got = {r.key: (r.payload, r.status) for r in quotes.fetched(keys, "key", "seq", fetch, last_price, batch=3).collect()}
    assert got["k0"] == (None, "missing") and got["k1"] == ("full", "ok") and got["k4"] == ("last", "fallback") and got["k5"] == (None, "missing") and got["k9"] == ("full", "ok")
    bad = quotes.fetched(keys, "key", "seq", fetch, None, batch=3, tries=2)
    assert {r.key for r in bad.where("status = 'error'").collect()} == {"k3", "k4", "k5"}
    assert quotes.fetched(keys.limit(0), "key", "seq", fetch).collect() == []


def test_names_however_deep(spark):
    assert names_of('["A", "[\\"b\\", \\"[\\\\\\"C\\\\\\", \\\\\\"a\\\\\\"]\\"]", null, " "]') == ["A", "b", "C"]
    assert names_of("[broken") == ["[broken"] and names_of(None) == [] and names_of(" x ") == ["x"] and names_of(float("nan")) == []
    new = spark.createDataFrame([("u", "", "", "", ["Z"])], "url string, heading string, content string, date string, companies array<string>")
    old = spark.createDataFrame([("u", ['["Y"]', "y"]), ("v", ["Q"])], "url string, companies array<string>")
    assert articles.with_existing(new, old).first().companies == ["Y", "Z"]


def test_synonyms_fill_only_what_is_missing(spark):
    df = spark.createDataFrame([("A", "TTM", 1.0, 9.0, 3.0), ("B", "TTM", None, 8.0, None)], "symbol string, financial_period string, sales double, revenue double, own double")
    got = statements.canonical("profit_loss", df)
    assert got.columns[:3] == ["symbol", "financial_period", "sales"] and "own" not in got.columns and "eps" in got.columns
    assert [(r.sales, r.eps) for r in got.orderBy("symbol").collect()] == [(1.0, None), (8.0, None)]
    assert statements.canonical("unknown", df).columns == ["symbol", "financial_period", "own", "sales"] or "own" in statements.canonical("unknown", df).columns


def test_pages_that_hold_a_company(spark):
    rows = [(1, 200, "https://s/company/A/", "ok"), (2, 404, "https://s/company/A/", "ok"), (3, 200, "https://s/login", "ok"), (4, 200, "https://s/company/B/", "Page not FOUND"), (5, 200, "https://s/Company/C/", None)]
    df = spark.createDataFrame(rows, "n int, status int, final_url string, html string")
    assert sorted(r.n for r in pages.available(df).collect()) == [1, 5]


def test_price_checks_and_sessions(spark):
    b = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0), ("a", dt.datetime(2024, 1, 1), 2.0)], "symbol string, ts timestamp, close double")
    with pytest.raises(Exception, match="duplicate keys"):
        prices.validated(b, ["symbol"]).collect()
    with pytest.raises(Exception, match="finite"):
        prices.validated(b.withColumn("close", F.lit(-1.0)).limit(1), ["symbol"]).collect()
    got = prices.session_stamps(9, dt.datetime(2024, 7, 1, 10, 20))  # a Monday
    assert got == [dt.datetime(2024, 6, 28, h, 15) for h in range(9, 16)] + [dt.datetime(2024, 7, 1, 9, 15), dt.datetime(2024, 7, 1, 10, 15)]
    assert prices.period_start("1mo", dt.datetime(2024, 3, 31)) == dt.datetime(2024, 2, 29) and prices.period_start("5d", NOW) == NOW - dt.timedelta(days=5)
    with pytest.raises(ValueError):
        prices.period_start("5w", NOW)
