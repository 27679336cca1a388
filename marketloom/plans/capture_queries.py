"""Queries on sources: files are captured from the tables as the sites deliver them, and read by the connectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions import fundamentals as fn
from marketloom.functions import market as m
from marketloom.functions.names import flat_names
from marketloom.operators import articles, dedupe, lake, statements
from marketloom.operators.calendar import as_instant
from marketloom.operators.lake import Lake, TableSpec
from marketloom.plans.problem_oracles import _WS
from marketloom.plans.registry import query
from marketloom.session import table, work_dir, written
from marketloom.sources import listings, nav_text, pages, prices, quotes


def universe(spark, d):
    return table(spark, d, "equity_universe")


_ORDER = ["symbol", "company_name", "isin", "series", "listing_date", "face_value", "exchange_code"]
_BY = ", ".join(f"{c} NULLS FIRST" for c in _ORDER)


def nse_capture(spark, d):
    """The NSE rows as the exchange's CSV: padded headers, one file, sorted."""
    where = work_dir(spark, "nse")
    u = universe(spark, d).where("exchange = 'NSE'").orderBy(*_ORDER).coalesce(1)
    u.select(F.col("symbol").alias("SYMBOL"), F.col("company_name").alias(" NAME OF COMPANY"), F.col("series").alias(" SERIES"), F.col("listing_date").alias(" DATE OF LISTING"), F.col("face_value").alias(" FACE VALUE")).write.option("header", True).csv(where)
    return where


def bse_capture(spark, d):
    """The BSE rows as the exchange's JSON: the issuer's name is blank where the code is even."""
    where = work_dir(spark, "bse")
    u = universe(spark, d).where("exchange = 'BSE'").orderBy(*_ORDER).coalesce(1)
    even = F.col("exchange_code").try_cast("long") % 2 == 0
    u.select(F.when(even, " ").otherwise(F.col("company_name")).alias("Issuer_Name"), F.col("company_name").alias("Scrip_Name"), F.lower("symbol").alias("scrip_id"), F.col("isin").alias("ISIN_NUMBER"), F.col("series").alias("GROUP"), F.col("face_value").cast("string").alias("FACE_VALUE"), F.col("exchange_code").alias("SCRIP_CD")).write.json(where)
    return where


_NAME = r"nullif(trim(regexp_replace(company_name, '\s+', ' ', 'g')), '')"
_NSE = f"""nse AS (SELECT 'NSE' AS exchange, symbol, trim(regexp_replace(company_name, '\\s+', ' ', 'g')) AS company_name, '' AS isin, trim(series) AS series, trim(listing_date) AS listing_date, face_value, '' AS exchange_code
  FROM equity_universe WHERE exchange = 'NSE' AND symbol IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY {_BY}) = 1)"""
_BSE = f"""bse AS (SELECT 'BSE' AS exchange, upper(trim(symbol)) AS symbol, {_NAME} AS company_name, upper(trim(isin)) AS isin, trim(series) AS series, '' AS listing_date, face_value, trim(exchange_code) AS exchange_code
  FROM equity_universe WHERE exchange = 'BSE' AND trim(symbol) <> '' AND {_NAME} IS NOT NULL AND upper(trim(isin)) LIKE 'INE%' QUALIFY row_number() OVER (PARTITION BY upper(trim(symbol)) ORDER BY {_BY}) = 1)"""


@query("src01_nse_master", f"WITH {_NSE} SELECT * FROM nse")
def src01(spark, d):
    return listings.nse_master(spark, nse_capture(spark, d)).select(*listings.COLUMNS)


@query("src02_prj15_bse_master", f"WITH {_BSE} SELECT * FROM bse")
def src02(spark, d):
    return listings.bse_master(spark, bse_capture(spark, d), lines=True).select(*listings.COLUMNS)


@query("ded01_set01_universe", f"WITH {_NSE}, {_BSE} SELECT * FROM nse UNION ALL SELECT * FROM bse")
def universe_query(spark, d):
    return listings.universe(listings.nse_master(spark, nse_capture(spark, d)), listings.bse_master(spark, bse_capture(spark, d), lines=True))


def fund_capture(spark, d):
    """NAV rows as the instruments CSV: flags and figures are written in several ways."""
    where = work_dir(spark, "funds")
    n = table(spark, d, "nav_history")
    yes = F.element_at(F.array(*(F.lit(x) for x in (*m.TRUE_TEXTS, "0", "no"))), (F.col("load_seq") % 7 + 1).cast("int"))
    price = F.when(F.col("load_seq") % 11 == 0, "n/a").otherwise(m.finite(F.col("nav")).cast("string"))
    n.select(F.col("load_seq").alias("tradingsymbol"), yes.alias("purchase_allowed"), F.lit("1").alias("redemption_allowed"), price.alias("last_price"), F.lit(" 500.0").alias("minimum_purchase_amount"), F.when(F.col("load_seq") % 2 == 0, "Growth").otherwise("payout").alias("dividend_type")).write.option("header", True).csv(where)
    return where


_FUNDS = "funds AS (SELECT load_seq, load_seq % 7 < 5 AS purchase_allowed, CASE WHEN load_seq % 11 <> 0 AND isfinite(nav) THEN nav END AS last_price, CASE WHEN load_seq % 2 = 0 THEN 'Growth' ELSE 'payout' END AS dividend_type FROM nav_history)"


@query("src03_prj10_fund_master", f"WITH {_FUNDS} SELECT CAST(load_seq AS VARCHAR) AS tradingsymbol, purchase_allowed, true AS redemption_allowed, last_price, 500.0::DOUBLE AS minimum_purchase_amount, dividend_type FROM funds")
def src03(spark, d):
    return listings.fund_master(spark, fund_capture(spark, d))


@query("flt05_growth_purchasable", f"WITH {_FUNDS} SELECT CAST(load_seq AS VARCHAR) AS tradingsymbol, last_price FROM funds WHERE dividend_type = 'Growth' AND purchase_allowed")
def flt05(spark, d):
    return listings.growth_only(listings.fund_master(spark, fund_capture(spark, d))).select("tradingsymbol", "last_price")


def bar_capture(spark, d):
    """Bars as a price site delivers them: stamps as text, an adjusted close of 95 % of the close."""
    p = table(spark, d, "hourly_prices")
    x = lambda f: f("open", "close")
    return p.select(F.concat_ws("#", "symbol", "feed_id").alias("symbol"), F.lit("nse").alias("exchange"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), F.col("open").alias("Open"), x(F.greatest).alias("High"), x(F.least).alias("Low"), F.col("close").alias("Close"), (F.col("close") * 0.95).alias("Adj Close"), F.col("volume").alias("Volume"), "load_seq", "ingested_at")


_CAPTURED = """captured AS (SELECT upper(concat_ws('#', symbol, feed_id)) AS symbol, load_seq, timestamp AS ts, CASE WHEN isfinite(open) THEN open END AS open,
  CASE WHEN isfinite(close) THEN close END AS close, CASE WHEN isfinite(greatest(open, close)) THEN greatest(open, close) END AS high, CASE WHEN isfinite(least(open, close)) THEN least(open, close) END AS low, CASE WHEN isfinite(volume) THEN volume END AS volume FROM hourly_prices WHERE timestamp IS NOT NULL)"""


@query("src06_prj21_price_rows", f"""WITH {_CAPTURED} SELECT symbol, 'NSE' AS exchange, '1h' AS "interval", strftime(make_timestamp(epoch_us(ts)), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS bar_time, open, high, low, close, volume, 'captured' AS source FROM captured
WHERE ts >= TIMESTAMPTZ '2024-03-01 00:00:00+00' AND ts < TIMESTAMPTZ '2025-03-01 00:00:00+00'""")
def src06(spark, d):
    b = prices.captured_bars(bar_capture(spark, d), start="2024-03-01T00:00:00Z", end="2025-03-01T00:00:00Z", period="5d")
    return prices.price_rows(b, "1h", "captured")


@query("src07_adjusted_bars", f"""WITH {_CAPTURED} SELECT symbol, ts, count(*) AS n_bars, round(max(close) * 0.95, 4) AS top_close FROM captured WHERE close > 0 AND open > 0 AND volume >= 0 GROUP BY symbol, ts""")
def src07(spark, d):
    b = prices.captured_bars(bar_capture(spark, d), adjusted=True)
    ok = b.where((F.col("close") > 0) & (F.col("open") > 0) & (F.col("volume") >= 0))
    return ok.groupBy("symbol", "ts").agg(F.count(F.lit(1)).alias("n_bars"), F.round(F.max("close"), 4).alias("top_close"))


@query("src08_flt02_daily_returns", """WITH c AS (SELECT symbol, feed_id, CAST(epoch_us(timestamp) // 86400000000 AS INTEGER) + DATE '1970-01-01' AS day, close, timestamp, ingested_at, load_seq FROM hourly_prices WHERE close > 0 AND isfinite(close)),
x AS (SELECT symbol, feed_id, day, close FROM c QUALIFY row_number() OVER (PARTITION BY symbol, feed_id, day ORDER BY timestamp DESC, ingested_at DESC, load_seq DESC) = 1)
SELECT symbol, feed_id, day, round(ln(close) - lag(ln(close)) OVER (PARTITION BY symbol, feed_id ORDER BY day), 8) AS day_return FROM x""")
def src08(spark, d):
    p = table(spark, d, "hourly_prices").withColumnRenamed("timestamp", "at").withColumn("ts", F.to_date("at"))
    r = prices.daily_returns(p, ["symbol", "feed_id"], ["at", "ingested_at", "load_seq"])
    return r.select("symbol", "feed_id", F.col("ts").alias("day"), F.round("day_return", 8).alias("day_return"))


@query("src08_market_tickers", "SELECT symbol, unnest(['nifty', 'nifty_it', 'usdinr', 'nasdaq']) AS series_name, unnest(['^NSEI', '^CNXIT', 'INR=X', '^IXIC']) AS ticker FROM (SELECT DISTINCT symbol FROM hourly_prices) UNION ALL SELECT * FROM (SELECT DISTINCT symbol, 'adr', CASE upper(split_part(symbol, '.', 1)) WHEN 'INFY' THEN 'INFY' WHEN 'TCS' THEN 'TCSFY' WHEN 'WIPRO' THEN 'WIT' END AS t FROM hourly_prices) WHERE t IS NOT NULL")
def market_tickers(spark, d):
    return prices.market_tickers(table(spark, d, "hourly_prices"))


def asked_quotes(spark, d):
    """hourly_feed as instruments to ask for, with what the site would answer; a third are trade-to-trade twins."""
    f = table(spark, d, "hourly_feed").where("trim(symbol) <> ''")
    s = F.col("load_seq")
    number = lambda c: m.finite(F.col(c)).cast("string")
    ohlc = F.struct(number("open").alias("open"), F.greatest("open", "close").cast("string").alias("high"), F.least("open", "close").cast("string").alias("low"), F.when(s % 5 != 0, number("close")).alias("close"))
    body = F.to_json(F.struct(number("open").alias("last_price"), F.when(s % 4 != 0, ohlc).alias("ohlc"), F.when(s % 7 != 0, number("volume")).alias("volume"), F.lit("77").alias("volume_traded")))
    return f.select(F.concat(F.lit("NSE:"), F.trim("symbol"), F.when(s % 3 == 0, "-be").otherwise("")).alias("key"), s.alias("seq"), body.alias("payload"))


@query("src09_ded04_srt06_prj16_quotes", """WITH q AS (SELECT *, regexp_replace(upper(trim(symbol)), '-BE$', '') AS s FROM hourly_feed WHERE trim(symbol) <> '')
SELECT s AS symbol, 'NSE' AS exchange, '1d' AS "interval", '2025-01-02T00:00:00+00:00' AS bar_time,
  CASE WHEN load_seq % 4 <> 0 AND isfinite(open) THEN open END AS open, CASE WHEN load_seq % 4 <> 0 AND isfinite(greatest(open, close)) THEN greatest(open, close) END AS high, CASE WHEN load_seq % 4 <> 0 AND isfinite(least(open, close)) THEN least(open, close) END AS low,
  coalesce(CASE WHEN load_seq % 4 <> 0 AND load_seq % 5 <> 0 AND isfinite(close) THEN close END, CASE WHEN isfinite(open) THEN open END) AS close,
  coalesce(CASE WHEN load_seq % 7 <> 0 AND isfinite(volume) THEN volume END, 77.0) AS volume, 'quotes' AS source
FROM q QUALIFY row_number() OVER (PARTITION BY s ORDER BY CASE WHEN load_seq % 3 = 0 THEN 1 ELSE 0 END, load_seq) = 1""")
def src09(spark, d):
    return quotes.quote_rows(asked_quotes(spark, d), F.lit("2025-01-02T00:00:00+00:00"))


@query("src09_src12_batched_fetch", "SELECT load_seq AS seq, CASE WHEN trim(symbol) LIKE 'X%' THEN 'ok' ELSE 'missing' END AS status FROM hourly_feed WHERE trim(symbol) <> ''")
def batched(spark, d):
    """Every instrument asked for in batches of 300; a connector that knows the symbols with an X."""
    def connector(keys):
        return {k: '{"last_price": "1"}' for k in keys if k.startswith("NSE:X")}

    got = quotes.fetched(asked_quotes(spark, d), "key", "seq", connector)
    return got.select("seq", "status")


@query("src16_symbols_csv", "SELECT CASE WHEN contains(s, '.') THEN s ELSE s || '.NS' END AS symbol FROM (SELECT DISTINCT upper(trim(symbol)) AS s FROM equity_universe) WHERE s NOT IN ('', 'SYMBOL')")
def src16(spark, d):
    where = work_dir(spark, "symbols")
    universe(spark, d).select("series", F.col("symbol")).coalesce(1).write.option("header", True).csv(where)
    return prices.symbols_csv(spark, where).select("symbol")


@query("prj05_entries", "SELECT exchange, symbol, min(load_seq) AS seq FROM (SELECT load_seq, CASE WHEN load_seq % 2 = 0 THEN 'BSE' ELSE 'NSE' END AS exchange, upper(trim(symbol)) AS symbol FROM hourly_feed) WHERE symbol <> '' GROUP BY ALL")
def prj05_entries(spark, d):
    """A list of entries, half of them as EX:SYM, with repetitions."""
    f = table(spark, d, "hourly_feed").select("load_seq", F.when(F.col("load_seq") % 2 == 0, F.concat(F.lit(" bse:"), "symbol")).otherwise(F.col("symbol")).alias("raw"))
    return prices.parse_entries(f, "raw", "load_seq")


@query("prj05_resolved_universe", "SELECT DISTINCT exchange, upper(trim(symbol)) AS symbol FROM equity_universe WHERE trim(symbol) <> ''")
def prj05_resolved(spark, d):
    return prices.resolve_entries(spark, universe(spark, d)).select("exchange", "symbol")


@query("agg11_fetch_counters", """WITH e AS (SELECT DISTINCT symbol FROM equity_universe), r AS (SELECT split_part(symbol, '.', 1) AS symbol, count(*) AS n FROM hourly_prices GROUP BY 1), b AS (SELECT DISTINCT symbol FROM gap_vector WHERE is_weekend_gap = 1)
SELECT count(*) AS symbols_requested, count(*) FILTER (n > 0 AND b.symbol IS NULL) AS ok, count(*) FILTER (n IS NULL AND b.symbol IS NULL) AS skip, count(b.symbol) AS error, CAST(coalesce(sum(n) FILTER (b.symbol IS NULL), 0) AS BIGINT) AS n_rows
FROM e LEFT JOIN r USING (symbol) LEFT JOIN (SELECT split_part(symbol, '.', 1) AS symbol FROM b) b USING (symbol)""")
def fetch_counters(spark, d):
    of = lambda t: table(spark, d, t).select(F.lit("NSE").alias("exchange"), F.split_part("symbol", F.lit("."), F.lit(1)).alias("symbol"))
    entries = universe(spark, d).select(F.lit("NSE").alias("exchange"), "symbol").distinct()
    failed = table(spark, d, "gap_vector").where("is_weekend_gap = 1").select(F.lit("NSE").alias("exchange"), F.split_part("symbol", F.lit("."), F.lit(1)).alias("symbol"))
    return prices.load_counts(entries, of("hourly_prices"), failed)


@query("srt05_scheme_codes", "SELECT DISTINCT scheme_code FROM nav_history WHERE scheme_code IS NOT NULL ORDER BY scheme_code")
def srt05(spark, d):
    return prices.scheme_codes(table(spark, d, "nav_history"), spark).select("scheme_code")


_ITEMS = """items AS (SELECT doc_id, 'https://news.example/' || coalesce(symbol, '') || '/' || CAST(published_at AT TIME ZONE 'UTC' AS DATE) AS url, CASE WHEN lang IS NULL THEN '' ELSE lang END AS heading, coalesce(source, '') AS content, strftime(published_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS date, coalesce(lang, '') AS company FROM documents WHERE published_at IS NOT NULL)"""


def items(spark, d):
    """Documents as news items: listed under a page per symbol and day, their language standing for the company."""
    t = table(spark, d, "documents").where("published_at IS NOT NULL")
    day = F.date_format("published_at", "yyyy-MM-dd")
    none = lambda c: F.coalesce(F.col(c), F.lit(""))
    return t.select("doc_id", F.concat(F.lit("https://news.example/"), none("symbol"), F.lit("/"), day).alias("url"), none("lang").alias("heading"), none("source").alias("content"), day.alias("date"), none("lang").alias("company"), "symbol")


@query("agg10_articles", f"WITH {_ITEMS} SELECT url, coalesce(arg_max(heading, doc_id) FILTER (heading <> ''), '') AS heading, coalesce(arg_max(content, doc_id) FILTER (content <> ''), '') AS content, max_by(date, doc_id) AS date, coalesce(list_sort(list(DISTINCT company) FILTER (company <> '')), []) AS companies FROM items GROUP BY url")
def agg10(spark, d):
    return articles.collapsed(items(spark, d), "doc_id")


@query("src15_join09_set05_existing", f"WITH {_ITEMS}, stored AS (SELECT url, symbol FROM items JOIN documents USING (doc_id) WHERE symbol IS NOT NULL AND items.content = 'concall') SELECT url, list_sort(list(DISTINCT company)) AS companies FROM (SELECT url, company FROM items WHERE company <> '' UNION ALL SELECT url, symbol FROM stored UNION ALL SELECT url, 'Old ' || symbol FROM stored) GROUP BY url")
def existing(spark, d):
    """New articles against those in the lake, whose companies were stored as JSON text inside JSON text."""
    rows = items(spark, d)
    old = rows.where("symbol IS NOT NULL AND content = 'concall'").select("url", F.concat(F.lit('["'), "symbol", F.lit('", "[\\"Old '), "symbol", F.lit('\\"]"]')).alias("companies"))
    got = articles.with_existing(articles.collapsed(rows, "doc_id"), old)
    return got.where("size(companies) > 0").select("url", "companies")


@query("nst08_ded07_flat_names", "SELECT doc_id, CASE WHEN symbol IS NULL THEN [] WHEN lang IS NULL OR lower(lang) = lower(symbol) THEN [symbol] ELSE [symbol, lang] END AS names FROM documents")
def flat(spark, d):
    """Names as they were stored: nested lists as text, with repetitions in other spellings."""
    lang = F.coalesce(F.concat(F.lit(', \\"'), "lang", F.lit('\\"')), F.lit("")).alias("l")
    t = table(spark, d, "documents").select("doc_id", "symbol", F.coalesce("lang", "symbol").alias("other"))
    inner = F.to_json(F.array(F.lower("symbol"), F.col("other"), F.lit(" ")))
    return t.select("doc_id", flat_names(F.when(F.col("symbol").isNotNull(), F.to_json(F.array(F.concat(F.lit(" "), "symbol"), inner, inner)))).alias("names"))


_CELLS = rf"""raw AS (SELECT table_name, upper(trim(symbol)) AS symbol, load_seq, ingested_at, upper(trim(regexp_replace(financial_period, '{_WS}+', ' ', 'g'))) AS p,
    lower(trim(regexp_replace(replace(metric_label, '+', ''), '{_WS}+', ' ', 'g'))) AS k, regexp_replace(translate(metric_text, ',%', ''), '^{_WS}+|{_WS}+$', '', 'g') AS t FROM screener_facts WHERE metric_label IS NOT NULL),
cells AS (SELECT table_name, symbol, k, load_seq, ingested_at,
    CASE WHEN p = 'TTM' THEN 'TTM'
         WHEN regexp_full_match(p, '(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)[A-Z]*[ -]([0-9]{{4}}|[0-9]{{2}})') THEN p[1] || lower(p[2:3]) || ' ' || CASE WHEN regexp_matches(p, '[0-9]{{4}}$') THEN right(p, 4) ELSE '20' || right(p, 2) END
         WHEN regexp_full_match(p, '[0-9]{{4}}-(0[1-9]|1[0-2])') THEN ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'][CAST(right(p, 2) AS INTEGER)] || ' ' || left(p, 4) END AS financial_period,
    CASE WHEN regexp_full_match(t, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(t AS DOUBLE) END AS value FROM raw WHERE symbol <> '')"""
_ALIAS = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in fn.METRIC_ALIASES.items()) + "}"
_SNAKE = "coalesce(nullif(trim(regexp_replace(k, '[^a-z0-9]+', '_', 'g'), '_'), ''), 'metric')"
_KNOWN = ", ".join(f"'{x}'" for x in sorted({x for t in fn.TABLE_METRICS.values() for x in t}))


@query("nst02_03_seven_tables", f"WITH {_CELLS}, named AS (SELECT *, coalesce(element_at({_ALIAS}, k)[1], {_SNAKE}) AS metric FROM cells WHERE value IS NOT NULL AND financial_period IS NOT NULL), last AS (SELECT table_name, symbol, financial_period, metric, arg_max(value, (ingested_at, load_seq)) AS value FROM named GROUP BY ALL) SELECT table_name, symbol, financial_period, metric, value FROM last WHERE list_contains(CASE table_name " + " ".join(f"WHEN '{t}' THEN {list(c)}" for t, c in fn.TABLE_METRICS.items()) + " END, metric)")
def seven(spark, d):
    """All seven tables' frames, read back as cells to be compared."""
    out = None
    for name, frame in statements.seven_tables(table(spark, d, "screener_facts"), written).items():
        pairs = ", ".join(f"'{c}', {c}" for c in fn.TABLE_METRICS[name])
        long = frame.select(F.lit(name).alias("table_name"), *statements.BASE, F.expr(f"stack({len(fn.TABLE_METRICS[name])}, {pairs}) AS (metric, value)")).where("value IS NOT NULL")
        out = long if out is None else out.unionByName(long)
    return out


@query("nst04_combined_synonyms", f"WITH {_CELLS}, last AS (SELECT table_name, symbol, financial_period, {_SNAKE} AS metric, arg_max(value, (ingested_at, load_seq)) AS value FROM cells WHERE value IS NOT NULL AND financial_period IS NOT NULL GROUP BY ALL) SELECT table_name, symbol, financial_period, coalesce(max(value) FILTER (metric = 'sales'), max(value) FILTER (metric = 'revenue')) AS sales, coalesce(max(value) FILTER (metric = 'borrowings'), max(value) FILTER (metric = 'borrowing')) AS borrowings FROM last WHERE metric IN ('sales', 'revenue', 'borrowings', 'borrowing') GROUP BY ALL")
def nst04(spark, d):
    names = ["sales", "revenue", "borrowings", "borrowing"]
    return statements.combined(statements.by_period(statements.cells(table(spark, d, "screener_facts"), aliases=False), names)).select("table_name", *statements.BASE, "sales", "borrowings")


def _lake(spark):
    return Lake(spark, work_dir(spark, "lake"))


def _layout(df, *names):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(c, df.schema[c].dataType) for c in names])


@query("snk01_replace", "SELECT exchange, symbol, face_value FROM equity_universe WHERE exchange = 'NSE'")
def snk01(spark, d):
    """A full snapshot, replaced by another one."""
    u = universe(spark, d)
    store, spec = _lake(spark), TableSpec("equity_universe", _layout(u, "exchange", "symbol", "face_value"))
    store.write(spec, u, allow_empty=False)
    store.write(spec, u.where("exchange = 'NSE'"), allow_empty=False)
    return store.read(spec)


@query("snk02_append", "SELECT load_seq, symbol, CASE WHEN isfinite(close) THEN close END AS close FROM hourly_prices UNION ALL SELECT load_seq, symbol, CASE WHEN isfinite(close) THEN close END FROM features")
def snk02(spark, d):
    p = table(spark, d, "hourly_prices")
    store, spec = _lake(spark), TableSpec("rows", _layout(p, "load_seq", "symbol", "close"), disposition="append")
    store.write(spec, p)
    store.write(spec, table(spark, d, "features"))
    return store.read(spec)


@query("snk05_snk06_hourly_merge", "SELECT symbol, timestamp, CASE WHEN isfinite(close) THEN close END AS close, CASE WHEN isfinite(next_hour_return) THEN next_hour_return END AS next_hour_return, TIMESTAMPTZ '2026-01-01 00:00:00+00' AS ingested_at FROM hourly_prices WHERE timestamp IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol, timestamp ORDER BY load_seq DESC) = 1")
def snk05(spark, d):
    """The hourly table's twin in the lake: two loads merged by symbol and timestamp, stamped with their loading time."""
    p = table(spark, d, "hourly_prices").where("timestamp IS NOT NULL")
    store, spec = _lake(spark), TableSpec("hourly_prices", _layout(p, "symbol", "timestamp", "close", "next_hour_return", "ingested_at"), ["symbol", "timestamp"], "merge")
    half = p.agg(F.max("load_seq")).first()[0] or 0
    for part in (p.where(F.col("load_seq") * 2 <= half), p.where(F.col("load_seq") * 2 > half)):
        store.write(spec, lake.stamped(part, "2026-01-01 00:00:00+00:00"), ["load_seq"])
    return store.read(spec)


@query("snk04_set03_srt02_csv_upsert", "SELECT symbol, timestamp, CASE WHEN isfinite(close) THEN close END AS close FROM hourly_prices WHERE timestamp IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol, epoch_us(timestamp) // 1000000 ORDER BY load_seq DESC) = 1")
def snk04(spark, d):
    p = lake.null_safe(table(spark, d, "hourly_prices").select("symbol", "timestamp", "close", "load_seq"))
    half = p.agg(F.max("load_seq")).first()[0] or 0
    first = work_dir(spark, "csv")
    lake.upsert_csv(spark, None, p.where(F.col("load_seq") * 2 <= half), first, ["load_seq"])
    return lake.upsert_csv(spark, first, p.where(F.col("load_seq") * 2 > half), work_dir(spark, "csv"), ["load_seq"])


@query("snk07_compaction", "SELECT load_seq, CASE WHEN isfinite(nav) THEN nav END AS nav, 'load_seq,nav' AS columns FROM nav_history")
def snk07(spark, d):
    """A table whose layout lost a column: the files are rewritten without it."""
    n = table(spark, d, "nav_history")
    store = _lake(spark)
    store.write(TableSpec("nav", _layout(n, "load_seq", "scheme_name", "nav"), disposition="append"), n)
    slim = TableSpec("nav", _layout(n, "load_seq", "nav"), disposition="append")
    store.compact(slim)
    return store.read(slim).withColumn("columns", F.lit(",".join(store.columns(slim))))


@query("srt08_prediction_keys", "SELECT symbol, min(strftime(make_timestamp(epoch_us(timestamp)), '%Y-%m-%dT%H:%M:%S') || '+00:00') AS bar_time FROM (SELECT symbol, timestamp FROM hourly_prices QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY load_seq) = 1) GROUP BY symbol ORDER BY symbol")
def srt08(spark, d):
    """One prediction per symbol, at the bar that comes first in the load; sorted."""
    p = dedupe.keep_first(table(spark, d, "hourly_prices"), ["symbol"], ["load_seq"])
    return p.select("symbol", m.bar_time_iso(F.col("timestamp")).alias("bar_time")).orderBy("symbol")


@query("ded08_unique_instants", "SELECT symbol, feed_id, timestamp AS ts, arg_max(close, (ingested_at, load_seq)) AS close FROM hourly_prices WHERE close > 0 AND open > 0 AND volume >= 0 AND isfinite(close) AND isfinite(open) AND isfinite(volume) GROUP BY ALL")
def ded08(spark, d):
    """Bars that passed the checks of an in-memory price list: positive, finite, one per instant."""
    from marketloom.plans.series_queries import bars

    return prices.validated(bars(spark, d), ["symbol", "feed_id"]).select("symbol", "feed_id", "ts", "close")


@query("join13_predictions_with_prices", """WITH p AS (SELECT symbol, strftime(make_timestamp(epoch_us(timestamp)), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS bar_time, close, next_hour_direction FROM hourly_prices WHERE timestamp IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol, timestamp ORDER BY load_seq DESC) = 1)
SELECT symbol, 'NSE' AS exchange, bar_time, close, next_hour_direction AS signal FROM p WHERE next_hour_direction IS NOT NULL""")
def join13(spark, d):
    p = dedupe.keep_last(table(spark, d, "hourly_prices").where("timestamp IS NOT NULL"), ["symbol", "timestamp"], ["load_seq"])
    rows = p.select("symbol", F.lit("NSE").alias("exchange"), m.bar_time_iso(F.col("timestamp")).alias("bar_time"), "close", F.col("next_hour_direction").alias("signal"))
    return predictions_with_prices(rows.where("signal IS NOT NULL").drop("close"), rows.drop("signal"))


def predictions_with_prices(predictions, price_history):
    """The documented view: every prediction with the price row of its bar."""
    key = ["symbol", "exchange", "bar_time"]
    return predictions.join(price_history, key).select(*key, "close", "signal")


@query("src05_nst10_scheme_history", "SELECT scheme_code, strftime(try_strptime(trim(nav_date), ['%d-%m-%Y', '%d-%b-%Y', '%Y-%m-%d']), '%Y-%m-%d') AS nav_date, CASE WHEN scheme_code % 3 = 0 THEN 'G' ELSE 'D' END AS isin, 'Scheme ' || scheme_code AS scheme_name, nav, 'mfapi' AS source FROM nav_history WHERE isfinite(nav) AND scheme_code % 5 <> 0 AND try_strptime(trim(nav_date), ['%d-%m-%Y', '%d-%b-%Y', '%Y-%m-%d']) IS NOT NULL")
def scheme_history(spark, d):
    """NAV rows as the history site's documents, one per scheme: some without success, some figures unreadable."""
    where = work_dir(spark, "history")
    s = F.col("scheme_code")
    nav = F.coalesce(m.finite(F.col("nav")).cast("string"), F.lit("N.A."))
    docs = table(spark, d, "nav_history").where("scheme_code IS NOT NULL").groupBy("scheme_code").agg(F.collect_list(F.struct(F.col("nav_date").alias("date"), nav.alias("nav"))).alias("data"))
    meta = F.struct("scheme_code", F.concat(F.lit("Scheme "), s.cast("string")).alias("scheme_name"), F.when(s % 3 == 0, "G").otherwise("-").alias("isin_growth"), F.lit("D").alias("isin_div_reinvestment"))
    docs.select(F.when(s % 5 == 0, "ERROR").otherwise("SUCCESS").alias("status"), meta.alias("meta"), "data").write.json(where)
    return nav_text.read_history(spark, where, lines=True)


@query("prj09_cutoff_instants", "SELECT event_id, event_time AS local, event_time AS zoned, event_time AS utc FROM gap_vector WHERE event_time IS NOT NULL")
def prj09(spark, d):
    """Event times as cutoff texts on the exchange's clock, with its offset and in UTC; all name one instant."""
    e = table(spark, d, "gap_vector").where("event_time IS NOT NULL")
    clock = F.date_format(F.from_utc_timestamp("event_time", m.INDIA), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    utc = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return e.select("event_id", as_instant(clock).alias("local"), as_instant(F.concat(clock, F.lit("+05:30"))).alias("zoned"), as_instant(utc).alias("utc"))


def page_capture(spark, d):
    """Statements as company pages: one table per page, a column that is no period and figures with signs."""
    return statements.cells(table(spark, d, "screener_facts")).where(F.col("table_name") == "ratios").where(F.col("metric").isin(*fn.TABLE_METRICS["ratios"]))


@query("nst01_03_pages", f"WITH {_CELLS}, named AS (SELECT *, coalesce(element_at({_ALIAS}, k)[1], {_SNAKE}) AS metric FROM cells WHERE value IS NOT NULL AND financial_period IS NOT NULL AND table_name = 'ratios'), last AS (SELECT symbol, financial_period, metric, arg_max(value, (ingested_at, load_seq)) AS value FROM named GROUP BY ALL) SELECT symbol, financial_period, {', '.join(f'max(value) FILTER (metric = {chr(39)}{c}{chr(39)}) AS {c}' for c in fn.TABLE_METRICS['ratios'])} FROM last WHERE metric IN ({', '.join(repr(c) for c in fn.TABLE_METRICS['ratios'])}) GROUP BY ALL")
def pages_round(spark, d):
    """Ratio cells rendered as HTML pages, parsed, and transposed to one row per period."""
    c = page_capture(spark, d)
    cell = F.struct("financial_period", "metric", F.col("value").cast("string").alias("v"))
    by = c.groupBy("symbol").agg(F.array_sort(F.collect_set("financial_period")).alias("p"), F.array_sort(F.collect_set("metric")).alias("k"), F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "financial_period", "metric"), cell["v"]))).alias("v"))
    td = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    head = F.concat(F.lit("<tr><th></th><th>Notes</th>"), F.array_join(F.transform("p", lambda x: F.concat(F.lit("<th>"), x, F.lit("</th>"))), ""), F.lit("</tr>"))
    row = lambda k: F.concat(F.lit("<tr>"), td(F.replace(k, F.lit("_pct"), F.lit(" %"))), td(F.lit("n/a")), F.array_join(F.transform("p", lambda x: td(F.coalesce(F.try_element_at("v", F.concat_ws("|", x, k)), F.lit("")))), ""), F.lit("</tr>"))
    html = F.concat(F.lit("<section id='ratios'><table>"), head, F.array_join(F.transform("k", row), ""), F.lit("</table></section>"))
    long = pages.fundamentals(by.select("symbol", F.lit(True).alias("consolidated"), html.alias("html")))
    return pages.fundamentals_table(long.where("value IS NOT NULL"), "ratios")
