"""Queries on listings, NAV, fundamentals and text columns, each with its DuckDB statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions import fundamentals as fn
from marketloom.functions import market as m
from marketloom.operators import asof, dedupe, lake
from marketloom.plans.registry import query
from marketloom.plans.series_queries import BARS, KEY, bars
from marketloom.session import table
from marketloom.sources import listings, nav_text

def universe(spark, d):
    return table(spark, d, "equity_universe")


@query("prj01_exchange_ticker", "SELECT exchange, symbol, upper(trim(symbol)) || CASE exchange WHEN 'NSE' THEN '.NS' ELSE '.BO' END AS ticker FROM equity_universe")
def prj01(spark, d):
    return universe(spark, d).select("exchange", "symbol", m.exchange_ticker(F.col("symbol"), F.col("exchange")).alias("ticker"))


@query("prj02_dotted_symbol", "SELECT load_seq, CASE WHEN s IN ('', 'SYMBOL') THEN NULL WHEN contains(s, '.') THEN s ELSE s || '.NS' END AS ticker FROM (SELECT load_seq, upper(trim(symbol)) AS s FROM hourly_feed)")
def prj02(spark, d):
    return table(spark, d, "hourly_feed").select("load_seq", m.dotted_symbol(F.col("symbol")).alias("ticker"))


@query("prj03_adr_ticker", "SELECT symbol, CASE split_part(symbol, '.', 1) WHEN 'INFY' THEN 'INFY' WHEN 'TCS' THEN 'TCSFY' WHEN 'WIPRO' THEN 'WIT' END AS adr FROM (SELECT DISTINCT symbol FROM hourly_prices)")
def prj03(spark, d):
    return table(spark, d, "hourly_prices").select("symbol").distinct().select("symbol", m.adr_ticker(F.col("symbol")).alias("adr"))


@query("prj04_instrument_key", "SELECT exchange || ':' || symbol AS key, regexp_replace(upper(trim(symbol)), '-BE$', '') AS parsed FROM equity_universe")
def prj04(spark, d):
    k = universe(spark, d).select(m.instrument_key(F.col("exchange"), F.col("symbol")).alias("key"))
    return k.select("key", m.symbol_of_key(F.col("key")).alias("parsed"))


@query("prj06_07_bar_time", "SELECT load_seq, strftime(to_timestamp(0) + to_microseconds(epoch_us(timestamp)), '%Y-%m-%dT%H:%M:%S+00:00')[1:19] || '+00:00' AS bar_time, strftime(DATE '1970-01-01' + CAST((epoch_us(timestamp) + 19800000000) // 86400000000 AS INTEGER), '%Y-%m-%d') || 'T00:00:00+00:00' AS trading_day FROM (SELECT load_seq, make_timestamp(epoch_us(timestamp)) AS timestamp FROM hourly_prices)".replace("strftime(to_timestamp(0) + to_microseconds(epoch_us(timestamp)), '%Y-%m-%dT%H:%M:%S+00:00')[1:19] || '+00:00'", "strftime(timestamp, '%Y-%m-%dT%H:%M:%S') || '+00:00'"))
def prj06(spark, d):
    return table(spark, d, "hourly_prices").select("load_seq", m.bar_time_iso(F.col("timestamp")).alias("bar_time"), m.trading_day_bar_time(F.col("timestamp")).alias("trading_day"))


@query("prj08_nav_date", "SELECT load_seq, strftime(try_strptime(trim(nav_date), ['%d-%m-%Y', '%d-%b-%Y', '%Y-%m-%d']), '%Y-%m-%d') AS nav_date FROM nav_history")
def prj08(spark, d):
    return table(spark, d, "nav_history").select("load_seq", m.nav_date_iso(F.col("nav_date")).alias("nav_date"))


_FIG = "CASE WHEN regexp_full_match({0}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST({0} AS DOUBLE) END"


@query("prj12_figure", f"SELECT load_seq, round({_FIG.format('t')}, 6) AS value FROM (SELECT load_seq, trim(translate(metric_text, ',%', '')) AS t FROM screener_facts)")
def prj12(spark, d):
    return table(spark, d, "screener_facts").select("load_seq", F.round(m.figure(F.col("metric_text")), 6).alias("value"))


@query("prj13_metric_name", "SELECT load_seq, coalesce(element_at(MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in fn.METRIC_ALIASES.items()) + "}, k)[1], coalesce(nullif(trim(regexp_replace(k, '[^a-z0-9]+', '_', 'g'), '_'), ''), 'metric')) AS metric FROM (SELECT load_seq, lower(trim(regexp_replace(replace(metric_label, '+', ''), '[\\s\\x{00A0}\\x{3000}\\x{2000}-\\x{200A}]+', ' ', 'g'))) AS k FROM screener_facts WHERE metric_label IS NOT NULL)")
def prj13(spark, d):
    return table(spark, d, "screener_facts").where(F.col("metric_label").isNotNull()).select("load_seq", fn.metric_name(F.col("metric_label")).alias("metric"))


@query("prj14_15_company_name", "SELECT symbol, exchange, coalesce(nullif(trim(regexp_replace(company_name, '\\s+', ' ', 'g')), ''), symbol) AS name, count(*) AS n FROM equity_universe GROUP BY ALL")
def prj14(spark, d):
    u = universe(spark, d)
    return u.select("symbol", "exchange", m.first_filled(F.regexp_replace("company_name", r"\s+", " "), F.col("symbol")).alias("name")).groupBy("symbol", "exchange", "name").agg(F.count(F.lit(1)).alias("n"))


@query("prj18_math", f"WITH {BARS} SELECT symbol, feed_id, ts, round(ln(close), 8) AS l, round(ln(1 + volume), 8) AS l1, round(exp(-close / 1e4), 8) AS e, round((exp(2 * least(5.0, close / open - 1)) - 1) / (exp(2 * least(5.0, close / open - 1)) + 1), 8) AS th, CAST(sign(close - open) AS DOUBLE) AS sg, greatest(-1.0, least(1.0, (close - open) * 10)) AS cl FROM bars")
def prj18(spark, d):
    c, o = F.col("close"), F.col("open")
    r = lambda x, n: F.round(x, 8).alias(n)
    return bars(spark, d).select(*KEY, r(F.ln(c), "l"), r(F.log1p("volume"), "l1"), r(F.exp(-c / 1e4), "e"), r(F.tanh(F.least(F.lit(5.0), c / o - 1)), "th"), F.signum(c - o).alias("sg"), m.clip((c - o) * 10, -1.0, 1.0).alias("cl"))


@query("prj19_finite", "SELECT load_seq, CASE WHEN isfinite(close) THEN close END AS close, CASE WHEN isfinite(volume) THEN volume ELSE 0.0 END AS volume FROM hourly_prices")
def prj19(spark, d):
    return table(spark, d, "hourly_prices").select("load_seq", m.finite(F.col("close")).alias("close"), m.finite_or_zero(F.col("volume")).alias("volume"))


@query("prj22_24_urls", "SELECT symbol, exchange_code, 'https://example.org/company/' || upper(trim(symbol)) || '/consolidated/' AS url, regexp_extract('/stocks/companyid-' || exchange_code || '/x.cms', '/stocks/companyid-(\\d+)', 1) AS company_id FROM equity_universe WHERE exchange_code <> ''")
def prj22(spark, d):
    u = universe(spark, d).where("exchange_code <> ''")
    path = F.concat(F.lit("/stocks/companyid-"), F.col("exchange_code"), F.lit("/x.cms"))
    return u.select("symbol", "exchange_code", m.company_url("https://example.org", F.col("symbol")).alias("url"), F.regexp_extract(path, r"/stocks/companyid-(\d+)", 1).alias("company_id"))


@query("prj23_labels", "SELECT load_seq, CASE WHEN r > 0.0015 THEN 'BUY' WHEN r < -0.0015 THEN 'SELL' ELSE 'HOLD' END AS signal, CASE WHEN r > 0.0015 THEN 'bullish' WHEN r < -0.0015 THEN 'bearish' ELSE 'neutral' END AS stance, round(greatest(-1.0, least(1.0, r / 0.0015)), 6) AS strength FROM (SELECT load_seq, next_hour_return AS r FROM hourly_prices WHERE isfinite(next_hour_return))")
def prj23(spark, d):
    p = table(spark, d, "hourly_prices").where(m.finite(F.col("next_hour_return")).isNotNull())
    s = m.label(F.col("next_hour_return"), 0.0015)
    return p.select("load_seq", s.alias("signal"), m.stance(s).alias("stance"), F.round(m.signed_strength(F.col("next_hour_return"), 0.0015), 6).alias("strength"))


@query("prj25_date_parts", "SELECT load_seq, strftime(CAST(us // 86400000000 AS INTEGER) + DATE '1970-01-01', '%Y-%m-%d') AS day, CAST((us // 86400000000 + 3) % 7 AS INTEGER) AS weekday, CAST((us // 60000000) % 1440 AS INTEGER) AS minute FROM (SELECT load_seq, epoch_us(timestamp) + 19800000000 AS us FROM hourly_prices)")
def prj25(spark, d):
    t = F.from_utc_timestamp("timestamp", m.INDIA)
    return table(spark, d, "hourly_prices").select("load_seq", F.date_format(t, "yyyy-MM-dd").alias("day"), F.weekday(t).alias("weekday"), (F.hour(t) * 60 + F.minute(t)).alias("minute"))


@query("flt03_listed", "SELECT exchange, symbol, isin FROM equity_universe WHERE trim(symbol) <> '' AND trim(company_name) <> '' AND isin LIKE 'INE%'")
def flt03(spark, d):
    return universe(spark, d).where((F.trim("symbol") != "") & (F.trim("company_name") != "") & F.startswith("isin", F.lit("INE"))).select("exchange", "symbol", "isin")


@query("flt06_periods", "SELECT load_seq, financial_period FROM screener_facts WHERE regexp_full_match(financial_period, '(?:(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\\s+[0-9]{4}|TTM)') AND lower(trim(metric_label)) <> 'raw pdf'")
def flt06(spark, d):
    months = "|".join(fn.MONTHS)
    return table(spark, d, "screener_facts").where(F.col("financial_period").rlike(rf"^(?:(?:{months})\s+[0-9]{{4}}|TTM)$") & (F.lower(F.trim("metric_label")) != "raw pdf")).select("load_seq", "financial_period")


@query("ded05_ordered_distinct", "SELECT symbol, min(load_seq) AS load_seq FROM hourly_feed WHERE trim(symbol) <> '' GROUP BY symbol")
def ded05(spark, d):
    return dedupe.first_seen(table(spark, d, "hourly_feed"), "symbol", "load_seq")


def pairs(spark, d, limit: int | None = None):
    p = listings.normalised(universe(spark, d)).select("exchange", "symbol").distinct().orderBy("exchange", "symbol")
    return p.limit(limit) if limit else p


@query("src13_14_universe_scan", "SELECT DISTINCT upper(trim(symbol)) AS symbol FROM equity_universe WHERE exchange = 'NSE' AND trim(symbol) <> '' ORDER BY symbol LIMIT 50")
def src13(spark, d):
    return listings.symbols(universe(spark, d), "NSE", 50)


@query("srt03_sorted_pairs", "SELECT DISTINCT exchange, upper(trim(symbol)) AS symbol FROM equity_universe ORDER BY exchange, symbol LIMIT 100")
def srt03(spark, d):
    return pairs(spark, d, 100)


@query("src14_universe_all", "SELECT DISTINCT upper(trim(symbol)) AS symbol FROM equity_universe WHERE trim(symbol) <> '' ORDER BY symbol")
def src14(spark, d):
    return listings.symbols(universe(spark, d), "ALL")


@query("srt03_all_pairs", "SELECT DISTINCT exchange, upper(trim(symbol)) AS symbol FROM equity_universe ORDER BY exchange, symbol")
def srt03_all(spark, d):
    return pairs(spark, d)


@query("agg12_distinct_symbols", "SELECT exchange, count(DISTINCT upper(trim(symbol))) AS n FROM equity_universe WHERE trim(symbol) <> '' GROUP BY exchange")
def agg12(spark, d):
    return listings.normalised(universe(spark, d)).where("symbol <> ''").groupBy("exchange").agg(F.countDistinct("symbol").alias("n"))


@query("set01_union_all", "SELECT exchange, symbol FROM equity_universe WHERE exchange = 'NSE' UNION ALL SELECT exchange, symbol FROM equity_universe WHERE exchange <> 'NSE'")
def set01(spark, d):
    u = universe(spark, d).select("exchange", "symbol")
    return u.where("exchange = 'NSE'").unionByName(u.where("exchange <> 'NSE'"))


@query("set02_union_missing_columns", "SELECT load_seq, symbol, CAST(NULL AS DOUBLE) AS volume, ret_5d FROM features UNION ALL SELECT load_seq, symbol, volume, NULL FROM hourly_prices")
def set02(spark, d):
    return table(spark, d, "features").select("load_seq", "symbol", "ret_5d").unionByName(table(spark, d, "hourly_prices").select("load_seq", "symbol", "volume"), allowMissingColumns=True)


@query("set05_06_symbol_sets", "SELECT symbol, CAST(sum(side) AS BIGINT) AS sides FROM ((SELECT DISTINCT symbol, 1 AS side FROM hourly_prices) UNION ALL (SELECT DISTINCT symbol, 2 AS side FROM gap_vector)) GROUP BY symbol")
def set05(spark, d):
    a, b = table(spark, d, "hourly_prices").select("symbol"), table(spark, d, "gap_vector").select("symbol")
    both, left, right = a.intersect(b), a.subtract(b), b.subtract(a)
    n = lambda x, k: x.withColumn("sides", F.lit(k).cast("long"))
    return n(both, 3).unionByName(n(left, 1)).unionByName(n(right, 2))


@query("join11_semi", "SELECT event_id FROM gap_vector WHERE symbol IN (SELECT symbol FROM features WHERE is_weekend_gap = 1)")
def semi(spark, d):
    return table(spark, d, "gap_vector").join(table(spark, d, "features").where("is_weekend_gap = 1").select("symbol"), "symbol", "left_semi").select("event_id")


@query("join11_anti", "SELECT DISTINCT symbol FROM equity_universe u WHERE NOT EXISTS (SELECT 1 FROM features f WHERE split_part(f.symbol, '.', 1) = u.symbol)")
def anti(spark, d):
    """Listings that were asked for and have no bars."""
    have = table(spark, d, "features").select(F.split_part("symbol", F.lit("."), F.lit(1)).alias("symbol"))
    return universe(spark, d).select("symbol").distinct().join(have, "symbol", "left_anti")


@query("prj17_isin_choice", "SELECT load_seq, coalesce(nullif(nullif(trim(isin), ''), '-'), 'D' || scheme_code) AS isin FROM nav_history")
def prj17(spark, d):
    """The growth ISIN, else the other one; blanks and dashes are none."""
    return table(spark, d, "nav_history").select("load_seq", m.first_filled(F.col("isin"), F.concat(F.lit("D"), F.col("scheme_code").cast("string"))).alias("isin"))


@query("join12_isin_dimension", "SELECT n.load_seq, d.scheme_code AS by_isin FROM nav_history n JOIN (SELECT isin, arg_max(scheme_code, load_seq) AS scheme_code FROM nav_history WHERE isin <> '' GROUP BY isin) d ON n.isin = d.isin")
def dimension(spark, d):
    n = table(spark, d, "nav_history")
    dim = dedupe.keep_last(n.where("isin <> ''"), ["isin"], ["load_seq"]).select("isin", F.col("scheme_code").alias("by_isin"))
    return n.join(dim, "isin").select("load_seq", "by_isin")


@query("join02_asof_feature_row", f"""WITH {BARS}, f AS (SELECT symbol, feed_id, timestamp AS ft, arg_max(close, load_seq) AS fclose FROM features WHERE close IS NOT NULL AND NOT isnan(close) GROUP BY ALL)
SELECT b.symbol, b.feed_id, b.ts, coalesce(f.fclose, 0.0) AS fclose FROM bars b ASOF LEFT JOIN f ON b.symbol = f.symbol AND b.feed_id = f.feed_id AND b.ts >= f.ft""")
def asof_feature(spark, d):
    f = dedupe.keep_last(table(spark, d, "features").where(m.finite(F.col("close")).isNotNull()), ["symbol", "feed_id", "timestamp"], ["load_seq"]).select("symbol", "feed_id", F.col("timestamp").alias("ft"), F.col("close").alias("fclose"))
    return asof.backward(bars(spark, d).select(*KEY), f, "ts", "ft", ["symbol", "feed_id"], ["fclose"], default=0.0)


@query("agg11_load_counters", "SELECT source, count(*) AS n_rows, count(*) FILTER (nav IS NULL OR NOT isfinite(nav)) AS n_missing, count(*) FILTER (nav <= 0) AS n_bad, count(*) FILTER (isfinite(nav) AND nav > 0) AS n_ok FROM nav_history GROUP BY source")
def counters(spark, d):
    n = table(spark, d, "nav_history").withColumn("x", m.finite(F.col("nav"))).withColumn("neg", (F.col("nav") <= 0) & ~F.isnan("nav"))
    return n.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("x").isNull()).alias("n_missing"), F.count_if("neg").alias("n_bad"), F.count_if(F.col("x") > 0).alias("n_ok"))


@query("agg13_total_rows", "SELECT 'features' AS name, count(*) AS n FROM features UNION ALL SELECT 'gap_vector', count(*) FROM gap_vector UNION ALL SELECT 'nav_history', count(*) FROM nav_history")
def totals(spark, d):
    parts = [table(spark, d, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n") for t in ("features", "gap_vector", "nav_history")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("src04_nst11_nav_lines", "SELECT load_seq, scheme_code, isin, scheme_name, nav, nav_date FROM (SELECT load_seq, scheme_code, CASE WHEN coalesce(isin, '') NOT IN ('', '-') THEN isin END AS isin, trim(scheme_name) AS scheme_name, nav, strftime(try_strptime(trim(nav_date), ['%d-%m-%Y', '%d-%b-%Y', '%Y-%m-%d']), '%Y-%m-%d') AS nav_date FROM nav_history) WHERE nav_date IS NOT NULL AND isfinite(nav)")
def nav_lines(spark, d):
    """NAV rows written as semicolon lines and read back: names hold semicolons, some lines are junk."""
    n = table(spark, d, "nav_history")
    line = F.concat_ws(";", F.col("scheme_code").cast("string"), F.coalesce("isin", F.lit("-")), F.lit(""), "scheme_name", F.coalesce(F.col("nav").cast("string"), F.lit("N.A.")), F.coalesce("nav_date", F.lit("")))
    return nav_text.parse_lines(n.select("load_seq", line.alias("value")), keep=["load_seq"]).select("load_seq", "scheme_code", "isin", "scheme_name", "nav", "nav_date")


@query("nst09_posexplode", "SELECT vec_id, CAST(i - 1 AS INTEGER) AS horizon, round(CAST(embedding[i] AS DOUBLE), 6) AS value FROM embeddings, unnest(generate_series(1, len(embedding))) AS t(i)")
def posexplode(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("horizon", "value")).select("vec_id", "horizon", F.round(F.col("value").cast("double"), 6).alias("value"))


@query("snk03_join10_upsert", "SELECT load_seq, scheme_code, nav_date, nav FROM nav_history QUALIFY row_number() OVER (PARTITION BY scheme_code, nav_date ORDER BY load_seq % 2 DESC, load_seq DESC) = 1")
def upsert(spark, d):
    n = table(spark, d, "nav_history").select("load_seq", "scheme_code", "nav_date", "nav")
    keys = ["scheme_code", "nav_date"]
    old = dedupe.keep_last(n.where("load_seq % 2 = 0"), keys, ["load_seq"])
    return lake.merged(old, n.where("load_seq % 2 = 1"), keys, ["load_seq"])


@query("snk08_conform", "SELECT symbol, CAST(NULL AS DOUBLE) AS total_assets, close FROM features")
def conform(spark, d):
    from pyspark.sql import types as T

    layout = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("total_assets", T.DoubleType()), T.StructField("close", T.DoubleType())])
    return lake.conform(table(spark, d, "features"), layout)


@query("wnd22_keep_first_per_key", "SELECT scheme_code, min(load_seq) AS load_seq FROM nav_history GROUP BY scheme_code")
def keep_first(spark, d):
    return dedupe.keep_first(table(spark, d, "nav_history").select("scheme_code", "load_seq"), ["scheme_code"], ["load_seq"])
