"""Queries on bars, sessions and windows, each with its DuckDB statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import asof, chunks, dedupe, gap_model, series
from marketloom.operators.calendar import session_shape
from marketloom.plans.registry import query
from marketloom.session import table, written

KEY = ["symbol", "feed_id", "ts"]
BARS = """bars AS (
  SELECT symbol, feed_id, timestamp AS ts, open, close, volume FROM hourly_prices
  WHERE close > 0 AND open > 0 AND volume >= 0 AND isfinite(close) AND isfinite(open) AND isfinite(volume)
  QUALIFY row_number() OVER (PARTITION BY symbol, feed_id, timestamp ORDER BY ingested_at DESC, load_seq DESC) = 1)"""
MASKS = """masks AS (
  SELECT *, coalesce(day <> lag(day) OVER w, true) AS is_open, coalesce(day <> lead(day) OVER w, true) AS is_close,
         coalesce((epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 3.6e9, 1.0) AS hours_since
  FROM (SELECT *, CAST((epoch_us(ts) + 19800000000) // 86400000000 AS INTEGER) AS day FROM bars)
  WINDOW w AS (PARTITION BY symbol, feed_id ORDER BY ts))"""
W = "PARTITION BY symbol, feed_id ORDER BY ts"


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.clean_bars(table(spark, sf_dir, "hourly_prices"))


def r8(c, name: str):
    return F.round(c, 8).alias(name)


@query("flt01_sound_bars", f"WITH {BARS} SELECT * FROM bars")
def flt01(spark, d):
    return bars(spark, d)


@query("win01_log_return", f"WITH {BARS} SELECT symbol, feed_id, ts, round(ln(close) - lag(ln(close)) OVER ({W}), 8) AS log_return FROM bars")
def win01(spark, d):
    return bars(spark, d).select(*KEY, r8(series.log_return(F.col("close"), series.in_time()), "log_return"))


_RET = f"rets AS (SELECT *, ln(close) - lag(ln(close)) OVER ({W}) AS r FROM bars)"


def _returns(spark, d):
    return bars(spark, d).withColumn("r", series.log_return(F.col("close"), series.in_time()))


_DOWN = f"""WITH {BARS}, {_RET}, down AS (
SELECT symbol, feed_id, ts,
       CASE WHEN count(*) OVER t >= 30 THEN round(avg(CASE WHEN r < 0 THEN 1.0 ELSE 0.0 END) OVER t, 8) END AS fall_probability,
       CASE WHEN count(r) OVER t >= 30 THEN round(quantile_cont(r, CAST(0.1 AS DOUBLE)) OVER t, 8) END AS fall_q10
FROM rets WINDOW t AS ({W} ROWS BETWEEN 119 PRECEDING AND CURRENT ROW))"""


@query("win07_08_downside", f"{_DOWN} SELECT * FROM down")
def downside(spark, d):
    got = chunks.downside(chunks.ranked(bars(spark, d).select(*KEY, "close"), series.SOURCE), series.SOURCE)
    return got.select(*KEY, r8("fall_probability", "fall_probability"), r8("fall_q10", "fall_q10"))


@query("win09_latest_downside", f"{_DOWN} SELECT symbol, feed_id, coalesce(arg_max(fall_probability, ts), 0.5) AS fall_probability, coalesce(arg_max(fall_q10, ts), 0.0) AS fall_q10 FROM down WHERE (symbol, feed_id, ts) IN (SELECT (symbol, feed_id, max(ts)) FROM bars GROUP BY symbol, feed_id) GROUP BY ALL")
def latest_downside(spark, d):
    last = dedupe.keep_last(downside(spark, d), series.SOURCE, ["ts"])
    return last.select(*series.SOURCE, F.coalesce("fall_probability", F.lit(0.5)).alias("fall_probability"), F.coalesce("fall_q10", F.lit(0.0)).alias("fall_q10"))


@query("win13_14_session_masks", f"WITH {BARS}, {MASKS} SELECT symbol, feed_id, ts, is_open, is_close, round(ln(1 + greatest(hours_since, 0)), 8) AS hours_since_prev FROM masks")
def masks(spark, d):
    return series.session_masks(bars(spark, d)).select(*KEY, "is_open", "is_close", r8(F.log1p(F.greatest("hours_since", F.lit(0.0))), "hours_since_prev"))


@query(
    "win15_18_session_gaps",
    f"""WITH {BARS}, {MASKS},
a AS (SELECT *, last_value(CASE WHEN is_close THEN close END IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pc FROM masks),
b AS (SELECT *, CASE WHEN is_open THEN ln(open) - ln(pc) ELSE 0.0 END AS gap, CASE WHEN is_close THEN ln(close / pc) END AS dr FROM a)
SELECT symbol, feed_id, ts, round(gap, 8) AS gap,
       round(last_value(nullif(gap, 0.0) IGNORE NULLS) OVER w, 8) AS last_gap, round(last_value(dr IGNORE NULLS) OVER w, 8) AS prev_day_return,
       CAST(hours_since >= 40 AND is_open AS DOUBLE) AS is_weekend_gap
FROM b WINDOW w AS ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def gaps(spark, d):
    g = series.session_gaps(bars(spark, d))
    return g.select(*KEY, r8(F.col("gap"), "gap"), r8(F.col("last_gap"), "last_gap"), r8(F.col("prev_day_return"), "prev_day_return"), "is_weekend_gap")


_BPD = """bpd AS (SELECT symbol, feed_id, CAST(greatest(1, round_even(median(n), 0)) AS INTEGER) AS bars
  FROM (SELECT symbol, feed_id, (epoch_us(ts) + 19800000000) // 86400000000 AS day, count(*) AS n FROM bars GROUP BY ALL) GROUP BY ALL)"""


@query("agg01_bars_per_day", f"WITH {BARS}, {_BPD} SELECT * FROM bpd")
def agg01(spark, d):
    return series.bars_per_day(bars(spark, d))


_WIDE = f"""WITH {BARS}, {_RET}, {_BPD},
x AS (SELECT rets.*, bpd.bars AS k, ln(1 + volume) AS lv, ln(1 + volume) - lag(ln(1 + volume)) OVER ({W}) AS dv,
             row_number() OVER ({W}) AS i FROM rets JOIN bpd USING (symbol, feed_id)),
k5 AS (SELECT a.symbol, a.feed_id, a.ts, any_value(a.i) AS i, any_value(a.k) AS k, any_value(a.lv) AS lv, any_value(a.dv) AS dv, any_value(a.close) AS close,
  stddev_pop(b.r) FILTER (b.i > a.i - 5 * a.k) AS s5, count(b.r) FILTER (b.i > a.i - 5 * a.k) AS n5,
  stddev_pop(b.r) FILTER (b.i > a.i - 20 * a.k) AS s20, count(b.r) FILTER (b.i > a.i - 20 * a.k) AS n20,
  avg(b.lv) FILTER (b.i > a.i - greatest(20 * a.k, 35)) AS ml, stddev_pop(b.lv) FILTER (b.i > a.i - greatest(20 * a.k, 35)) AS sl, count(b.lv) FILTER (b.i > a.i - greatest(20 * a.k, 35)) AS nl,
  avg(b.dv) FILTER (b.i > a.i - 20 * a.k) AS md, stddev_pop(b.dv) FILTER (b.i > a.i - 20 * a.k) AS sd, count(b.dv) FILTER (b.i > a.i - 20 * a.k) AS nd,
  any_value(b.close) FILTER (b.i = a.i - 5 * a.k) AS c5, any_value(b.close) FILTER (b.i = a.i - 20 * a.k) AS c20
  FROM x a JOIN x b ON a.symbol = b.symbol AND a.feed_id = b.feed_id AND b.i <= a.i AND b.i >= a.i - greatest(20 * a.k, 35) GROUP BY a.symbol, a.feed_id, a.ts)
SELECT symbol, feed_id, ts, round(ln(close) - ln(c5), 7) AS ret_5d, round(ln(close) - ln(c20), 7) AS ret_20d,
  round(CASE WHEN n5 >= 5 * k THEN s5 END, 7) AS vol_5d, round(CASE WHEN n20 >= 20 * k THEN s20 END, 7) AS vol_20d,
  round((lv - ml) / nullif(CASE WHEN nl >= greatest(20 * k, 35) THEN sl END, 0), 5) AS log_volume_norm,
  round((dv - md) / nullif(CASE WHEN nd >= 20 * k THEN sd END, 0), 5) AS volume_change
FROM k5"""


@query("win02_06_data_sized_windows", _WIDE)
def sized(spark, d):
    b = bars(spark, d)
    rows = chunks.ranked(b.join(series.bars_per_day(b), series.SOURCE).select(*KEY, "bars", "close", "volume"), series.SOURCE)
    x = chunks.sized_windows(rows, series.SOURCE)
    return x.select(*KEY, *(F.round(c, 7).alias(c) for c in ("ret_5d", "ret_20d", "vol_5d", "vol_20d")), *(F.round(c, 5).alias(c) for c in ("log_volume_norm", "volume_change")))


EWM = f"""WITH RECURSIVE {BARS}, {_BPD},
x AS (SELECT symbol, feed_id, ts, close, 14 * bars AS n, row_number() OVER ({W}) AS i, close - lag(close) OVER ({W}) AS move FROM bars JOIN bpd USING (symbol, feed_id)),
run AS (
  SELECT symbol, feed_id, i, ts, n, CAST(NULL AS DOUBLE) AS g, CAST(NULL AS DOUBLE) AS l, ln(close) AS f, ln(close) AS s, CAST(0 AS DOUBLE) AS m FROM x WHERE i = 1
  UNION ALL
  SELECT x.symbol, x.feed_id, x.i, x.ts, x.n,
         CASE WHEN x.i = 2 THEN greatest(move, 0) ELSE g + (greatest(move, 0) - g) / x.n END,
         CASE WHEN x.i = 2 THEN greatest(-move, 0) ELSE l + (greatest(-move, 0) - l) / x.n END,
         f + (ln(close) - f) * 2 / 13, s + (ln(close) - s) * 2 / 27,
         m + ((f + (ln(close) - f) * 2 / 13) - (s + (ln(close) - s) * 2 / 27) - m) * 2 / 10
  FROM run JOIN x ON x.symbol = run.symbol AND x.feed_id = run.feed_id AND x.i = run.i + 1)
SELECT symbol, feed_id, ts, round(CASE WHEN i > n AND l > 0 THEN 1 - 2 / (1 + g / l) ELSE 0 END, 6) AS rsi_14d, round(f - s - m, 8) AS macd_hist FROM run"""


@query("win10_12_ewm", EWM)
def ewm(spark, d):
    b = bars(spark, d)
    rows = b.join(series.bars_per_day(b).withColumn("rsi_length", F.col("bars") * 14), series.SOURCE).select(*KEY, "close", "rsi_length")
    e = chunks.exponential_means(chunks.ranked(rows, series.SOURCE), series.SOURCE, settle=written)
    return e.select(*KEY, F.round(F.coalesce(series.rsi(F.col("avg_gain"), F.col("avg_loss")), F.lit(0.0)), 6).alias("rsi_14d"), r8("macd_hist", "macd_hist"))


@query("agg02_03_session_shape", f"""WITH {BARS},
s AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER ({W}) AS step, ((epoch_us(ts) + 19800000000) // 60000000) % 1440 AS minute FROM bars)
SELECT symbol, feed_id, CAST(coalesce(median(step) FILTER (step <= 14400000000), 3600000000) AS BIGINT) AS step_us,
  CASE WHEN floor(quantile_cont(minute, 0.95::DOUBLE)) <= floor(quantile_cont(minute, 0.05::DOUBLE)) THEN 555 ELSE CAST(floor(quantile_cont(minute, 0.05::DOUBLE)) AS INTEGER) END AS start_minute,
  CASE WHEN floor(quantile_cont(minute, 0.95::DOUBLE)) <= floor(quantile_cont(minute, 0.05::DOUBLE)) THEN 915 ELSE CAST(floor(quantile_cont(minute, 0.95::DOUBLE)) AS INTEGER) END AS end_minute
FROM s GROUP BY symbol, feed_id""")
def session_shape_query(spark, d):
    return session_shape(bars(spark, d))


@query("srt07_last_bars", f"WITH {BARS} SELECT symbol, feed_id, ts, close FROM bars QUALIFY row_number() OVER (PARTITION BY symbol, feed_id ORDER BY ts DESC) <= 80")
def last_bars(spark, d):
    return dedupe.keep_last(bars(spark, d), series.SOURCE, ["ts"], n=80).select(*KEY, "close")


_DAILY = "daily AS (SELECT series_name, CAST(trade_date AS TIMESTAMP) AS day, arg_max(day_return, (known_at, obs_id)) AS v FROM market_returns WHERE day_return IS NOT NULL AND NOT isnan(day_return) GROUP BY ALL)"


@query("join01_asof_daily", f"""WITH {BARS}, {_DAILY}
SELECT symbol, feed_id, ts, coalesce(v, 0.0) AS nifty_log_return
FROM bars ASOF LEFT JOIN (SELECT epoch_us(day) AS us, v FROM daily WHERE series_name = 'nifty') n ON epoch_us(bars.ts) >= n.us""")
def asof_daily(spark, d):
    return with_nifty(spark, d, bars(spark, d).select(*KEY))


def with_nifty(spark, d, rows):
    """rows with the nifty return of their day or the last one before; 0 where there is none."""
    returns = asof.daily_series(table(spark, d, "market_returns")).select("series_name", "trade_date", "day_return", F.lit(0).alias("obs_id"))
    # a union with one series would sort all bars in one task; dyadic nodes leave them where they are
    return gap_model.with_market(rows, "ts", returns, known=False, series={"nifty": "nifty_log_return"})


@query("join07_previous_bar", f"WITH {BARS}, {MASKS} SELECT symbol, feed_id, ts, round(ln(open / pc), 8) AS target FROM (SELECT *, lag(close) OVER ({W}) AS pc FROM masks) WHERE is_open AND pc IS NOT NULL")
def previous_bar(spark, d):
    g = series.session_gaps(bars(spark, d))
    return g.where("is_open AND gap IS NOT NULL").select(*KEY, r8(F.col("gap"), "target"))


@query("join04_left_lookup", f"""WITH {BARS}, f AS (SELECT symbol, feed_id, timestamp AS ts, ret_5d, vol_5d FROM features QUALIFY row_number() OVER (PARTITION BY symbol, feed_id, timestamp ORDER BY load_seq DESC) = 1)
SELECT symbol, feed_id, ts, close, ret_5d, vol_5d FROM bars LEFT JOIN f USING (symbol, feed_id, ts)""")
def left_lookup(spark, d):
    f = dedupe.keep_last(table(spark, d, "features").withColumnRenamed("timestamp", "ts"), KEY, ["load_seq"]).select(*KEY, "ret_5d", "vol_5d")
    return bars(spark, d).join(f, KEY, "left").select(*KEY, "close", "ret_5d", "vol_5d")


@query("flt09_10_origin_and_holdout", f"""WITH {BARS}, o AS (SELECT symbol, feed_id, max(ts) AS origin FROM bars WHERE ts < TIMESTAMPTZ '2025-01-01 00:00:00+00' GROUP BY ALL)
SELECT symbol, feed_id, origin, row_number() OVER ({W}) AS horizon, ts, close FROM bars JOIN o USING (symbol, feed_id) WHERE ts > origin QUALIFY horizon <= 24""")
def holdout(spark, d):
    b = bars(spark, d)
    cut = F.lit("2025-01-01 00:00:00+00:00").cast("timestamp")
    o = b.where(F.col("ts") < cut).groupBy(*series.SOURCE).agg(F.max("ts").alias("origin"))
    h = b.join(o, series.SOURCE).where("ts > origin").withColumn("horizon", F.row_number().over(series.in_time()))
    return h.where("horizon <= 24").select(*series.SOURCE, "origin", F.col("horizon").cast("long").alias("horizon"), "ts", "close")


@query("agg06_ols_slope", f"WITH {BARS}, i AS (SELECT *, CAST(row_number() OVER ({W}) - 1 AS DOUBLE) AS i, ln(close) AS y FROM bars) SELECT symbol, feed_id, round(coalesce(regr_slope(y, i), 0), 9) AS slope, count(*) AS n FROM i GROUP BY ALL")
def ols_slope(spark, d):
    i = bars(spark, d).select(*series.SOURCE, F.ln("close").alias("y"), (F.row_number().over(series.in_time()) - 1).cast("double").alias("i"))
    return i.groupBy(*series.SOURCE).agg(F.round(F.coalesce(F.regr_slope("y", "i"), F.lit(0.0)), 9).alias("slope"), F.count(F.lit(1)).alias("n"))


@query("agg14_first_bar", f"WITH {BARS} SELECT symbol, min(ts) AS first_ts, arg_min(close, (ts, feed_id)) AS first_close FROM bars GROUP BY symbol")
def first_bar(spark, d):
    return bars(spark, d).groupBy("symbol").agg(F.min("ts").alias("first_ts"), F.min_by("close", F.struct("ts", "feed_id")).alias("first_close"))


@query("ded02_keep_last_bar", "SELECT symbol, feed_id, timestamp AS ts, arg_max(load_seq, (ingested_at, load_seq)) AS load_seq FROM hourly_prices GROUP BY ALL")
def ded02(spark, d):
    return dedupe.keep_last(table(spark, d, "hourly_prices").withColumnRenamed("timestamp", "ts"), KEY, ["ingested_at", "load_seq"]).select(*KEY, "load_seq")


@query("ded03_keep_last_second", "SELECT symbol, to_timestamp(epoch_us(timestamp) // 1000000) AS ts, max(load_seq) AS load_seq FROM hourly_prices GROUP BY ALL")
def ded03(spark, d):
    p = table(spark, d, "hourly_prices").withColumn("ts", F.date_trunc("second", "timestamp"))
    return dedupe.keep_last(p, ["symbol", "ts"], ["load_seq"]).select("symbol", "ts", "load_seq")
