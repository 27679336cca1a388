"""Queries on features, the gap model, forecast paths and signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import calendar, chunks, features, forecast, gap_model, predict, series
from marketloom.plans.registry import ORACLES, query
from marketloom.plans.series_queries import BARS, EWM, KEY, MASKS, bars, with_nifty
from marketloom.session import table, work_dir, written

SRC = series.SOURCE
_PATHS = f"""{BARS.replace("open, close, volume FROM", "open, close, volume, CASE WHEN isfinite(next_hour_return) THEN next_hour_return ELSE 0.0 END AS r FROM")},
tail AS (SELECT *, row_number() OVER (PARTITION BY symbol, feed_id ORDER BY ts DESC) AS back FROM bars),
o AS (SELECT symbol, feed_id, close AS origin_price FROM tail WHERE back = 25),
raw AS (SELECT symbol, feed_id, CAST(25 - back AS INTEGER) AS horizon, r AS predicted_log_return, close AS actual_price, origin_price FROM tail JOIN o USING (symbol, feed_id) WHERE back <= 24),
paths AS (SELECT *, sum(predicted_log_return) OVER (PARTITION BY symbol, feed_id ORDER BY horizon) AS origin_log_return,
                 origin_price * exp(sum(predicted_log_return) OVER (PARTITION BY symbol, feed_id ORDER BY horizon)) AS predicted_price FROM raw)"""


def paths(spark, d):
    """The stored next-hour forecasts of each source's last 24 bars, read as one path from the bar before."""
    r = series.clean_bars(table(spark, d, "hourly_prices"), carry=["next_hour_return"])
    back = F.row_number().over(series.Window.partitionBy(*SRC).orderBy(F.desc("ts")))
    t = r.select(*KEY, "close", forecast.finite_or_zero(F.col("next_hour_return")).alias("r"), back.alias("back")).where("back <= 25")
    o = t.where("back = 25").select(*SRC, F.col("close").alias("origin_price"))
    raw = t.where("back <= 24").join(o, SRC).select(*SRC, (25 - F.col("back")).alias("horizon"), F.col("r").alias("predicted_log_return"), F.col("close").alias("actual_price"), "origin_price")
    return forecast.reconstruct(raw, SRC)


def _r(c, n=7):
    return F.round(c, n).alias(c)


@query("mdl08_win19_path", f"WITH {_PATHS} SELECT symbol, feed_id, horizon, round(origin_log_return, 7) AS origin_log_return, round(predicted_price, 5) AS predicted_price FROM paths")
def path(spark, d):
    return paths(spark, d).select(*SRC, "horizon", _r("origin_log_return"), _r("predicted_price", 5))


@query("set04_mdl09_origin_row", f"WITH {_PATHS} SELECT symbol, feed_id, horizon, round(predicted_price, 5) AS predicted_price, actual_price FROM paths UNION ALL SELECT symbol, feed_id, 0, origin_price, origin_price FROM paths WHERE horizon = 1")
def origin_row(spark, d):
    return forecast.prepend_origin(paths(spark, d), SRC).select(*SRC, "horizon", F.round("predicted_price", 5).alias("predicted_price"), "actual_price")


#: Blocks of 24 bars before the last one from which bands are made.
BLOCKS = 30
_BANDS = f"""{BARS.replace("open, close, volume FROM", "open, close, volume, CASE WHEN isfinite(next_hour_return) THEN next_hour_return ELSE 0.0 END AS r FROM")},
tail AS (SELECT *, row_number() OVER (PARTITION BY symbol, feed_id ORDER BY ts DESC) AS back FROM bars),
o AS (SELECT symbol, feed_id, (back - 25) // 24 AS block, close AS origin_price FROM tail WHERE back > 24 AND back % 24 = 1),
raw AS (SELECT symbol, feed_id, block, CAST(24 - (back - 1) % 24 AS INTEGER) AS horizon, r, close AS actual_price, origin_price FROM (SELECT *, (back - 1) // 24 AS block FROM tail) JOIN o USING (symbol, feed_id, block) WHERE block <= {BLOCKS}),
paths AS (SELECT *, sum(r) OVER (PARTITION BY symbol, feed_id, block ORDER BY horizon) AS origin_log_return FROM raw),
bands AS (SELECT symbol, feed_id, horizon, avg(e) AS bias, avg(e) - quantile_cont(e, 0.9::DOUBLE) AS q10, avg(e) - quantile_cont(e, 0.1::DOUBLE) AS q90
  FROM (SELECT *, origin_log_return - ln(actual_price / origin_price) AS e FROM paths WHERE block > 0) GROUP BY ALL)"""


def blocks(spark, d):
    """The stored next-hour forecasts read as paths of 24 bars: block 0 is the last one, each earlier block a path of its own."""
    r = chunks.ranked(series.clean_bars(table(spark, d, "hourly_prices"), carry=["next_hour_return"]), SRC)
    t = r.withColumn("back", F.col("n") - F.col("i")).where(F.col("back") <= 24 * (BLOCKS + 1) + 1)
    o = t.where("back > 24 AND back % 24 = 1").select(*SRC, F.expr("(back - 25) DIV 24").alias("block"), F.col("close").alias("origin_price"))
    raw = t.withColumn("block", F.expr("(back - 1) DIV 24")).join(o, [*SRC, "block"])
    raw = raw.select(*SRC, "block", (24 - (F.col("back") - 1) % 24).cast("int").alias("horizon"), forecast.finite_or_zero(F.col("next_hour_return")).alias("predicted_log_return"), F.col("close").alias("actual_price"), "origin_price")
    return forecast.reconstruct(raw, [*SRC, "block"])


@query("agg04_05_mdl12_13_bands", f"WITH {_BANDS} SELECT symbol, feed_id, horizon, round(bias, 7) AS bias, round(q10, 7) AS q10, round(q90, 7) AS q90 FROM bands")
def bands(spark, d):
    """Each source's bias and band of each horizon, by how its earlier blocks came out."""
    return forecast.calibrate(forecast.residuals(blocks(spark, d).where("block > 0")), SRC).select(*SRC, "horizon", _r("bias"), _r("q10"), _r("q90"))


@query("mdl10_calibrated_path", f"WITH {_BANDS} SELECT symbol, feed_id, horizon, round(origin_price * exp(origin_log_return - coalesce(bias, 0)), 4) AS predicted_price, round(origin_price * exp(origin_log_return - bias + q10), 4) AS price_q10, round(origin_price * exp(origin_log_return - bias + q90), 4) AS price_q90 FROM paths LEFT JOIN bands USING (symbol, feed_id, horizon) WHERE block = 0")
def calibrated(spark, d):
    """The last block, shifted and banded by the blocks before it: no block has a say in its own band."""
    p = blocks(spark, d)
    known = forecast.calibrate(forecast.residuals(p.where("block > 0")), SRC)
    out = forecast.apply_calibration(p.where("block = 0"), known, SRC)
    return out.select(*SRC, "horizon", _r("predicted_price", 4), _r("price_q10", 4), _r("price_q90", 4))


_LABEL = "CASE WHEN {0} > 0.005 THEN 'BUY' WHEN {0} < -0.005 THEN 'SELL' ELSE 'HOLD' END"
_SIGNALS = f"""WITH {_PATHS},
st AS (SELECT *, ln(predicted_price) AS l, ln(predicted_price) - lag(ln(predicted_price)) OVER (PARTITION BY symbol, feed_id ORDER BY horizon) AS s, ln(actual_price) AS a FROM paths),
g AS (SELECT symbol, feed_id, arg_max(l, horizon) - arg_min(l, horizon) AS path_return, avg(s) AS mean_step, count(*) FILTER (s > 0.0015) AS up_steps, count(*) FILTER (s < -0.0015) AS down_steps, count(s) AS n_steps,
  count(*) FILTER (s > 0) AS rises, count(*) FILTER (s < 0) AS falls, arg_max(a, horizon) - arg_min(a, horizon) AS actual_path_return FROM st GROUP BY ALL),
x AS (SELECT *, {_LABEL.format('path_return')} AS signal, {_LABEL.format('actual_path_return')} AS actual_signal,
  CASE WHEN path_return = 0 THEN 1.0 ELSE (1 - 2 / (exp(2 * least(abs(path_return) / 0.005, 50)) + 1)) * (CASE WHEN path_return > 0 THEN rises ELSE falls END) / n_steps END AS confidence FROM g)"""


@query("mdl14_15_agg07_signals", f"{_SIGNALS} SELECT symbol, feed_id, signal, round(path_return, 6) AS path_return, round(mean_step, 7) AS mean_step, up_steps, down_steps, n_steps - up_steps - down_steps AS flat_steps, round(confidence, 6) AS confidence, actual_signal, signal = actual_signal AS signal_match FROM x")
def signals(spark, d):
    s = forecast.signals(paths(spark, d), SRC)
    return s.select(*SRC, "signal", _r("path_return", 6), _r("mean_step"), "up_steps", "down_steps", "flat_steps", _r("confidence", 6), "actual_signal", "signal_match")


@query("agg09_hit_rate", f"{_SIGNALS} SELECT count(*) AS n, round(avg(CASE WHEN signal = actual_signal THEN 1.0 ELSE 0.0 END), 6) AS signal_accuracy, round(avg(CASE WHEN sign(path_return) = sign(actual_path_return) AND path_return <> 0 AND actual_path_return <> 0 THEN 1.0 ELSE 0.0 END), 6) AS direction_accuracy, count(*) FILTER (signal = 'BUY') AS pred_buy, count(*) FILTER (signal = 'HOLD') AS pred_hold, count(*) FILTER (signal = 'SELL') AS pred_sell FROM x")
def hit_rate(spark, d):
    return forecast.hit_rate(forecast.signals(paths(spark, d), SRC)).select("n", _r("signal_accuracy", 6), _r("direction_accuracy", 6), "pred_buy", "pred_hold", "pred_sell")


@query("mdl16_snk10_step_records", f"WITH {_PATHS} SELECT symbol, feed_id, horizon, CASE WHEN predicted_log_return > 0.0015 THEN 'BUY' WHEN predicted_log_return < -0.0015 THEN 'SELL' ELSE 'HOLD' END AS step_signal, round(greatest(-1.0, least(1.0, predicted_log_return / 0.0015)), 6) AS step_strength FROM paths")
def step_records(spark, d):
    return forecast.step_signals(paths(spark, d)).select(*SRC, "horizon", "step_signal", _r("step_strength", 6))


_ASOF = ", ".join(f"coalesce((SELECT arg_max(day_return, (trade_date, known_at, obs_id)) FROM market_returns m WHERE m.series_name = '{s}' AND m.known_at <= e.event_time AND m.day_return IS NOT NULL AND NOT isnan(m.day_return)), 0.0) AS {c}" for s, c in features.GAP_MARKET.items())


@query("join03_five_way_asof", f"SELECT event_id, {_ASOF} FROM gap_vector e WHERE event_time IS NOT NULL")
def five_way(spark, d):
    e = table(spark, d, "gap_vector").where("event_time IS NOT NULL").select("event_id", "event_time")
    return gap_model.with_market(e, "event_time", table(spark, d, "market_returns")).drop("event_time")


def feature_frame(spark, d):
    return features.build(with_nifty(spark, d, bars(spark, d)))


def settled_features(spark, d):
    """The feature frame, written once where several branches read it."""
    return written(feature_frame(spark, d), "features")


def _unrounded(sql: str) -> str:
    """A statement without its round(x, digits), so that a statement made of it rounds once."""
    at = sql.find("round(")
    while at >= 0:
        depth, comma, i = 0, at, at + 6
        while depth or sql[i] != ")":
            depth += (sql[i] == "(") - (sql[i] == ")")
            comma = i if sql[i] == "," and not depth else comma
            i += 1
        sql = f"{sql[:at]}({sql[at + 6 : comma]}){sql[i + 1 :]}"
        at = sql.find("round(", at)
    return sql


_FRAME_DIGITS = 5
_MEANS = _unrounded(EWM).replace("(f - s - m) AS macd_hist", "f - s - m AS macd_hist, n // 14 AS k")
_PART = {k: _unrounded(ORACLES[k]) for k in ("win15_18_session_gaps", "win13_14_session_masks", "win02_06_data_sized_windows", "join01_asof_daily")}
_FRAME_COLUMNS = [c for c in (*features.EXTRA, *features.MODEL_COLUMNS) if c not in ("open", "close", "nifty_log_return")]
_FRAME = f"""SELECT symbol, feed_id, ts, i, n, open, close, nifty_log_return, {", ".join(f"round({f'coalesce({c}, 0.0)' if c in features.MODEL_COLUMNS else c}, {_FRAME_DIGITS}) AS {c}" for c in _FRAME_COLUMNS)}
FROM (SELECT symbol, feed_id, ts, open, close, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY symbol, feed_id) AS n, CAST(is_open AS DOUBLE) AS is_session_open, CAST(is_close AS DOUBLE) AS is_session_close, ln(close) - lag(ln(close)) OVER w AS log_return FROM (WITH {BARS}, {MASKS} SELECT * FROM masks) WINDOW w AS (PARTITION BY symbol, feed_id ORDER BY ts))
JOIN ({_PART["win15_18_session_gaps"]}) USING (symbol, feed_id, ts)
JOIN ({_PART["win13_14_session_masks"]}) USING (symbol, feed_id, ts)
JOIN ({_PART["win02_06_data_sized_windows"]}) USING (symbol, feed_id, ts)
JOIN ({_PART["join01_asof_daily"]}) USING (symbol, feed_id, ts)
JOIN (SELECT symbol, feed_id, ts, rsi_14d, CASE WHEN count(*) OVER z >= greatest(20 * k, 35) THEN (macd_hist - avg(macd_hist) OVER z) / nullif(stddev_pop(macd_hist) OVER z, 0) END AS macd_hist
      FROM ({_MEANS}) WINDOW z AS (PARTITION BY symbol, feed_id ORDER BY ts ROWS BETWEEN greatest(20 * k, 35) - 1 PRECEDING AND CURRENT ROW)) USING (symbol, feed_id, ts)"""


@query("mdl01_features", _FRAME)
def feature_query(spark, d):
    f = feature_frame(spark, d)
    return f.select(*KEY, "i", "n", "open", "close", "nifty_log_return", *(F.round(c, _FRAME_DIGITS).alias(c) for c in _FRAME_COLUMNS))


_ORIGINS = f"""WITH {BARS}, {MASKS},
counted AS (SELECT *, row_number() OVER (PARTITION BY symbol, feed_id ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY symbol, feed_id) AS n FROM masks)
SELECT symbol, feed_id, ts, i, close FROM counted WHERE is_close AND i + 1 >= 512 AND i + 1 < n
QUALIFY row_number() OVER (PARTITION BY symbol, feed_id ORDER BY i DESC) <= 30"""


@query("flt15_close_origins", _ORIGINS)
def origins(spark, d):
    return features.close_origins(feature_frame(spark, d), features.ORIGINS).select(*KEY, "i", "close")


_STEPS = f"""WITH RECURSIVE {BARS},
s AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY symbol, feed_id ORDER BY ts) AS step, ((epoch_us(ts) + 19800000000) // 60000000) % 1440 AS minute FROM bars),
q AS (SELECT symbol, feed_id, max(ts) AS origin, CAST(coalesce(median(step) FILTER (step <= 14400000000), 3600000000) AS BIGINT) AS step_us, CAST(floor(quantile_cont(minute, 0.05::DOUBLE)) AS BIGINT) AS a, CAST(floor(quantile_cont(minute, 0.95::DOUBLE)) AS BIGINT) AS z FROM s GROUP BY ALL),
shape AS (SELECT symbol, feed_id, origin, step_us, CASE WHEN z <= a THEN 555 ELSE a END AS a, CASE WHEN z <= a THEN 915 ELSE z END AS z FROM q),
walk AS (
  SELECT symbol, feed_id, origin, step_us, a, z, 0 AS horizon, epoch_us(origin) + 19800000000 AS t FROM shape
  UNION ALL
  SELECT symbol, feed_id, origin, step_us, a, z, horizon + 1, CASE WHEN target = day AND minute >= a THEN n ELSE target * 86400000000 + a * 60000000 END
  FROM (SELECT *, moved + CASE WHEN (moved + 3) % 7 >= 5 THEN 7 - (moved + 3) % 7 ELSE 0 END AS target FROM (
    SELECT *, day + CASE WHEN (day + 3) % 7 < 5 AND minute > z THEN 1 ELSE 0 END AS moved FROM (
      SELECT *, t + step_us AS n, (t + step_us) // 86400000000 AS day, ((t + step_us) // 60000000) % 1440 AS minute FROM walk WHERE horizon < 24)))),
out AS (SELECT symbol, feed_id, origin, horizon, to_timestamp(0) + to_microseconds(t - 19800000000) AS ts FROM walk WHERE horizon > 0)
SELECT *, first_value(ts) OVER (PARTITION BY symbol, feed_id ORDER BY horizon) - INTERVAL 1 MINUTE AS cutoff FROM out"""


@query("mdl02_03_next_bars", _STEPS)
def next_bars(spark, d):
    b = bars(spark, d)
    o = b.groupBy(*SRC).agg(F.max("ts").alias("origin")).join(calendar.session_shape(b), SRC)
    n = calendar.next_bars(o, 24, [*SRC, "origin"])
    first = F.first_value("ts").over(series.Window.partitionBy(*SRC).orderBy("horizon"))
    return n.withColumn("cutoff", calendar.information_cutoff(first, F.col("origin")))


_LAGGED = ", ".join(f"lag({c}) OVER w AS {c}" for c in features.GAP_OWN)
_TRAINING = f"""WITH fr AS ({_FRAME}),
l AS (SELECT symbol, feed_id, ts, is_session_open, open, lag(close) OVER w AS pc, {_LAGGED} FROM fr WINDOW w AS (PARTITION BY symbol, feed_id ORDER BY ts)),
e AS (SELECT *, ts - INTERVAL 1 MINUTE AS event_time FROM l WHERE is_session_open > 0.5 AND pc > 0 AND open > 0)
SELECT symbol, feed_id, ts, round(ln(open / pc), 8) AS target, {", ".join(f"coalesce({c}, 0.0) AS {c}" for c in features.GAP_OWN)}, {_ASOF} FROM e"""


@query("flt11_training_rows", _TRAINING)
def training(spark, d):
    t = gap_model.training_rows(feature_frame(spark, d), table(spark, d, "market_returns"))
    return t.select(*KEY, F.round("target", 8).alias("target"), *(F.round(c, _FRAME_DIGITS).alias(c) for c in features.GAP_OWN), *features.GAP_MARKET.values())


@query("win21_mdl07_first_steps", f"""WITH {BARS}, r AS (SELECT *, coalesce(ln(close) - lag(ln(close)) OVER w, 0.0) AS x, row_number() OVER w AS i FROM bars WINDOW w AS (PARTITION BY symbol, feed_id ORDER BY ts))
SELECT symbol, feed_id, ts, round(avg(x) OVER (PARTITION BY symbol, feed_id ORDER BY ts ROWS BETWEEN 119 PRECEDING AND CURRENT ROW), 9) AS first_step FROM r QUALIFY i >= 512""")
def first_steps(spark, d):
    """The stand-in forecaster over every whole context of 512 bars: the first of its 24 steps."""
    got = forecast.sliding(feature_frame(spark, d), forecast.drift)
    return got.select(*KEY, F.round(F.get("returns", F.lit(0)), 9).alias("first_step"))


@query("flt11_mdl04_gap_models")
def gap_models(spark, d):
    return gap_model.fit(gap_model.training_rows(settled_features(spark, d), table(spark, d, "market_returns")))


def hourly_table(spark, d, context: int = features.CONTEXT, forecaster: forecast.Forecaster = forecast.drift):
    """Next-hour forecast and trailing downside at every bar; the gap model speaks at session closes."""
    f = settled_features(spark, d)
    base = chunks.downside(chunks.ranked(bars(spark, d), SRC), SRC).select(*KEY, "open", "close", "volume", "fall_probability", "fall_q10")
    step = forecast.sliding(f, forecaster, context).select(*KEY, F.get("returns", F.lit(0)).alias("_f"))
    returns = table(spark, d, "market_returns")
    models = gap_model.fit(gap_model.training_rows(f, returns))
    closes = f.where("is_session_close > 0.5")
    shape = calendar.session_shape(bars(spark, d))
    nxt = calendar.next_bars(closes.select(*SRC, F.col("ts").alias("origin")).join(shape, SRC), 1, [*SRC, "origin"])
    cut = nxt.select(*SRC, F.col("origin").alias("_o"), calendar.information_cutoff(F.col("ts"), F.col("origin")).alias("_cut")).withColumnRenamed("_o", "ts")
    at_close = gap_model.with_market(closes.join(cut, KEY), "_cut", returns)
    gap = gap_model.predict(at_close.join(models.select(*SRC), SRC, "left_semi"), models).select(*KEY, "gap_hat")
    out = base.join(step, KEY, "left").join(gap, KEY, "left")
    r = F.when(F.col("_f").isNotNull(), F.coalesce("gap_hat", "_f"))
    out = out.withColumn("next_hour_return", r)
    return out.select(*KEY, "open", "close", "volume", forecast.label(F.col("next_hour_return"), forecast.STEP_THRESHOLD).alias("next_hour_direction"), "next_hour_return", forecast.signed_strength(F.col("next_hour_return"), forecast.STEP_THRESHOLD).alias("next_hour_strength"), "fall_probability", "fall_q10")


@query("mdl17_19_hourly_table")
def hourly(spark, d):
    return hourly_table(spark, d)


def rolling(spark, d, context: int = features.CONTEXT, forecaster: forecast.Forecaster = forecast.drift):
    """(the paths from each source's last bar, the bands of its own earlier session closes)."""
    return predict.rolling(settled_features(spark, d), bars(spark, d), table(spark, d, "market_returns"), context=context, forecaster=forecaster)


def directions(spark, d, context: int = features.CONTEXT, forecaster: forecast.Forecaster = forecast.drift):
    """The calibrated 24-bar outlook of every source from its last bar, with its steps' stamps."""
    p, known = rolling(spark, d, context, forecaster)
    return predict.stamped(forecast.apply_calibration(p.withColumnRenamed("ts", "origin"), known, SRC), bars(spark, d))


@query("mdl13_rolling_bands")
def rolling_bands(spark, d):
    return rolling(spark, d)[1]


@query("mdl10_13_rolling_path")
def rolling_path(spark, d):
    return directions(spark, d).select(*SRC, "origin", "horizon", "ts", "predicted_log_return", "origin_log_return", "predicted_price", "price_q10", "price_q90")


@query("mdl11_20_21_predictions")
def predictions(spark, d):
    return predict.signal_rows(directions(spark, d))


@query("mdl21_flt09_predictions_before_cutoff")
def predictions_before(spark, d):
    """What the public call gives for every source with bars before a cutoff, calibrated on closes before it."""
    returns = table(spark, d, "market_returns")
    return predict.predictions(bars(spark, d), returns, settled_features(spark, d), cutoff="2025-06-01 00:00:00+00:00", calibrate=True, missing="skip")[0]


@query("snk10_signal_rows", f"{_SIGNALS} SELECT symbol, feed_id, origin_price, signal, round(greatest(-1.0, least(1.0, path_return / 0.005)), 6) AS score, round(confidence, 6) AS confidence, round(path_return, 6) AS path_return FROM x JOIN (SELECT DISTINCT symbol, feed_id, origin_price FROM raw) USING (symbol, feed_id)")
def signal_row_query(spark, d):
    p = paths(spark, d).withColumn("origin", F.lit(None).cast("timestamp")).withColumn("gap", F.lit(None).cast("double"))
    return predict.signal_rows(p).select(*SRC, "origin_price", "signal", _r("score", 6), _r("confidence", 6), _r("path_return", 6))


@query("snk09_forecast_csv", f"WITH {_PATHS} SELECT symbol, feed_id, horizon, round(predicted_price, 5) AS predicted_price, actual_price FROM paths UNION ALL SELECT symbol, feed_id, 0, origin_price, origin_price FROM paths WHERE horizon = 1")
def forecast_csv(spark, d):
    """Origin and path as CSV files, read back."""
    p = forecast.prepend_origin(paths(spark, d), SRC).select(*SRC, "horizon", "predicted_price", "actual_price")
    return forecast.write_csv(p, work_dir(spark, "paths"), [*SRC, "horizon"]).select(*SRC, "horizon", F.round("predicted_price", 5).alias("predicted_price"), "actual_price")


@query("join08_positional_actuals", f"""WITH {BARS}, numbered AS (SELECT *, row_number() OVER (PARTITION BY symbol, feed_id ORDER BY ts) - 1 AS i FROM bars),
o AS (SELECT symbol, feed_id, max(i) AS i FROM numbered WHERE ts < TIMESTAMPTZ '2025-01-01 00:00:00+00' GROUP BY ALL), h AS (SELECT CAST(unnest(range(1, 25)) AS INTEGER) AS horizon)
SELECT o.symbol, o.feed_id, h.horizon, b.ts, b.close AS actual_price FROM o CROSS JOIN h LEFT JOIN numbered b ON b.symbol = o.symbol AND b.feed_id = o.feed_id AND b.i = o.i + h.horizon""")
def positional(spark, d):
    b = chunks.ranked(bars(spark, d), SRC)
    o = b.where(F.col("ts") < F.lit("2025-01-01 00:00:00+00:00").cast("timestamp")).groupBy(*SRC).agg(F.max("i").alias("i"))
    p = o.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(features.HORIZON))))
    return forecast.attach_actuals(p, b, SRC).select(*SRC, "horizon", "ts", "actual_price")
