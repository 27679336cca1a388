import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom import api
from marketloom.operators import calendar, features, forecast, gap_model, predict
from marketloom.plans import model_queries
from marketloom.session import written

CONTEXT, LAST = 60, 6
SRC = ["symbol", "feed_id"]


@pytest.fixture(scope="module")
def tables(spark):
    """A quiet and a lively source of 70 days, and one with bars after a single close; the session begins later in the last days."""
    r = np.random.default_rng(5)
    rows = []
    for symbol, size, days in (("quiet", 0.001, 70), ("lively", 0.02, 70), ("short", 0.002, 13)):
        price, day = 100.0, dt.datetime(2024, 1, 1)
        for k in range(days):
            while day.weekday() >= 5:
                day += dt.timedelta(days=1)
            for h in range(5 + (k > 66)):
                o = price * np.exp(r.normal(0.002 if h == 0 else 0, size))
                price = o * np.exp(r.normal(0, size))
                rows.append((symbol, 1, day + dt.timedelta(hours=4 + h), float(o), float(price), float(r.integers(100, 900))))
            day += dt.timedelta(days=1)
    bars = spark.createDataFrame(rows, "symbol string, feed_id long, ts timestamp, open double, close double, volume double")
    returns = spark.createDataFrame(
        [(s, dt.date(2024, 1, 1) + dt.timedelta(days=k), dt.datetime(2024, 1, 1, 18) + dt.timedelta(days=k), k, float(r.normal(0, 0.01))) for s in features.GAP_MARKET for k in range(110)],
        "series_name string, trade_date date, known_at timestamp, obs_id long, day_return double",
    )
    f = written(features.build(bars), "features")
    return bars, returns, f


def brute(f, training, market, last):
    """Origin by origin in a loop: {(symbol, origin i): [log return from the origin, by horizon]}."""
    out = {}
    for symbol, g in f.groupby("symbol"):
        g, t = g.sort_values("i").reset_index(drop=True), training[training.symbol == symbol].sort_values("ts")
        n = len(g)
        pool = [i for i in range(n) if g.is_session_close[i] > 0.5 and i + 1 >= CONTEXT and i + 1 < n][-last:]
        for i in pool + ([n - 1] if n >= CONTEXT else []):
            step = np.full(24, g.log_return[max(0, i - 119) : i + 1][-CONTEXT:].mean())
            step[0] = 0.0
            seen = t[t.ts < g.ts[i]]
            if len(seen) >= 40:
                coef, icept, _ = gap_model.fit_ridge(seen[features.GAP_COLUMNS].to_numpy(float), seen.target.to_numpy(float))
                own = [g[c][i] if np.isfinite(g[c][i]) else 0.0 for c in features.GAP_OWN]
                step[0] = icept + coef @ np.array(own + [market[symbol, g.ts[i]][c] for c in features.GAP_MARKET.values()])
            out[symbol, i] = np.cumsum(step)
    return out


def test_bands_come_from_the_sources_own_earlier_closes(spark, tables):
    bars, returns, f = tables
    got = predict.outlooks(f, bars, returns, LAST, CONTEXT).cache()
    pf, training = f.toPandas(), gap_model.training_rows(f, returns).toPandas()
    # what was known a minute before the next bar, by the shape of the bars up to each origin
    market = {}
    for o in got.where("horizon = 1").select(*SRC, "ts").collect():
        seen = bars.where((F.col("symbol") == o.symbol) & (F.col("ts") <= o.ts))
        at = seen.groupBy(*SRC).agg(F.max("ts").alias("origin")).join(calendar.session_shape(seen), SRC)
        cut = calendar.next_bars(at, 1, [*SRC, "origin"]).first().ts - dt.timedelta(minutes=1)
        market[o.symbol, o.ts] = {c: returns.where((F.col("series_name") == s) & (F.col("known_at") <= F.lit(cut))).agg(F.max_by("day_return", "trade_date")).first()[0] or 0.0 for s, c in features.GAP_MARKET.items()}
    want = brute(pf, training, market, LAST)
    paths = {k: g.sort_values("horizon") for k, g in got.toPandas().groupby(["symbol", "i"])}
    assert set(paths) == set(want) and len([k for k in want if k[0] == "quiet"]) == LAST + 1
    for k, g in paths.items():
        assert np.allclose(g.origin_log_return, want[k], atol=1e-12)

    bands = {(r.symbol, r.horizon): (r.bias, r.q10, r.q90) for r in forecast.rolling_bands(got.where("i < n - 1")).collect()}
    assert set(bands) == {(s, h) for s in ("quiet", "lively", "short") for h in range(1, 25)}
    for (symbol, h), band in bands.items():
        g = pf[pf.symbol == symbol].sort_values("i")
        close = g.close.to_numpy()
        e = [r[h - 1] - np.log(close[i + h] / close[i]) for (s, i), r in want.items() if s == symbol and i < len(close) - 1 and i + h < len(close)]
        expect = (np.mean(e), np.mean(e) - np.quantile(e, 0.9), np.mean(e) - np.quantile(e, 0.1)) if e else (0.0, 0.0, 0.0)
        assert np.allclose(band, expect, atol=1e-12)
    assert bands["short", 24] == (0.0, 0.0, 0.0) and bands["short", 1][0] != 0.0
    width = lambda s: np.mean([bands[s, h][2] - bands[s, h][1] for h in range(1, 6)])
    assert width("lively") > 5 * width("quiet")


def test_predictions_are_calibrated_by_source(spark, tables, monkeypatch):
    bars, returns, f = tables
    monkeypatch.setattr(model_queries, "settled_features", lambda *_: f)
    monkeypatch.setattr(model_queries, "bars", lambda *_: bars)
    monkeypatch.setattr(model_queries, "table", lambda *_: returns)
    plain, bands = model_queries.rolling(spark, "", CONTEXT)
    b = {(r.symbol, r.horizon): r for r in bands.collect()}
    raw = {(r.symbol, r.horizon): r for r in plain.collect()}
    got = model_queries.directions(spark, "", CONTEXT).collect()
    assert len(got) == 72
    for r in got:
        k = (r.symbol, r.horizon)
        corr = raw[k].origin_log_return - b[k].bias
        assert np.allclose((r.predicted_price, r.price_q10, r.price_q90), raw[k].origin_price * np.exp([corr, corr + b[k].q10, corr + b[k].q90]), rtol=1e-12)


def test_registered_origins_have_the_whole_context(spark, monkeypatch):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", 1, t + dt.timedelta(hours=i), i, 520, float(i in (300, 510, 511, 515, 519)), 1.0) for i in range(520)]
    f = spark.createDataFrame(rows, "symbol string, feed_id long, ts timestamp, i long, n long, is_session_close double, close double")
    monkeypatch.setattr(model_queries, "feature_frame", lambda *_: f)
    assert sorted(r.i for r in model_queries.origins(spark, "").collect()) == [511, 515]


def test_cutoff_moves_the_origin_and_what_may_be_known(spark, tables):
    bars, returns, f = tables
    full = predict.outlooks(f, bars, returns, LAST, CONTEXT)
    one = full.where("NOT main AND symbol = 'quiet'").agg(F.max("ts")).first()[0]
    cut = (one + dt.timedelta(minutes=1)).isoformat() + "+00:00"
    got = predict.outlooks(f, bars, returns, LAST, CONTEXT, cutoff=cut, missing="skip").where("symbol = 'quiet'")
    main = {r.horizon: r for r in got.where("main").collect()}
    then = {r.horizon: r for r in full.where(F.col("ts") == F.lit(one)).where("symbol = 'quiet'").collect()}
    assert {h: (r.ts, r.origin_log_return, r.actual_price) for h, r in main.items()} == {h: (r.ts, r.origin_log_return, r.actual_price) for h, r in then.items()}
    # the closes are those of the whole history before the origin, so fewer than LAST are left
    assert got.where("NOT main").select("i").distinct().count() == full.where("NOT main AND symbol = 'quiet'").select("i").distinct().count() - 1
    with pytest.raises(Exception, match="no bars before"):
        predict.outlooks(f, bars, returns, LAST, CONTEXT, cutoff="2001-01-01").collect()


def test_predict_direction_of_a_price_list(spark):
    r = np.random.default_rng(3)
    prices = list(100 * np.exp(np.cumsum(r.normal(0.0004, 0.001, 120))))
    got = api.predict_direction(spark, prices, calibrate=True, context=60, end=dt.datetime(2024, 6, 28, 16))
    assert got.signal in ("BUY", "SELL", "HOLD") and len(got.directions) == len(got.scores) == 24 and got.origin_price == prices[-1]
    assert got.scores[1] == pytest.approx(np.mean(np.diff(np.log(prices))[-60:]))
    assert got.score == pytest.approx(np.clip(got.path_return / 0.005, -1, 1)) and got.origin_time == dt.datetime(2024, 6, 28, 15, 15)
    signal, steps = got.to_records(" abc ", dt.datetime(2024, 7, 1))
    assert signal["symbol"] == "ABC" and signal["signal"] == got.signal and [s["horizon"] for s in steps] == list(range(1, 25))
    plain = api.predict_direction(spark, prices, timestamps=[dt.datetime(2024, 1, 1) + dt.timedelta(hours=i) for i in range(120)], cutoff="2024-01-05T00:00:00+00:00", context=60)
    assert plain.origin_price == prices[95] and plain.gap is None  # no session ends there
    for bad in ({"prices": []}, {"prices": [1.0, float("nan")]}, {"prices": [1.0, 0.0]}, {"prices": [1.0, 2.0], "volumes": [1.0]}, {"prices": [1.0, 2.0], "timestamps": ["2024-01-01", "2024-01-01"]}):
        with pytest.raises(ValueError):
            api.predict_direction(spark, **bad)
    with pytest.raises(ValueError, match="bars"):
        api.predict_direction(spark, prices)
