"""Outlooks of all sources at once: paths from an origin, calibrated on each source's own earlier closes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.market import signed_strength
from marketloom.operators import calendar, features, forecast, gap_model, series
from marketloom.session import written

SRC = series.SOURCE
KEY = [*SRC, "ts"]


def origins_before(f: DataFrame, cutoff: str | None, missing: str = "error") -> DataFrame:
    """(source..., origin_i): each source's last bar, or the last one strictly before ``cutoff``.

    A source without any is an error, or left out with ``missing='skip'``.
    """
    if cutoff is None:
        return f.groupBy(*SRC).agg(F.max("i").alias("origin_i"))
    cut = calendar.as_instant(F.lit(cutoff))
    got = f.groupBy(*SRC).agg(F.max(F.when(F.col("ts") < cut, F.col("i"))).alias("origin_i"))
    if missing == "skip":
        return got.where("origin_i IS NOT NULL")
    none = F.raise_error(F.concat(F.lit(f"no bars before {cutoff}: "), F.concat_ws("/", *(F.col(c).cast("string") for c in SRC)))).cast("bigint")
    return got.withColumn("origin_i", F.coalesce("origin_i", none))


def outlooks(f: DataFrame, b: DataFrame, returns: DataFrame, last: int = features.ORIGINS, context: int = features.CONTEXT, forecaster: forecast.Forecaster = forecast.drift, cutoff: str | None = None, missing: str = "error") -> DataFrame:
    """Paths (source..., ts, i, n, main, horizon, ...) with actual prices from each source's origin (main) and from session closes before it.

    The closes are those of the ``last`` closes of the whole history that lie before the origin.
    Every origin has the gap model and the session of what came before it only.
    """
    at = origins_before(f, cutoff, missing)
    full = f.join(at, SRC).where((F.col("i") == F.col("origin_i")) & (F.col("i") + 1 >= context)).withColumn("main", F.lit(True))
    o = full
    if last:
        closes = features.close_origins(f, last, context).join(at, SRC).where(F.col("i") < F.col("origin_i"))
        o = full.unionByName(closes.withColumn("main", F.lit(False)))
    o = written(o.select(*KEY, "i", "n", "main", F.col("close").alias("origin_price"), "is_session_close", *features.GAP_OWN), "origins")
    marked = f.join(o.select(*KEY, F.lit(True).alias("_at")), KEY, "left").fillna(False, subset=["_at"])
    p = forecast.steps(forecast.sliding(marked, forecaster, context, origins="_at"), KEY)
    ahead = calendar.next_bars(o.select(*KEY, F.col("ts").alias("origin")).join(calendar.session_shape_at(b, o), KEY).drop("ts"), 1, [*SRC, "origin"])
    cut = ahead.select(*SRC, F.col("origin").alias("_o"), calendar.information_cutoff(F.col("ts"), F.col("origin")).alias("_cut")).withColumnRenamed("_o", "ts")
    models = gap_model.fit_at(gap_model.training_rows(f, returns), o)
    gaps = gap_model.predict(gap_model.with_market(o.join(cut, KEY), "_cut", returns), models, KEY)
    gaps = gaps.select(*KEY, "i", "n", "main", "origin_price", F.when(F.col("is_session_close") > 0.5, F.col("gap_hat")).alias("gap"))
    p = forecast.reconstruct(forecast.with_gap(p.join(gaps, KEY), "gap"), KEY)
    came = f.select(*SRC, F.col("i").alias("_i"), F.col("close").alias("actual_price"))
    return p.withColumn("_i", F.col("i") + F.col("horizon")).join(came, [*SRC, "_i"], "left").drop("_i")


def rolling(f: DataFrame, b: DataFrame, returns: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """(the paths from each source's origin, the bands of its own earlier session closes)."""
    p = written(outlooks(f, b, returns, **how), "outlooks")
    return p.where("main").drop("actual_price", "main"), forecast.rolling_bands(p.where("NOT main"))


def stamped(paths: DataFrame, b: DataFrame) -> DataFrame:
    """paths (source..., origin, horizon) with the expected stamps of their steps, by the session up to the origin."""
    first = paths.where("horizon = 1").select(*SRC, "origin", F.col("origin").alias("ts"))
    shape = calendar.session_shape_at(b, first.select(*KEY))
    future = calendar.next_bars(first.join(shape, KEY).drop("ts"), features.HORIZON, [*SRC, "origin"])
    return paths.join(future.select(*SRC, "horizon", "ts"), [*SRC, "horizon"])


def signal_rows(paths: DataFrame) -> DataFrame:
    """One row per path: signal, direction, score, confidence, path_return, gap and where it starts."""
    s = forecast.signals(paths.drop("actual_price"), SRC)
    o = paths.where("horizon = 1").select(*SRC, "origin", "origin_price", "gap")
    score = signed_strength(F.col("path_return"), forecast.PATH_THRESHOLD)
    return s.join(o, SRC).select(*SRC, F.col("origin").alias("origin_time"), "signal", "direction", score.alias("score"), "confidence", "path_return", "gap", "origin_price")


def step_rows(paths: DataFrame) -> DataFrame:
    """One row per step, horizon from 1: direction, score and strength of the uncalibrated step."""
    s = forecast.step_signals(paths)
    return s.select(*SRC, F.col("origin").alias("origin_time"), "horizon", "ts", F.col("step_signal").alias("direction"), F.col("step_score").alias("score"), F.col("step_strength").alias("strength"))


def predictions(b: DataFrame, returns: DataFrame, f: DataFrame | None = None, cutoff: str | None = None, calibrate: bool = False, context: int = features.CONTEXT, forecaster: forecast.Forecaster = forecast.drift, missing: str = "error") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signal rows, step rows, paths) of all sources of bars (symbol, feed_id, ts, open, close, volume).

    With ``calibrate`` each source's path is shifted and banded by its own earlier closes.
    """
    if f is None:
        f = written(features.build(gap_model.with_market(b, "ts", returns, known=False, series={"nifty": "nifty_log_return"})), "features")
    if calibrate:
        p, bands = rolling(f, b, returns, context=context, forecaster=forecaster, cutoff=cutoff, missing=missing)
        p = forecast.apply_calibration(p.withColumnRenamed("ts", "origin"), bands, SRC)
    else:
        p = outlooks(f, b, returns, 0, context, forecaster, cutoff, missing).drop("main").withColumnRenamed("ts", "origin")
    p = stamped(written(p, "paths"), b)
    return signal_rows(p), step_rows(p), p
