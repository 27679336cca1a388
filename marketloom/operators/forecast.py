"""Forecast paths: a pluggable forecaster, path algebra, calibration and signals.

A path is (keys..., horizon 1.., predicted_log_return); all else is column algebra on it. The
pretrained network of the original isn't available here: the default forecaster is a plain
drift, deterministic and clearly not that model; anything of the same signature can take its place.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.market import finite, finite_or_zero, label, signed_strength, stance
from marketloom.operators import chunks
from marketloom.operators.features import CONTEXT, HORIZON, MODEL_COLUMNS
from marketloom.operators.series import SOURCE

PATH_THRESHOLD, STEP_THRESHOLD = 0.005, 0.0015
#: (windows x context x features) to (windows x horizon) of incremental log returns.
Forecaster = Callable[[np.ndarray], np.ndarray]


def drift(windows: np.ndarray, horizon: int = HORIZON, reach: int = 120) -> np.ndarray:
    """The mean of the latest returns, repeated."""
    return np.repeat(windows[:, -reach:, 0].mean(1)[:, None], horizon, 1)


def sliding(features: DataFrame, forecaster: Forecaster = drift, context: int = CONTEXT, origins: str = "all", source: list[str] = SOURCE, batch: int = 256, chunk: int = chunks.CHUNK) -> DataFrame:
    """(source..., ts, returns): the forecast at every bar with a full context of features (with i and n).

    ``origins='last'`` takes the latest only; another name is that of a boolean column of the bars to forecast at.
    Bars go in chunks with the context before them, so a source is many tasks.
    """
    at = F.lit(True) if origins == "all" else F.col("i") == F.col("n") - 1 if origins == "last" else F.coalesce(F.col(origins), F.lit(False))
    rows = features.select(*source, "ts", "i", "n", *MODEL_COLUMNS, (at & (F.col("i") + 1 >= context)).alias("_at"))
    schema = T.StructType([*(features.schema[c] for c in (*source, "ts")), T.StructField("returns", T.ArrayType(T.DoubleType()))])

    def work(t: pa.Table) -> pa.Table:
        home = t.column("i").to_numpy() // chunk == t.column("chunk").to_numpy()
        asked = np.flatnonzero(t.column("_at").to_numpy().astype(bool) & home)
        out = np.zeros((0, 1))
        if len(asked):
            x = np.column_stack([t.column(c).to_numpy() for c in MODEL_COLUMNS]).astype(float)
            windows = np.lib.stride_tricks.sliding_window_view(x, context, axis=0).transpose(0, 2, 1)
            out = np.concatenate([forecaster(windows[asked[i : i + batch] - context + 1]) for i in range(0, len(asked), batch)])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))
        return pa.Table.from_arrays([*t.select([*source, "ts"]).take(pa.array(asked, pa.int64())).columns, lists], names=schema.names)

    return chunks.map_chunks(chunks.chunked(rows, F.lit(context - 1), chunk), source, work, schema)


def steps(forecasts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per horizon, from 1."""
    return forecasts.select(*keys, F.posexplode("returns").alias("p", "predicted_log_return")).select(*keys, (F.col("p") + 1).alias("horizon"), "predicted_log_return")


def with_gap(paths: DataFrame, gap: str) -> DataFrame:
    """The first step replaced by the overnight gap where there is one."""
    return paths.withColumn("predicted_log_return", F.when((F.col("horizon") == 1) & finite(F.col(gap)).isNotNull(), F.col(gap)).otherwise(F.col("predicted_log_return")))


def reconstruct(paths: DataFrame, keys: list[str], origin_price: str = "origin_price") -> DataFrame:
    """Adds origin_log_return (running sum) and predicted_price."""
    w = Window.partitionBy(*keys).orderBy("horizon").rowsBetween(Window.unboundedPreceding, 0)
    r = paths.withColumn("origin_log_return", F.sum("predicted_log_return").over(w))
    return r.withColumn("predicted_price", F.col(origin_price) * F.exp("origin_log_return"))


def prepend_origin(paths: DataFrame, keys: list[str]) -> DataFrame:
    """A row at horizon 0 with the origin itself."""
    first = paths.where("horizon = 1")
    zero = {"predicted_log_return": F.lit(0.0), "origin_log_return": F.lit(0.0), "horizon": F.lit(0).cast(paths.schema["horizon"].dataType)}
    price = {c: F.col("origin_price") for c in ("predicted_price", "actual_price", "price_q10", "price_q90") if c in paths.columns}
    return paths.unionByName(first.withColumns(zero | price).select(*paths.columns))


def attach_actuals(paths: DataFrame, bars: DataFrame, source: list[str] = SOURCE) -> DataFrame:
    """paths (source..., i, horizon) with ts and actual_price of the bar ``horizon`` places after the origin's; bars have their place i."""
    came = bars.select(*source, F.col("i").alias("_i"), "ts", F.col("close").alias("actual_price"))
    return paths.drop("ts", "actual_price").withColumn("_i", F.col("i") + F.col("horizon")).join(came, [*source, "_i"], "left").drop("_i")


def write_csv(paths: DataFrame, where: str, order: list[str]) -> DataFrame:
    """paths as headed CSV in a new folder, in order; the same rows read back."""
    paths.orderBy(*order).write.option("header", True).csv(where)
    return paths.sparkSession.read.schema(paths.schema).option("header", True).csv(where)


def plot(path, where: str) -> bool:
    """Draws one path (a small pandas frame with horizon, predicted_price and maybe a band and actual prices); False without matplotlib."""
    try:
        from matplotlib.figure import Figure
    except ImportError:
        return False
    fig = Figure(figsize=(9, 6))
    top, low = fig.subplots(2, 1, sharex=True)
    p = path.sort_values("horizon")
    for c in ("predicted_price", "actual_price"):
        if c in p:
            top.plot(p["horizon"], p[c], label=c)
    if {"price_q10", "price_q90"} <= set(p):
        top.fill_between(p["horizon"], p["price_q10"], p["price_q90"], alpha=0.2)
    top.legend()
    low.bar(p["horizon"], p["predicted_log_return"])
    fig.savefig(where)
    return True


def residuals(paths: DataFrame) -> DataFrame:
    """Rows with an actual price: return_residual and price_residual."""
    ok = (finite(F.col("actual_price")) > 0) & finite(F.col("predicted_price")).isNotNull() & (F.col("origin_price") > 0)
    return paths.where(ok).withColumn("return_residual", F.ln(F.col("predicted_price") / F.col("origin_price")) - F.ln(F.col("actual_price") / F.col("origin_price"))).withColumn("price_residual", F.col("predicted_price") - F.col("actual_price"))


def calibrate(resid: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., horizon, bias, q10, q90): mean residual and the conformal band around it."""
    g = resid.groupBy(*keys, "horizon").agg(F.avg("return_residual").alias("bias"), F.percentile("return_residual", 0.9).alias("_hi"), F.percentile("return_residual", 0.1).alias("_lo"))
    return g.select(*keys, "horizon", "bias", (F.col("bias") - F.col("_hi")).alias("q10"), (F.col("bias") - F.col("_lo")).alias("q90"))


def rolling_bands(paths: DataFrame, source: list[str] = SOURCE) -> DataFrame:
    """The bands of each source from its own earlier paths; where a source has residuals, a horizon without any has zeros."""
    bands = calibrate(residuals(paths), source)
    every = bands.select(*source).distinct().withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(HORIZON))))
    return every.join(bands, [*source, "horizon"], "left").fillna(0.0, subset=["bias", "q10", "q90"])


def apply_calibration(paths: DataFrame, bands: DataFrame, keys: list[str]) -> DataFrame:
    """Shifts running returns and prices by the bias and adds the price band; the steps themselves stay."""
    j = paths.join(bands, [*keys, "horizon"], "left")
    corr = F.col("origin_log_return") - F.coalesce("bias", F.lit(0.0))
    price = lambda q=None: F.col("origin_price") * F.exp(corr if q is None else corr + F.col(q))
    return j.select(*(c for c in paths.columns if c not in ("origin_log_return", "predicted_price")), corr.alias("origin_log_return"), price().alias("predicted_price"), price("q10").alias("price_q10"), price("q90").alias("price_q90"))


def _shape(paths: DataFrame, keys: list[str], price: str, name: str) -> DataFrame:
    """Log-price change, slope and step counts of a path; the origin itself is no part of it."""
    w = Window.partitionBy(*keys).orderBy("horizon")
    p = paths.where(finite(F.col(price)) > 0).withColumn("_l", F.ln(price))
    p = p.withColumn("_s", F.col("_l") - F.lag("_l").over(w)).withColumn("_i", F.row_number().over(w) - 1)
    return p.groupBy(*keys).agg(
        (F.max_by("_l", "_i") - F.min_by("_l", "_i")).alias(f"{name}path_return"),
        F.coalesce(F.regr_slope("_l", "_i"), F.lit(0.0)).alias(f"{name}slope"),
        F.coalesce(F.avg("_s"), F.lit(0.0)).alias(f"{name}mean_step"),
        F.count_if(F.col("_s") > STEP_THRESHOLD).alias(f"{name}up_steps"),
        F.count_if(F.col("_s") < -STEP_THRESHOLD).alias(f"{name}down_steps"),
        F.count("_s").alias(f"{name}n_steps"),
        F.count_if(F.col("_s") > 0).alias(f"{name}_rises"),
        F.count_if(F.col("_s") < 0).alias(f"{name}_falls"),
        F.count(F.lit(1)).alias(f"{name}_n"),
    )


def signals(paths: DataFrame, keys: list[str], threshold: float = PATH_THRESHOLD) -> DataFrame:
    """One row per path: signal, direction, shape and confidence; with actual prices also how it came out."""
    s = _shape(paths, keys, "predicted_price", "")
    score, n = F.col("path_return"), F.col("n_steps")
    strength = F.tanh(F.abs(score) / threshold)
    agree = F.when(score > 0, F.col("_rises")).otherwise(F.col("_falls")) / n
    out = s.select(
        *keys,
        label(score, threshold).alias("signal"),
        stance(label(score, threshold)).alias("direction"),
        "path_return",
        "slope",
        "mean_step",
        "up_steps",
        "down_steps",
        (n - F.col("up_steps") - F.col("down_steps")).alias("flat_steps"),
        F.when(n == 0, strength).when(score == 0, 1.0 - strength).otherwise(strength * agree).alias("confidence"),
    )
    if "actual_price" not in paths.columns:
        return out
    a = _shape(paths, keys, "actual_price", "actual_").where("actual__n >= 2")
    actual = F.col("actual_path_return")
    came = a.select(*keys, actual, F.col("actual_slope"), label(actual, threshold).alias("actual_signal"))
    return out.join(came, keys, "left").withColumns({
        "direction_match": (F.signum("path_return") == F.signum(actual)) & (F.col("path_return") != 0) & (actual != 0),
        "signal_match": F.col("signal") == F.col("actual_signal"),
    })


def hit_rate(scored: DataFrame) -> DataFrame:
    """One row over the paths that have an outcome."""
    ok = scored.where("actual_signal IS NOT NULL")
    return ok.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("signal_match").cast("double")).alias("signal_accuracy"),
        F.avg(F.col("direction_match").cast("double")).alias("direction_accuracy"),
        *(F.count_if(F.col("signal") == s).alias(f"pred_{s.lower()}") for s in ("BUY", "HOLD", "SELL")),
    )


def step_signals(paths: DataFrame, threshold: float = STEP_THRESHOLD) -> DataFrame:
    r = finite_or_zero(F.col("predicted_log_return"))
    return paths.withColumns({"step_signal": label(r, threshold), "step_score": r, "step_strength": signed_strength(r, threshold)})
