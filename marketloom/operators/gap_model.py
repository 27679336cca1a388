"""Overnight gap: a standardised ridge whose penalty is chosen by exact leave-one-out error."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.market import finite_or_zero
from marketloom.operators.features import GAP_COLUMNS, GAP_MARKET, GAP_OWN
from marketloom.operators.known_at import attach, timeline, validity_intervals
from marketloom.operators.series import SOURCE, in_time

ALPHAS = np.logspace(-4, 3, 16)
LEAST_ROWS = 40


def fit_ridge(x: np.ndarray, y: np.ndarray, alphas: np.ndarray = ALPHAS) -> tuple[np.ndarray, float, float]:
    """(coefficients on the raw columns, intercept, penalty). The intercept isn't penalised; constant columns count for nothing.

    With the SVD of the standardised columns, every penalty's fit and leverages are diagonal, so
    leave-one-out errors need no refit.
    """
    mean, std = x.mean(0), x.std(0)
    std = np.where(std > 0, std, 1.0)
    u, s, vt = np.linalg.svd((x - mean) / std, full_matrices=False)
    my = y.mean()
    uy = u.T @ (y - my)
    best = (np.inf, alphas[0])
    for a in alphas:
        d = s**2 / (s**2 + a)
        fit = my + u @ (d * uy)
        leverage = 1.0 / len(y) + (u**2) @ d
        error = np.mean(((y - fit) / (1.0 - leverage)) ** 2)
        if error < best[0]:
            best = (error, a)
    a = best[1]
    coef = (vt.T @ (s / (s**2 + a) * uy)) / std
    return coef, float(my - mean @ coef), float(a)


def with_market(rows: DataFrame, at: str, returns: DataFrame, known: bool = True, series: dict[str, str] = GAP_MARKET) -> DataFrame:
    """rows with the market returns as of ``at``, by default all five; 0 where nothing was there.

    ``known`` uses what had been published by then; otherwise a day's value counts from that day's midnight.
    """
    versions = returns if known else returns.withColumn("known_at", F.col("trade_date").cast("timestamp"))
    intervals = validity_intervals(versions.where(F.col("series_name").isin(*series)), ["series_name"], "known_at", ["trade_date", "known_at", "obs_id", "day_return"], "day_return")
    names = {s: f"_as_known_{s}" for s in series}
    line = timeline(intervals, "series_name", list(series)).withColumnsRenamed(names)
    got = attach(rows, at, line, list(names.values()))
    return got.select(*rows.columns, *(F.coalesce(F.col(names[s])["day_return"], F.lit(0.0)).alias(c) for s, c in series.items()))


def training_rows(features: DataFrame, returns: DataFrame, source: list[str] = SOURCE, before_open: bool = True) -> DataFrame:
    """(source..., ts, target, gap columns): each session open with what was known at the close before it."""
    w = in_time(source)
    lagged = [F.lag(c).over(w).alias(c) for c in GAP_OWN]
    rows = features.select(*source, "ts", "is_session_open", F.col("open").alias("_o"), F.lag("close").over(w).alias("_pc"), F.lag("ts").over(w).alias("_pts"), *lagged)
    rows = rows.where((F.col("is_session_open") > 0.5) & (F.col("_pc") > 0) & (F.col("_o") > 0))
    rows = rows.withColumn("target", F.ln(F.col("_o") / F.col("_pc"))).withColumn("_cut", F.col("ts") - F.expr("INTERVAL 1 MINUTE") if before_open else F.col("_pts"))
    rows = with_market(rows, "_cut", returns)
    return rows.select(*source, "ts", "target", *(finite_or_zero(F.col(c)).alias(c) for c in GAP_COLUMNS))


def fit(training: DataFrame, source: list[str] = SOURCE) -> DataFrame:
    """(source..., n, alpha, intercept, coefficients): sources with fewer than 40 rows have no model.

    A group is one source's session opens: a few hundred rows a year.
    """

    schema = T.StructType([*(training.schema[c] for c in source), *T._parse_datatype_string("n long, alpha double, intercept double, coefficients array<double>").fields])

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("ts")
        n = t.num_rows
        head = t.select(source).slice(0, 1 if n >= LEAST_ROWS else 0)
        rows = []
        if n >= LEAST_ROWS:
            x = np.column_stack([t.column(c).to_numpy() for c in GAP_COLUMNS]).astype(float)
            coef, icept, alpha = fit_ridge(x, t.column("target").to_numpy().astype(float))
            rows = [(n, alpha, icept, coef.tolist())]
        cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64())))]
        return pa.Table.from_arrays([*head.columns, *cols], names=schema.names)

    return training.groupBy(*source).applyInArrow(run, schema)


def fit_at(training: DataFrame, origins: DataFrame, source: list[str] = SOURCE) -> DataFrame:
    """(source..., ts, n, alpha, intercept, coefficients): the model of each origin (source..., ts) from the rows before it.

    Origins with fewer than 40 rows before them have no model.
    """

    schema = T.StructType([*(origins.schema[c] for c in (*source, "ts")), *T._parse_datatype_string("n long, alpha double, intercept double, coefficients array<double>").fields])

    def run(t: pa.Table, o: pa.Table) -> pa.Table:
        t = t.sort_by("ts")
        x = np.column_stack([t.column(c).to_numpy() for c in GAP_COLUMNS]).astype(float)
        y = t.column("target").to_numpy().astype(float)
        before = np.searchsorted(t.column("ts").to_numpy(), o.column("_ts").to_numpy())
        at = np.flatnonzero(before >= LEAST_ROWS)
        rows = []
        for n in before[at]:
            coef, icept, alpha = fit_ridge(x[:n], y[:n])
            rows.append((int(n), alpha, icept, coef.tolist()))
        cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64())))]
        return pa.Table.from_arrays([*o.take(pa.array(at, pa.int64())).columns, *cols], names=schema.names)

    o = origins.select(*(F.col(c).alias(f"_{c}") for c in (*source, "ts")))
    return training.groupBy(*source).cogroup(o.groupBy(*(f"_{c}" for c in source))).applyInArrow(run, schema)


def predict(rows: DataFrame, models: DataFrame, source: list[str] = SOURCE) -> DataFrame:
    """rows with gap_hat; 0 without a model."""
    x = F.array(*(finite_or_zero(F.col(c)) for c in GAP_COLUMNS))
    dot = F.aggregate(F.zip_with(x, F.col("coefficients"), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    joined = rows.join(models.select(*source, "intercept", "coefficients"), source, "left")
    return joined.withColumn("gap_hat", finite_or_zero(F.col("intercept") + dot)).drop("intercept", "coefficients")
