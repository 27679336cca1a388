"""The public call for one price list: the next 24 bars and their direction."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from marketloom.operators import features, forecast, predict
from marketloom.sources.prices import price_frame, session_stamps

NO_RETURNS = "series_name string, trade_date date, known_at timestamp, obs_id long, day_return double"


@dataclass(frozen=True)
class Prediction:
    """A signal for the whole path and one for each of its steps; behaves like the list of step directions."""

    signal: str
    directions: list[str]
    scores: list[float]
    strengths: list[float]
    score: float
    confidence: float
    path_return: float
    origin_price: float
    origin_time: dt.datetime
    gap: float | None
    path: list[Row]

    def __len__(self) -> int:
        return len(self.directions)

    def __getitem__(self, i):
        return self.directions[i]

    def __iter__(self):
        return iter(self.directions)

    def to_records(self, symbol: str, ingested_at: dt.datetime | None = None) -> tuple[dict, list[dict]]:
        """The signal row and the step rows (horizon from 1) as they are stored."""
        base = {"symbol": symbol.strip().upper(), "origin_time": self.origin_time}
        at = {"ingested_at": ingested_at or dt.datetime.now(dt.timezone.utc)}
        signal = base | {c: getattr(self, c) for c in ("origin_price", "signal", "score", "confidence", "path_return", "gap")} | at
        steps = zip(self.directions, self.scores, self.strengths)
        return signal, [base | {"horizon": h, "direction": d, "score": s, "strength": x} | at for h, (d, s, x) in enumerate(steps, 1)]


def predict_direction(
    spark: SparkSession,
    prices: Iterable[float],
    timestamps: Iterable | None = None,
    volumes: Iterable[float] | None = None,
    opens: Iterable[float] | None = None,
    market_returns: DataFrame | None = None,
    cutoff: str | None = None,
    calibrate: bool = False,
    context: int = features.CONTEXT,
    forecaster: forecast.Forecaster = forecast.drift,
    end: dt.datetime | None = None,
) -> Prediction:
    """The outlook of a list of closes, oldest first; at least ``context`` of them.

    Without stamps weekday session hours up to ``end`` (now) are made up. ``cutoff`` forecasts from
    the last bar strictly before it. For many sources at once use ``operators.predict.predictions``.
    """
    closes = list(prices)
    if timestamps is None and end is not None:
        timestamps = session_stamps(len(closes), end)
    b = price_frame(spark, closes, timestamps, volumes, opens)
    if len(closes) < context:
        raise ValueError(f"{len(closes)} bars, {context} are needed")
    returns = market_returns if market_returns is not None else spark.createDataFrame([], NO_RETURNS)
    signals, steps, paths = predict.predictions(b, returns, cutoff=cutoff, calibrate=calibrate, context=context, forecaster=forecaster)
    found = signals.collect()
    if not found:
        raise ValueError(f"fewer than {context} bars before {cutoff}")
    s = found[0]
    each = sorted(steps.collect(), key=lambda r: r["horizon"])
    return Prediction(s["signal"], [r["direction"] for r in each], [r["score"] for r in each], [r["strength"] for r in each], s["score"], s["confidence"], s["path_return"], s["origin_price"], s["origin_time"], s["gap"], sorted(paths.collect(), key=lambda r: r["horizon"]))
