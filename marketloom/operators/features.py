"""The feature frame of every source in one plan: session columns on the JVM side, trailing windows and recursions chunk by chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.market import finite
from marketloom.operators import chunks, series
from marketloom.session import written

CONTEXT, HORIZON, ORIGINS = 512, 24, 30
# The names of the feature columns and of the gap model's inputs.
#: Columns whose missing values are 0; the others stay null.
MODEL_COLUMNS = ["log_return", "log_volume_norm", "rsi_14d", "macd_hist", "ret_5d", "vol_5d", "hours_since_prev", "nifty_log_return"]
GAP_OWN = ["prev_day_return", "ret_5d", "ret_20d", "vol_5d", "vol_20d", "volume_change", "last_gap", "is_weekend_gap"]
GAP_MARKET = {"nifty": "nifty_day_return", "nifty_it": "nifty_it_day_return", "usdinr": "usdinr_day_return", "nasdaq": "nasdaq_overnight_return", "adr": "adr_overnight_return"}
GAP_COLUMNS = GAP_OWN + list(GAP_MARKET.values())
EXTRA = ["open", "close", "is_session_open", "is_session_close", "prev_day_return", "ret_20d", "vol_20d", "volume_change", "last_gap", "is_weekend_gap"]


def build(bars: DataFrame, nifty: DataFrame | None = None, source: list[str] = series.SOURCE) -> DataFrame:
    """(source..., ts, i, n, features...): i counts a source's bars from 0, n is their number.

    ``nifty`` is (source..., ts, nifty_log_return), as joined as-of beforehand; bars may also carry
    the column. Without either it is 0. The first bar stays, with a return of 0.
    """
    if nifty is not None:
        bars = bars.join(nifty, [*source, "ts"], "left")
    elif "nifty_log_return" not in bars.columns:
        bars = bars.withColumn("nifty_log_return", F.lit(0.0))
    bars = written(bars.select(*source, "ts", "open", "close", "volume", "nifty_log_return"), "bars")  # read several times
    sized = series.session_gaps(bars, source).join(series.bars_per_day(bars, source), source).withColumn("rsi_length", F.col("bars") * 14)
    keep = [*source, "ts", "bars", "rsi_length", "open", "close", "volume", "is_open", "is_close", "prev_day_return", "last_gap", "is_weekend_gap", "hours_since", "nifty_log_return"]
    means = chunks.exponential_means(chunks.ranked(written(sized.select(*keep), "sessions"), source), source, settle=written)
    x = chunks.sized_windows(means, source, zscores=("macd_hist",))
    out = x.select(
        *source,
        "ts",
        "i",
        "n",
        "open",
        "close",
        F.col("is_open").cast("double").alias("is_session_open"),
        F.col("is_close").cast("double").alias("is_session_close"),
        "prev_day_return",
        "ret_20d",
        "vol_20d",
        "volume_change",
        "last_gap",
        "is_weekend_gap",
        "log_return",
        "log_volume_norm",
        series.rsi(F.col("avg_gain"), F.col("avg_loss")).alias("rsi_14d"),
        "macd_hist",
        "ret_5d",
        "vol_5d",
        F.log1p(F.greatest("hours_since", F.lit(0.0))).alias("hours_since_prev"),
        "nifty_log_return",
    )
    fixed = {c: finite(F.col(c)) for c in [*EXTRA, *MODEL_COLUMNS]}
    return out.withColumns(fixed).fillna(0.0, subset=MODEL_COLUMNS)


def require_length(features: DataFrame, context: int = CONTEXT, source: list[str] = series.SOURCE) -> DataFrame:
    """features themselves; the query fails for a source with fewer bars than the context."""
    short = F.raise_error(F.concat(F.lit(f"fewer than {context} bars: "), F.concat_ws("/", *(F.col(c).cast("string") for c in source)))).cast("boolean")
    return features.where(F.when(F.col("n") < context, short).otherwise(F.lit(True)))


def close_origins(features: DataFrame, last: int = 30, context: int = CONTEXT, source: list[str] = series.SOURCE) -> DataFrame:
    """The last origins at session closes that have a full context before and a bar after them."""
    ok = features.where((F.col("is_session_close") > 0.5) & (F.col("i") + 1 >= context) & (F.col("i") + 1 < F.col("n")))
    rn = F.row_number().over(Window.partitionBy(*source).orderBy(F.desc("i")))
    return ok.withColumn("_rn", rn).where(F.col("_rn") <= last).drop("_rn")
