"""Per-source time-series columns; a source's bars are ordered by time, rows are whole windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketloom.functions.market import exchange_date, finite
from marketloom.operators.dedupe import keep_last

SOURCE = ["symbol", "feed_id"]


def clean_bars(prices: DataFrame, order: tuple[str, ...] = ("ingested_at", "load_seq"), carry: list[str] | None = None) -> DataFrame:
    """(symbol, feed_id, ts, open, close, volume): sound bars, the last loaded of each instant."""
    ok = (finite(F.col("close")) > 0) & (finite(F.col("open")) > 0) & (finite(F.col("volume")) >= 0)
    rows = prices.where(ok & F.col("timestamp").isNotNull()).withColumnRenamed("timestamp", "ts")
    return keep_last(rows, [*SOURCE, "ts"], list(order)).select(*SOURCE, "ts", "open", "close", "volume", *(carry or []))


def in_time(source: list[str] = SOURCE, ts: str = "ts") -> WindowSpec:
    return Window.partitionBy(*source).orderBy(ts)


def log_return(price: Column, w: WindowSpec, lag: int = 1) -> Column:
    return F.ln(price) - F.lag(F.ln(price), lag).over(w)


def _sessions(bars: DataFrame, source: list[str]) -> DataFrame:
    """bars with the columns of ``session_gaps``.

    A session is a source's bars of one exchange day, and everything that comes from earlier bars
    comes from earlier sessions' first and last bars. So bars are ordered within their day only,
    and what runs over a source is one row per day.
    """
    days = [*source, "day"]
    d = bars.withColumn("day", exchange_date(F.col("ts")))
    ends = d.groupBy(*days).agg(F.max("ts").alias("_last"), F.max_by("close", "ts").alias("_close"), F.ln(F.min_by("open", "ts")).alias("_open"))
    w = Window.partitionBy(*source).orderBy("day")
    ends = ends.select(*days, F.lag("_last").over(w).alias("_at"), F.lag("_close").over(w).alias("_pc"), "_open", "_close")
    ends = ends.withColumn("_gap", F.col("_open") - F.ln("_pc")).withColumn("_dr", F.ln(F.try_divide("_close", "_pc")))
    ends = ends.select(*days, "_at", "_gap", before(F.nullif(F.col("_gap"), F.lit(0.0)), w).alias("_gap_before"), before(F.col("_dr"), w).alias("prev_day_return"))
    inside = Window.partitionBy(*days).orderBy("ts")
    marked = d.select("*", F.lag("ts").over(inside).alias("_prev"), F.lead("ts").over(inside).isNull().alias("is_close"))
    on = [F.col(f"m.{c}").eqNullSafe(F.col(f"e.{c}")) for c in days]
    is_open = F.col("_prev").isNull()
    hours = F.coalesce((F.unix_micros("ts") - F.unix_micros(F.coalesce("_prev", "_at"))) / 3.6e9, F.lit(1.0))
    rows = marked.alias("m").join(ends.alias("e"), on).select("m.*", "_at", "_gap", "_gap_before", "prev_day_return").withColumns({"is_open": is_open, "hours_since": hours})
    own = F.nullif(F.col("_gap"), F.lit(0.0))
    return rows.select(
        *bars.columns,
        "day",
        "is_open",
        "is_close",
        "hours_since",
        F.when(F.col("is_open"), F.col("_gap")).otherwise(F.lit(0.0)).alias("gap"),
        F.when(F.col("is_open"), F.col("_gap_before")).otherwise(F.coalesce(own, "_gap_before")).alias("last_gap"),
        "prev_day_return",
        ((F.col("hours_since") >= 40) & F.col("is_open")).cast("double").alias("is_weekend_gap"),
    )


def session_masks(bars: DataFrame, source: list[str] = SOURCE) -> DataFrame:
    """bars with day, is_open, is_close and hours_since; the last bar always closes a session."""
    return _sessions(bars, source).select(*bars.columns, "day", "is_open", "is_close", "hours_since")


def session_gaps(bars: DataFrame, source: list[str] = SOURCE) -> DataFrame:
    """bars with the masks, and gap (0 inside a session), last_gap, prev_day_return and is_weekend_gap.

    A gap of exactly zero counts as missing, so the gap before it carries on.
    """
    return _sessions(bars, source)


def before(x: Column, w: WindowSpec) -> Column:
    """The last non-null value strictly before the row."""
    return F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))


def bars_per_day(bars: DataFrame, source: list[str] = SOURCE) -> DataFrame:
    """(source..., bars): the median count of a source's bars per exchange day, halves to even, at least 1."""
    per_day = bars.groupBy(*source, exchange_date(F.col("ts")).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    return per_day.groupBy(*source).agg(F.greatest(F.lit(1), F.bround(F.median("_n"))).cast("int").alias("bars"))


def rsi(avg_gain: Column, avg_loss: Column) -> Column:
    """Relative strength scaled to -1..1; null where there were no losses."""
    rs = F.try_divide(avg_gain, F.nullif(avg_loss, F.lit(0.0)))
    return (100.0 - 100.0 / (1.0 + rs) - 50.0) / 50.0
