"""Queries of the training-data problems p1 to p6 over a folder of Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators import drift, eav, known_at, rolling, spikes, stamps
from marketloom.session import table, work_dir, written

RETURN_FIELDS = {"nifty": "nifty_day_return", "usdinr": "usdinr_day_return", "nasdaq": "nasdaq_overnight_return"}


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, kinds, renamed = drift.infer(table(spark, sf_dir, "screener_files"))
    return drift.changes(kinds, renamed)


def p1_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.consistent_rows(table(spark, sf_dir, "screener_files"))


def p1_unions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.unions(table(spark, sf_dir, "screener_files"))


def p1_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each field of each file holds each JSON kind: the tagged unions before anything is fused."""
    return drift.kind_counts(table(spark, sf_dir, "screener_files"))


def p2_nav_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every NAV row with its Indian calendar date (null where it is unreadable)."""
    nav = table(spark, sf_dir, "nav_history").select("load_seq", "nav_date")
    return stamps.normalise(nav, "nav_date", "norm", dates=True).select("load_seq", F.col("norm").alias("day"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "hourly_feed").select("load_seq", F.col("timestamp").alias("raw"), "feed_zone")
    nav = table(spark, sf_dir, "nav_history").select("load_seq", F.col("nav_date").alias("raw"))
    bars = stamps.normalise(feed, "raw", "norm", zone_col="feed_zone").select(F.lit("hourly_feed").alias("table_name"), "load_seq", "raw", "norm")
    days = stamps.normalise(nav, "raw", "norm", dates=True).select(F.lit("nav_history").alias("table_name"), "load_seq", "raw", "norm")
    both = bars.unionByName(days)
    return both.where(F.col("norm").isNotNull() & (F.col("raw") != F.col("norm"))).select("table_name", "load_seq", "norm")


def p2_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bar row with its UTC instant (null where the stamp is unreadable)."""
    feed = table(spark, sf_dir, "hourly_feed")
    return stamps.normalise(feed, "timestamp", "utc_us", zone_col="feed_zone", as_text=False).select("load_seq", "symbol", F.timestamp_micros("utc_us").alias("ts"), "open", "close", "volume")


P3_RULES = {("hourly_prices", "close"): spikes.LEVEL, ("hourly_prices", "volume"): spikes.AMOUNT, ("nav_history", "nav"): spikes.LEVEL}


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table(spark, sf_dir, "hourly_prices").select("symbol", "feed_id", "timestamp", "load_seq", "close", "volume")
    nav = stamps.normalise(table(spark, sf_dir, "nav_history").select("scheme_code", "nav_date", "load_seq", "nav"), "nav_date", "day", dates=True, as_text=False)
    of = lambda t: {f: r for (n, f), r in P3_RULES.items() if n == t}
    bars = spikes.readings(prices, "hourly_prices", of("hourly_prices"), ["symbol", "feed_id"], F.unix_micros("timestamp"), "load_seq")
    navs = spikes.readings(nav, "nav_history", of("nav_history"), ["scheme_code"], F.col("day") * F.lit(86_400_000_000), "load_seq")
    return spikes.flag(bars.unionByName(navs), P3_RULES)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "gap_vector").select("event_id", "event_time")
    returns = table(spark, sf_dir, "market_returns").where(F.col("series_name").isin(*RETURN_FIELDS))
    intervals = known_at.validity_intervals(returns, ["series_name"], "known_at", ["trade_date", "known_at", "obs_id"], "day_return")
    got = known_at.as_known(events, "event_id", "event_time", intervals, ["series_name"], disjoint=True)
    name = F.expr("CASE series_name " + " ".join(f"WHEN '{s}' THEN '{f}'" for s, f in RETURN_FIELDS.items()) + " END")
    return got.select("event_id", name.alias("field_name"), F.col("version.obs_id").alias("obs_id"))


P5_MEASURES = {"hourly_prices": ("fall_probability", "fall_q10"), "features": ("ret_20d", "vol_20d")}
#: Loads into which the queries cut the tables by loading time; each but the first corrects the state of those before.
P5_LOADS = 4


def p5_state(spark: SparkSession, sf_dir: str, loads: int = P5_LOADS) -> rolling.DailyState:
    """The daily state of both tables' sources after all loads; a source's two measures are a and b."""
    keys = ["symbol", "feed_id", "timestamp", "ingested_at", "load_seq"]
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("kept_in"), *keys, F.col(a).alias("a"), F.col(b).alias("b")) for t, (a, b) in P5_MEASURES.items()]
    rows = parts[0].unionByName(parts[1])
    source = T.StructType([rows.schema[c] for c in ("kept_in", "symbol", "feed_id")])
    state = rolling.DailyState(spark, work_dir(spark, "rolling"), source, ["a", "b"])
    return rolling.maintain(state, rows, "timestamp", "ingested_at", rolling.load_bounds(rows, "ingested_at", loads), written)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda i: F.expr("CASE kept_in " + " ".join(f"WHEN '{t}' THEN '{m[i]}'" for t, m in P5_MEASURES.items()) + " END")
    rows = p5_state(spark, sf_dir).current().withColumns({"m_a": name(0), "m_b": name(1)})
    return rows.select(
        "symbol",
        "feed_id",
        F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")), "yyyy-MM-dd").alias("for_day"),
        F.expr("stack(2, m_a, n_a_7, s_a_7, n_a_30, s_a_30, m_b, n_b_7, s_b_7, n_b_30, s_b_30) AS (measure, n_7d, total_7d, n_30d, total_30d)"),
    ).select("measure", "symbol", "feed_id", "for_day", "n_7d", "total_7d", "n_30d", "total_30d")


def p5_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trailing averages of the same state, in the measures' own unit."""
    f = p5_found(spark, sf_dir)
    return f.select("measure", "symbol", "feed_id", "for_day", *(F.round(F.try_divide(F.col(f"total_{k}d"), F.col(f"n_{k}d") * 1_000_000), 9).alias(f"avg_{k}d") for k in (7, 30)))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eav.filled_cells(table(spark, sf_dir, "screener_facts"))


def p6_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eav.wide(table(spark, sf_dir, "screener_facts"))
