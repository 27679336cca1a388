"""Sessions as a source's own bars show them, and the bars expected next (weekends off, no holidays)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.market import INDIA
from marketloom.operators.series import SOURCE, in_time

HOUR_US, DAY_MIN = 3_600_000_000, 1440


def session_shape(bars: DataFrame, source: list[str] = SOURCE, zone: str = INDIA) -> DataFrame:
    """(source..., step_us, start_minute, end_minute): median step inside a session and the 5th and 95th
    percentile of the minute of day on the exchange's clock; 09:15 to 15:15 where these collapse."""
    step = F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(in_time(source))
    local = F.from_utc_timestamp("ts", zone)
    m = bars.select(*source, step.alias("step"), (F.hour(local) * 60 + F.minute(local)).alias("minute"))
    q = lambda p: F.floor(F.percentile("minute", p)).cast("int")
    g = m.groupBy(*source).agg(F.median(F.when(F.col("step") <= 4 * HOUR_US, F.col("step"))).alias("s"), q(0.05).alias("a"), q(0.95).alias("b"))
    flat = F.col("b") <= F.col("a")
    return g.select(
        *source,
        F.coalesce(F.col("s").cast("long"), F.lit(HOUR_US)).alias("step_us"),
        F.when(flat, 555).otherwise(F.col("a")).alias("start_minute"),
        F.when(flat, 915).otherwise(F.col("b")).alias("end_minute"),
    )


def session_shape_at(bars: DataFrame, origins: DataFrame, source: list[str] = SOURCE, zone: str = INDIA) -> DataFrame:
    """(source..., ts, step_us, start_minute, end_minute): session_shape of the bars up to each origin (source..., ts)."""
    local = F.from_utc_timestamp("ts", zone)
    m = bars.select(*source, F.unix_micros("ts").alias("us"), (F.hour(local) * 60 + F.minute(local)).alias("minute"))
    o = origins.select(*(F.col(c).alias(f"_{c}") for c in (*source, "ts")), F.unix_micros("ts").alias("_us"))
    schema = T.StructType([*(origins.schema[c] for c in (*source, "ts")), *T._parse_datatype_string("step_us long, start_minute int, end_minute int").fields])

    def run(t: pa.Table, at: pa.Table) -> pa.Table:
        t = t.sort_by("us")
        us, minute = t.column("us").to_numpy(), t.column("minute").to_numpy()
        step = np.diff(us)
        rows = []
        for n in np.searchsorted(us, at.column("_us").to_numpy(), side="right"):
            inner = step[: max(n - 1, 0)]
            inner = inner[inner <= 4 * HOUR_US]
            a, b = (int(np.percentile(minute[:n], p)) for p in (5, 95)) if n else (0, 0)
            rows.append((int(np.median(inner)) if len(inner) else HOUR_US, *((a, b) if b > a else (555, 915))))
        cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.int32()))]
        return pa.Table.from_arrays([*at.drop_columns(["_us"]).columns, *cols], names=schema.names)

    return m.groupBy(*source).cogroup(o.groupBy(*(f"_{c}" for c in source))).applyInArrow(run, schema)


def next_bars(origins: DataFrame, n: int, keys: list[str], zone: str = INDIA) -> DataFrame:
    """(keys..., horizon 1..n, ts): bars expected after ``origin`` for rows with origin, step_us, start_minute, end_minute.

    On the exchange's clock a session runs from start to end minute; a step that leaves it goes on
    at the next session's start. Each origin folds n steps on the JVM side.
    """
    local_us = lambda ts: F.unix_micros(F.from_utc_timestamp(ts, zone))
    day_us, min_us = F.lit(86_400_000_000), F.lit(60_000_000).cast("long")

    def settle(t: Column) -> Column:
        """The first instant at or after t inside a session."""
        day, minute = F.floor(t / day_us), F.floor(F.pmod(t, day_us) / min_us)
        late = minute > F.col("end_minute")
        weekend = F.pmod(day + 3, F.lit(7)) >= 5  # 1970-01-01 was a Thursday
        moved = F.when(weekend | late, day + F.when(weekend, F.lit(0)).otherwise(F.lit(1))).otherwise(day)
        wd = F.pmod(moved + 3, F.lit(7))
        target = moved + F.when(wd >= 5, 7 - wd).otherwise(F.lit(0))
        at_start = target * day_us + F.col("start_minute") * min_us
        stays = (target == day) & (minute >= F.col("start_minute"))
        return F.when(stays, t).otherwise(at_start).cast("long")

    first = origins.withColumn("_t", local_us(F.col("origin")))
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(n)),
        F.array(F.col("_t")),
        lambda acc, _: F.concat(acc, F.array(settle(F.element_at(acc, -1) + F.col("step_us")))),
    )
    out = first.select(*keys, F.posexplode(F.slice(steps, 2, n)).alias("p", "local"))
    return out.select(*keys, (F.col("p") + 1).alias("horizon"), F.to_utc_timestamp(F.timestamp_micros("local"), zone).alias("ts"))


def information_cutoff(next_ts: Column, origin: Column, mode: str = "before_next_open") -> Column:
    """What may be known when the next bar is forecast: the origin itself, or a minute before the next bar."""
    if mode == "last_bar":
        return origin
    return F.coalesce(next_ts, origin + F.expr("INTERVAL 18 HOURS")) - F.expr("INTERVAL 1 MINUTE")


def as_instant(text: Column, zone: str = INDIA) -> Column:
    """A cutoff's text as an instant: with a zone or offset it is converted, without one it is the exchange's clock."""
    own = F.trim(text).rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2}|[A-Za-z]+/[A-Za-z_]+)$") & F.trim(text).rlike("[T ][0-9]{2}:")
    return F.when(own, text.try_cast("timestamp")).otherwise(F.to_utc_timestamp(text.try_cast("timestamp"), zone))
