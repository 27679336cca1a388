"""Backward as-of join without a range join, cut into stretches of time.

Each left row gets the last non-null right value at or before its time (exact matches count).
Both sides meet in stretches of ``width``: inside one a window finds the last value, and where it
has none, the stretch's carry-in does, which comes from one row per (key, stretch). So a key with
a third of all rows is split by time, and nothing sorts a key's whole history but those rows.

Null times on the left match nothing; missing values come out as ``default``. With ``strict``
only values before the left time count. Null keys match each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Microseconds of a stretch (64 days); times that are plain numbers are cut at the same width.
WIDTH = 64 * 86_400_000_000


def _place(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType
    if isinstance(kind, T.DateType):
        return F.unix_micros(F.col(c).cast("timestamp"))
    return F.unix_micros(c) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.col(c).cast("long")


def backward(left: DataFrame, right: DataFrame, on: str, right_on: str, by: list[str], values: list[str], default: float | None = None, strict: bool = False, width: int = WIDTH) -> DataFrame:
    names = left.columns
    own = [f"_v_{v}" for v in values]
    l = left.select(*by, F.struct(*names).alias("_l"), _place(left, on).alias("_t"), F.lit(0 if strict else 1).alias("_side"), *(F.lit(None).cast(right.schema[v].dataType).alias(o) for v, o in zip(values, own)))
    r = right.where(F.col(right_on).isNotNull()).select(*by, F.lit(None).cast(l.schema["_l"].dataType).alias("_l"), _place(right, right_on).alias("_t"), F.lit(1 if strict else 0).alias("_side"), *(F.col(v).alias(o) for v, o in zip(values, own)))
    both = l.unionByName(r).withColumn("_s", F.floor(F.col("_t") / F.lit(width)))
    keys = [*by, "_s"]
    inside = Window.partitionBy(*keys).orderBy(F.col("_t").asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.select(*keys, "_l", *(F.last(o, ignorenulls=True).over(inside).alias(o) for o in own)).where(F.col("_l").isNotNull())
    ends = both.groupBy(*keys).agg(*(F.max_by(o, F.when(F.col(o).isNotNull(), F.col("_t"))).alias(o) for o in own))
    earlier = Window.partitionBy(*by).orderBy(F.col("_s").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*keys, *(F.last(o, ignorenulls=True).over(earlier).alias(o) for o in own))
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    out = filled.alias("f").join(carry.alias("c"), same).select(*(F.col("f._l")[c].alias(c) for c in names), *(F.coalesce(F.col(f"f.{o}"), F.col(f"c.{o}")).alias(v) for v, o in zip(values, own)))
    return out.fillna(default, subset=values) if default is not None else out


def daily_series(returns: DataFrame) -> DataFrame:
    """Settled daily series (series_name, trade_date, day_return): per day the last published non-null value."""
    live = returns.where(F.col("day_return").isNotNull() & ~F.isnan("day_return"))
    return live.groupBy("series_name", "trade_date").agg(F.max_by("day_return", F.struct("known_at", "obs_id")).alias("day_return"))
