"""Rolling totals over trailing calendar days as a versioned daily state.

The state holds one row per source and calendar day: the day's own amounts and its trailing
totals, in whole millionths, so no rounding accumulates. A load changes the amounts of some
(source, day)s. The dates whose windows contain such a day, and the calendar days that are new,
form stretches; each stretch starts from yesterday's stored totals and goes on day by day,

    totals(day) = totals(yesterday) + arrivals(day) - amounts(expiring day),

so only affected dates are read and written, under the load's version. Of a (source, day)'s rows
the one with the greatest version counts. A first load is the same thing on an empty state.

Defined results: rows without a timestamp belong to no day and are ignored; null, NaN and
infinite readings, and those beyond 9e12, count as null; of rows with the same source and
timestamp the latest ``ingested_at`` (null first), then the greatest ``load_seq``, counts, with
its nulls; days without rows inside a source's first and last day come out with what their
windows hold (0 where that is nothing); null parts of a source's key are a source of their own.

Scale: readings shuffle on (source, day), so a hot source is split by its days; a source's
dates in one task are at most the calendar's. State files are cut into blocks of 32 days, and a
load reads the blocks that its stretches need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MILLION = 1_000_000
DAY_US = 86_400_000_000
BLOCK_DAYS = 32
#: Readings from here on aren't whole millionths of a long.
MOST = 9e12


def _micro(c: str) -> Column:
    return F.when(F.abs(c) < MOST, F.round(F.col(c) * MILLION).cast("long"))


def _block(day: Column) -> Column:
    return F.floor(day / BLOCK_DAYS).cast("int")


def _same(a: str, b: str, keys: list[str]) -> list[Column]:
    return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in keys]


def daily_amounts(rows: DataFrame, source: list[str], ts: str, measures: list[str], version: tuple[str, ...] = ("ingested_at", "load_seq"), since: Column | None = None) -> DataFrame:
    """(source..., day, n_<m>, s_<m>...): arrivals per source and UTC day, re-delivered rows settled.

    With ``since``, a condition on new rows, only days with a new row come out.
    """
    fresh = F.coalesce(since, F.lit(False)) if since is not None else F.lit(True)
    r = (
        rows.where(F.col(ts).isNotNull())
        .select(*source, F.unix_micros(ts).alias("_t"), *version, fresh.alias("_new"), *(_micro(m).alias(m) for m in measures))
        .withColumn("day", F.floor(F.col("_t") / F.lit(DAY_US)).cast("int"))
    )
    w = Window.partitionBy(*source, "day").orderBy("_t", *version)
    last = r.withColumn("_next", F.lead("_t").over(w)).where(F.col("_next").isNull() | (F.col("_next") != F.col("_t")))
    aggs = [a for m in measures for a in (F.count(m).alias(f"n_{m}"), F.coalesce(F.sum(m), F.lit(0)).alias(f"s_{m}"))]
    days = last.groupBy(*source, "day").agg(*aggs, F.max("_new").alias("_new"))
    return days.where("_new").drop("_new")


class DailyState:
    """The versioned state of some sources in a folder that all executors share.

    ``totals/block=b`` holds rows of 32 days each, ``sources`` one row per source and version
    with its first and last day.
    """

    def __init__(self, spark: SparkSession, path: str, source: T.StructType, measures: list[str], spans: tuple[int, ...] = (7, 30)):
        self.spark, self.path, self.spans = spark, path.rstrip("/"), spans
        self.source, self.measures = source.fieldNames(), list(measures)
        self.amounts = [f"{p}_{m}" for m in measures for p in ("n", "s")]
        self.totals = [f"{a}_{k}" for a in self.amounts for k in spans]
        long = [T.StructField(c, T.LongType()) for c in (*self.amounts, *self.totals)]
        day = T.StructField("day", T.IntegerType())
        self._row = T.StructType([*source, day, *long, T.StructField("version", T.IntegerType()), T.StructField("block", T.IntegerType())])
        self._edge = T.StructType([*source, T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])
        self.version = 0

    def current(self, blocks: list[int] | None = None) -> DataFrame:
        """(source..., day, amounts, totals, version) as of now, of all dates or of those in ``blocks``."""
        if not self.version:
            return self.spark.createDataFrame([], self._row).drop("block")
        rows = self.spark.read.schema(self._row).parquet(f"{self.path}/totals")
        if blocks is not None:
            rows = rows.where(F.col("block").isin(blocks))
        if self.version > 1:
            newest = F.max_by(F.struct(*self.amounts, *self.totals), "version").alias("_r")
            rows = rows.groupBy(*self.source, "day").agg(newest, F.max("version").alias("version")).select(*self.source, "day", "_r.*", "version")
        return rows.select(*self.source, "day", *self.amounts, *self.totals, "version")

    def edges(self) -> DataFrame:
        """(source..., first, last): the calendar of each source as of now."""
        if not self.version:
            return self.spark.createDataFrame([], self._edge)
        return self.spark.read.schema(self._edge).parquet(f"{self.path}/sources/{self.version:06d}")

    def advance(self, changed: DataFrame) -> int:
        """Takes a load in; ``changed`` has the settled amounts of every (source, day) it touched and is read several times."""
        version, src, reach = self.version + 1, self.source, max(self.spans)
        changed = changed.select(*src, "day", *self.amounts)
        before = self.edges()
        came = changed.groupBy(*src).agg(F.min("day").alias("first"), F.max("day").alias("last"))
        span = (
            came.alias("c").join(before.alias("b"), _same("c", "b", src), "left")
            .select(*(F.col(f"c.{c}") for c in src), F.col("b.first").alias("was_first"), F.col("b.last").alias("was_last"),
                    F.least("c.first", "b.first").alias("first"), F.greatest("c.last", "b.last").alias("last"), F.lit(True).alias("touched"))
        )
        if self.version:
            kept = before.alias("b").join(came.alias("c"), _same("b", "c", src), "left_anti")
            span = span.unionByName(kept.select(*src, F.lit(None).cast("int").alias("was_first"), F.lit(None).cast("int").alias("was_last"), "first", "last", F.lit(False).alias("touched")))
        edge = f"{self.path}/sources/{version:06d}"
        span.write.parquet(edge)
        span = self.spark.read.schema(span.schema).parquet(edge)

        # intervals of affected dates, merged into stretches: the windows of changed days, and new dates
        here = span.where("touched")
        interval = lambda rows, lo, hi: rows.select(*src, lo.alias("lo"), hi.alias("hi"))
        first, last, was_first, was_last = (F.col(c) for c in ("first", "last", "was_first", "was_last"))
        spans = (
            interval(changed, F.col("day"), F.col("day") + (reach - 1))
            .unionByName(interval(here.where("was_first IS NULL"), first, last))
            .unionByName(interval(here.where("was_last < last"), was_last + 1, last))
            .unionByName(interval(here.where("first < was_first"), first, was_first - 1))
        )
        w = Window.partitionBy(*src).orderBy("lo", "hi")
        spans = spans.withColumn("_upto", F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        starts = F.when(F.col("_upto").isNull() | (F.col("lo") > F.col("_upto") + 1), F.col("lo"))
        stretch = spans.withColumn("start", F.last(starts, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*src, "start").agg(F.max("hi").alias("stop"))
        # windows end with the calendar
        stretch = stretch.alias("x").join(here.alias("h"), _same("x", "h", src)).select(*(F.col(f"x.{c}") for c in src), "start", F.least("stop", "last").alias("stop"))
        if self.version:  # one row per stretch, read three times
            stretch.write.parquet(f"{self.path}/stretches/{version:06d}")
            stretch = self.spark.read.schema(stretch.schema).parquet(f"{self.path}/stretches/{version:06d}")
            needed = stretch.select(F.explode(F.sequence(_block(F.col("start") - (reach + 1)), _block(F.col("stop"))))).distinct()
        # the dates of each stretch and those whose amounts expire in it, without gaps
        dates = stretch.select(*src, "start", F.explode(F.sequence(F.col("start") - reach, F.col("stop"))).alias("day"))

        old = self.current(sorted(b for (b,) in needed.collect()) if self.version else None)  # as many as the calendar has
        amounts, yesterday = changed, None
        if self.version:
            still = old.alias("o").join(changed.alias("c"), _same("o", "c", [*src, "day"]), "left_anti")
            amounts = changed.unionByName(still.select(*src, "day", *self.amounts))
            yesterday = stretch.alias("s").join(old.alias("o"), [*_same("s", "o", src), F.col("o.day") == F.col("s.start") - 1]).select(*(F.col(f"s.{c}") for c in src), "start", "day", *self.totals)
        zero = F.lit(0).cast("long")
        filled = dates.alias("d").join(amounts.alias("a"), _same("d", "a", [*src, "day"]), "left").select(*(F.col(f"d.{c}") for c in (*src, "start", "day")), *(F.coalesce(F.col(f"a.{c}"), zero).alias(c) for c in self.amounts))
        if yesterday is not None:
            filled = filled.alias("d").join(yesterday.alias("y"), _same("d", "y", [*src, "start", "day"]), "left").select("d.*", *(F.col(f"y.{c}") for c in self.totals))
        else:
            filled = filled.select("*", *(zero.alias(c) for c in self.totals))
        # from yesterday's totals on: what arrives, less what expires
        w = Window.partitionBy(*src, "start").orderBy("day")
        step = {f"{a}_{k}": F.when(F.col("day") >= F.col("start"), F.col(a) - F.lag(a, k).over(w)).otherwise(F.coalesce(f"{a}_{k}", zero)) for a in self.amounts for k in self.spans}
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        rows = filled.withColumns(step).select(*src, "start", "day", *self.amounts, *(F.sum(c).over(run).alias(c) for c in self.totals)).where("day >= start")
        rows = rows.select(*src, "day", *self.amounts, *self.totals, F.lit(version).alias("version"), _block(F.col("day")).alias("block"))
        rows.write.mode("append").partitionBy("block").parquet(f"{self.path}/totals")
        self.version = version
        return version


def load_bounds(rows: DataFrame, loaded_at: str, loads: int) -> list:
    """Instants that cut the rows' loading time into ``loads`` equal parts; fewer where it is short."""
    lo, hi = rows.agg(F.min(F.unix_micros(loaded_at)), F.max(F.unix_micros(loaded_at))).first()
    if lo is None:
        return []
    return sorted({lo + (hi - lo) * k // loads for k in range(1, loads)} - {hi})


def maintain(state: DailyState, rows: DataFrame, ts: str, loaded_at: str, bounds: list, settle) -> DailyState:
    """Feeds rows to the state load by load, cut at ``bounds`` (microseconds); ``settle(df, name)`` writes a table once.

    For each load only the rows of the touched blocks of days are read, up to its bound.
    """
    us = F.unix_micros(loaded_at)
    for i in range(len(bounds) + 1):
        lo, hi = (bounds[i - 1] if i else None), (bounds[i] if i < len(bounds) else None)
        upto = rows if hi is None else rows.where(F.col(loaded_at).isNull() | (F.col(loaded_at) <= F.timestamp_micros(F.lit(hi))))
        since = None
        if lo is not None:
            since = us > lo
            part = upto.where(F.col(loaded_at) > F.timestamp_micros(F.lit(lo))).where(F.col(ts).isNotNull())
            blocks = sorted(b for (b,) in part.select(F.floor(F.unix_micros(ts) / F.lit(DAY_US * BLOCK_DAYS)).cast("int")).distinct().collect())
            if not blocks:
                continue
            near = F.lit(False)
            for b in blocks:
                near |= F.col(ts).between(*(F.timestamp_micros(F.lit(x)) for x in (b * BLOCK_DAYS * DAY_US, (b + 1) * BLOCK_DAYS * DAY_US - 1)))
            upto = upto.where(near)
        state.advance(settle(daily_amounts(upto, state.source, ts, state.measures, since=since), f"load{i}"))
    return state
