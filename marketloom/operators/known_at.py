"""Attributes as they were known at event time.

Versions of an entity's attributes become validity intervals [from, to); each interval is
decomposed into dyadic time nodes (level, index), and an event equi-joins the nodes that
enclose it at every level. The exact half-open bounds are checked on the joined pair and ties
are resolved by a fixed precedence, so nothing that became known later is ever used.

Defined results: events with a null time, and events before anything was known, give no row;
versions with a null value or a null publishing time are ignored; overlapping intervals are
resolved to the greatest precedence tuple.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF_S = 4096
TOP_LEVEL = 12
#: Leaf cells at which the node tree begins and ends (about 1900 and 2260); times beyond are held
#: in the outermost cell, where the exact bounds still decide.
FIRST_LEAF, LAST_LEAF = -539_304, 2_234_880


def _leaf(us: Column) -> Column:
    return F.greatest(F.lit(FIRST_LEAF), F.least(F.lit(LAST_LEAF), F.floor(us / F.lit(LEAF_S * 1_000_000)))).cast("long")


def validity_intervals(versions: DataFrame, entity: list[str], known_at: str, precedence: list[str], value: str) -> DataFrame:
    """(entity..., from_us, to_us, precedence...): in [from, to) this version was the best one known."""
    live = versions.where(F.col(value).isNotNull() & ~F.isnan(value) & F.col(known_at).isNotNull()).select(
        *entity, F.unix_micros(known_at).alias("_at"), F.struct(*precedence).alias("_v")
    )
    order = Window.partitionBy(*entity).orderBy("_at", "_v")
    best = F.max("_v").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        live.withColumn("_best", best)
        .withColumn("_before", F.lag("_best").over(order))
        .where(F.col("_before").isNull() | (F.col("_before") != F.col("_best")))
        .withColumn("_to", F.lead("_at").over(order))
        .where(F.col("_to").isNull() | (F.col("_to") > F.col("_at")))
        .select(*entity, F.col("_at").alias("from_us"), F.col("_to").alias("to_us"), F.col("_best").alias("version"))
    )


def _at_level(j: int):
    return lambda n: F.struct(F.lit(j).alias("level"), n.alias("node"))


def dyadic_nodes(intervals: DataFrame) -> DataFrame:
    """One row per dyadic node of each interval (columns level and node are added)."""
    lo = _leaf(F.col("from_us"))
    hi = F.when(F.col("to_us").isNull(), F.lit(LAST_LEAF)).otherwise(_leaf(F.col("to_us") - 1)) + 1
    levels = []
    for j in range(TOP_LEVEL + 1):
        width = 1 << j
        left, right = F.ceil(lo / F.lit(width)).cast("long"), F.floor(hi / F.lit(width)).cast("long")
        if j < TOP_LEVEL:
            nodes = F.array_compact(
                F.array(
                    F.when((left < right) & (left % 2 != 0), left),
                    F.when((left < right) & (right % 2 != 0), right - 1),
                )
            )
        else:
            nodes = F.when(left < right, F.sequence(left, right - 1)).otherwise(F.array().cast("array<bigint>"))
        levels.append(F.transform(nodes, _at_level(j)))
    return intervals.withColumn("_n", F.explode(F.flatten(F.array(*levels)))).select(
        *[F.col(f"`{c}`") for c in intervals.columns], F.col("_n.level").alias("level"), F.col("_n.node").alias("node")
    )


def _levels(events: DataFrame, at: str) -> DataFrame:
    """events with _t (microseconds) and a row for each level of nodes that may enclose it."""
    return (
        events.withColumn("_t", F.unix_micros(at))
        .withColumn("_leaf", _leaf(F.col("_t")))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(TOP_LEVEL))).alias("_level"))
        .withColumn("_node", F.expr("shiftright(_leaf, _level)"))
        .drop("_leaf")
    )


def _met(ev: DataFrame, intervals: DataFrame, shared: list[str], salt: Column, salts: int, few: bool) -> DataFrame:
    """Events (with the columns of ``_levels``) on the nodes of the intervals that hold their time."""
    nodes = dyadic_nodes(intervals).withColumnsRenamed({"level": "_level", "node": "_node"})
    keys = ["_level", "_node", *shared]
    if few:
        nodes = F.broadcast(nodes)
    else:
        keys.append("_salt")
        ev = ev.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
        nodes = nodes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return ev.join(nodes, keys).where((F.col("_t") >= F.col("from_us")) & (F.col("to_us").isNull() | (F.col("_t") < F.col("to_us"))))


def _few(intervals: DataFrame, most: int) -> bool:
    return intervals.limit(most + 1).count() <= most


def as_known(events: DataFrame, event_id: str, event_time: str, intervals: DataFrame, entity: list[str], salts: int = 8, broadcast_intervals: int = 20_000, disjoint: bool = False) -> DataFrame:
    """(event_id, entity..., version): for each event and entity the version valid at the event's time.

    The entity columns come from the intervals; an event sees every entity unless it carries
    columns of the same names, which then join too. Up to ``broadcast_intervals`` intervals
    (counted first; at most some 30 nodes each) go to every executor, so events aren't shuffled.
    Beyond that both sides are shuffled, and events at one hot instant are spread over ``salts``
    copies of the nodes. Intervals of an entity that are ``disjoint``, as ``validity_intervals``
    makes them, meet an event once, so nothing is left to resolve (and event ids may repeat).
    """
    shared = [c for c in entity if c in events.columns]
    ev = _levels(events.where(F.col(event_time).isNotNull()).select(event_id, *shared, event_time), event_time)
    pairs = _met(ev, intervals, shared, F.xxhash64(event_id), salts, _few(intervals, broadcast_intervals))
    if disjoint:
        return pairs.select(event_id, *entity, "version")
    return pairs.groupBy(event_id, *entity).agg(F.max("version").alias("version"))


def timeline(intervals: DataFrame, entity: str, names: list[str]) -> DataFrame:
    """(from_us, to_us, one version column per name): what was known of all entities at once, for all time.

    One row per publication; they are few beside the events (one window orders them).
    """
    changes = intervals.where(F.col(entity).isin(names)).groupBy("from_us").pivot(entity, names).agg(F.first("version"))
    always = changes.sparkSession.range(1).select(F.lit(-(2**62)).alias("from_us"), *(F.lit(None).cast(changes.schema[n].dataType).alias(n) for n in names))
    w = Window.orderBy("from_us")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return changes.unionByName(always).select("from_us", F.lead("from_us").over(w).alias("to_us"), *(F.last(n, ignorenulls=True).over(upto).alias(n) for n in names))


def attach(events: DataFrame, event_time: str, known: DataFrame, names: list[str], salts: int = 8, broadcast_intervals: int = 20_000) -> DataFrame:
    """events, every row once, with the ``names`` columns of the disjoint intervals that cover all time; null for a null time.

    Rows stay where they are if the intervals are few; there is no grouping and no join back.
    """
    ev = _levels(events.where(F.col(event_time).isNotNull()), event_time)
    plain = [c for c in events.columns if not isinstance(events.schema[c].dataType, T.MapType)]
    got = _met(ev, known, [], F.xxhash64(*plain), salts, _few(known, broadcast_intervals)).select(*events.columns, *names)
    none = events.where(F.col(event_time).isNull()).select("*", *(F.lit(None).cast(known.schema[n].dataType).alias(n) for n in names))
    return got.unionByName(none)
