"""Filling containers of fixed capacity with whole documents by large-item matching.

Sizes are whole numbers from 1 to the capacity, so an instance is a histogram of at most
``capacity`` counts however many documents there are. On it, sizes above a third of the
capacity are matched greedily (at most two share a container; the largest that fits joins the
largest), then the smaller sizes best-fit the remaining gaps in falling order. The outcome is a
list of runs "items number r.. of size s go to containers b.. at place p", which documents look
up by their rank within their size; ranks come from per-(size, shard) counts, so neither a
frequent size nor the number of documents meets in one task.

Defined results: a document longer than a container fills whole ones first and only its
remainder is an item; documents without tokens come out once, with an empty range, spread over
the containers; null keys are ranked like any other value.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY = 2048
#: Documents whose ranks one task numbers.
SHARD_ROWS = 200_000


class Layout:
    """Runs of containers and of the items in them, for a histogram {size: count}."""

    def __init__(self, sizes: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = {s: n for s, n in sizes.items() if n > 0}
        if any(not 0 < s <= capacity for s in self.left):
            raise ValueError("sizes must be from 1 to the capacity")
        self.used: dict[int, int] = defaultdict(int)  # items of a size placed so far: their ranks
        self.containers = 0
        self.runs: list[tuple[int, int, int, int, int, int]] = []  # size, first rank, count, container, place, offset
        self.gaps: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # gap: (container, count, items in each)
        self.order: list[int] = []  # the gaps that have containers, rising
        self._match_large()
        self._fit_small()
        self.blocks = sorted((c, n, k) for bins in self.gaps.values() for c, n, k in bins)

    def _add(self, gap: int, block: tuple[int, int, int]) -> None:
        if block[1] > 0:
            if not self.gaps[gap]:
                bisect.insort(self.order, gap)
            self.gaps[gap].append(block)

    def _open(self, count: int) -> tuple[int, int, int]:
        self.containers += count
        return self.containers - count, count, 0

    def _place(self, size: int, container: int, count: int, place: int, offset: int) -> None:
        self.runs.append((size, self.used[size], count, container, place, offset))
        self.used[size] += count
        self.left[size] -= count

    def _match_large(self) -> None:
        large = sorted(s for s in self.left if 3 * s > self.capacity)
        for a in reversed(large):
            fits = bisect.bisect_right(large, min(a, self.capacity - a)) - 1
            while self.left[a] and fits >= 0:
                b = large[fits]
                n = min(self.left[a], self.left[b]) if a != b else self.left[a] // 2
                if n:
                    at, n, _ = self._open(n)
                    self._place(a, at, n, 0, 0)
                    self._place(b, at, n, 1, a)
                    self._add(self.capacity - a - b, (at, n, 2))
                if not self.left[b] or a == b:
                    fits -= 1
            if n := self.left[a]:
                at, n, _ = self._open(n)
                self._place(a, at, n, 0, 0)
                self._add(self.capacity - a, (at, n, 1))

    def _fit_small(self) -> None:
        for s in sorted((s for s in self.left if 3 * s <= self.capacity), reverse=True):
            while n := self.left[s]:
                i = bisect.bisect_left(self.order, s)
                if i == len(self.order):
                    self._add(self.capacity, self._open(-(-n // (self.capacity // s))))
                    continue
                gap = self.order[i]
                at, count, k = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.order[i]
                each = gap // s
                full = min(count, n // each)
                for j in range(each if full else 0):
                    self._place(s, at, full, k + j, self.capacity - gap + j * s)
                self._add(gap - each * s, (at, full, k + each))
                rest = min(n - full * each, each) if full < count else 0
                if rest:
                    for j in range(rest):
                        self._place(s, at + full, 1, k + j, self.capacity - gap + j * s)
                    self._add(gap - rest * s, (at + full, 1, k + rest))
                    full += 1
                self._add(gap, (at + full, count - full, k))

    def arrays(self) -> dict[str, np.ndarray]:
        """Runs sorted by (size, first rank) for look-up, and blocks of containers with their item counts."""
        r = np.array(sorted(self.runs), np.int64).reshape(-1, 6)
        b = np.array(self.blocks, np.int64).reshape(-1, 3)
        return {"size": r[:, 0], "rank": r[:, 1], "container": r[:, 3], "place": r[:, 4], "offset": r[:, 5], "block": b[:, 0], "items": b[:, 2]}


def _ranked(items: DataFrame, key: str, by: str, shards: int) -> DataFrame:
    """items with ``rank`` from 0 within each value of ``by``, without one task per value."""
    s = items.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))
    inside = s.withColumn("in", F.row_number().over(Window.partitionBy(by, "shard").orderBy(key)) - 1)
    counts = s.groupBy(by, "shard").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.partitionBy(by).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select(by, "shard", F.coalesce(before, F.lit(0)).alias("base"))
    return inside.join(bases, [by, "shard"]).withColumn("rank", F.col("base") + F.col("in")).drop("base", "in", "shard")


def pack(counts: DataFrame, key: str, n_tokens: str, capacity: int = CAPACITY) -> DataFrame:
    """(key, container, position, container_start, token_start, token_end) of (key, token count) rows.

    ``counts`` is read several times: hand in a written or checkpointed table.
    """
    d = counts.select(F.col(key), F.coalesce(F.col(n_tokens), F.lit(0)).cast("long").alias("n"))
    d = d.withColumn("whole", F.when(F.col("n") > capacity, F.expr(f"n DIV {capacity}")).otherwise(F.lit(0)))
    d = d.withColumn("size", F.col("n") - F.col("whole") * capacity)
    # at most capacity + 1 rows come to the driver, whatever the number of documents
    histogram = {r["size"]: r["c"] for r in d.where("size > 0 OR n = 0").groupBy("size").agg(F.count(F.lit(1)).alias("c")).collect()}
    shards = max(16, -(-sum(histogram.values()) // SHARD_ROWS))
    layout = Layout({s: c for s, c in histogram.items() if s > 0}, capacity)
    ship = counts.sparkSession.sparkContext.broadcast(layout.arrays() | {"containers": layout.containers})
    schema = T.StructType([counts.schema[key], *(T.StructField(c, T.LongType()) for c in ("container", "position", "container_start", "token_start", "token_end"))])

    def place(batches):
        a = ship.value
        width = np.int64(1) << 44
        lookup = a["size"] * width + a["rank"]
        for b in batches:
            n, size, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3))
            container, place_, start = np.zeros_like(n), np.zeros_like(n), np.zeros_like(n)
            some = size > 0
            at = np.searchsorted(lookup, size[some] * width + rank[some], side="right") - 1
            container[some], place_[some], start[some] = a["container"][at] + rank[some] - a["rank"][at], a["place"][at], a["offset"][at]
            none = ~some
            if none.any():
                r, most = rank[none], max(1, a["containers"])
                c = r % most
                held = a["items"][np.searchsorted(a["block"], c, side="right") - 1] if a["containers"] else 0
                container[none], place_[none] = c, held + r // most
            out = [pa.array(x) for x in (container, place_, start, n - size, n)]
            yield pa.RecordBatch.from_arrays([b.column(0), *out], names=schema.names)

    items = _ranked(d.where("size > 0 OR n = 0").select(key, "n", "size"), key, "size", shards).select(key, "n", "size", "rank").mapInArrow(place, schema)
    # whole containers of long documents come after the others, numbered by running sums per shard
    long = d.where("whole > 0").select(key, "whole").withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))
    upto = F.sum("whole").over(Window.partitionBy("shard").orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    sums = long.groupBy("shard").agg(F.sum("whole").alias("c"))
    # one row per shard: one per 200,000 documents
    bases = sums.select("shard", F.coalesce(F.sum("c").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    parts = long.withColumn("upto", upto).join(bases, "shard").select(key, (F.col("base") + F.col("upto") - F.col("whole")).alias("first"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("i"))
    wholes = parts.select(
        key,
        (F.col("first") + F.col("i") + layout.containers).alias("container"),
        F.lit(0).cast("long").alias("position"),
        F.lit(0).cast("long").alias("container_start"),
        (F.col("i") * capacity).alias("token_start"),
        ((F.col("i") + 1) * capacity).alias("token_end"),
    )
    return items.unionByName(wholes)
