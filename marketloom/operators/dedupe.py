"""Distinct-on with a stated winner; every rule takes a total order, so results don't depend on row order.

Ties on the whole order keep one row (which one makes no difference to the ordered columns).
Null keys form one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str | Column], order: list[str | Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the given order (the limit is pushed below the shuffle)."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where(F.col("_rn") <= n).drop("_rn")


def keep_last(df: DataFrame, keys: list[str | Column], order: list[str], n: int = 1) -> DataFrame:
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in order], n)


def first_seen(df: DataFrame, value: str, seq: str) -> DataFrame:
    """Distinct values with the least sequence number each, for an ordered distinct list."""
    return df.where(F.col(value).isNotNull() & (F.trim(value) != "")).groupBy(value).agg(F.min(seq).alias(seq))


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """df itself; the query fails if two rows share a key."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("_n", n).where(F.when(F.col("_n") > 1, F.raise_error(F.lit("duplicate keys")).cast("boolean")).otherwise(F.lit(True))).drop("_n")
