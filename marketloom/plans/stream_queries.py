"""Queries that run a stream to its end."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.lake import Lake, TableSpec
from marketloom.plans.registry import query
from marketloom.session import table, work_dir
from marketloom.streaming.upserts import ingest

NAV = TableSpec(
    "nav_history",
    T.StructType([T.StructField("scheme_code", T.LongType()), T.StructField("nav_date", T.StringType()), T.StructField("nav", T.DoubleType()), T.StructField("source", T.StringType())]),
    keys=["scheme_code", "nav_date"],
    disposition="merge",
)


@query("stream_snk03_nav_upsert", "SELECT scheme_code, nav_date, CASE WHEN isfinite(nav) THEN nav END AS nav, source FROM nav_history QUALIFY row_number() OVER (PARTITION BY scheme_code, nav_date ORDER BY load_seq DESC) = 1")
def nav_upsert(spark, d):
    root = work_dir(spark, "stream")
    rows = table(spark, d, "nav_history").select("load_seq", "scheme_code", "nav_date", F.col("nav"), "source")
    # a pattern, since a stream takes a single file only by one
    return ingest(spark, f"{d}/nav_history.parque[t]", rows.schema, Lake(spark, f"{root}/lake"), NAV, f"{root}/checkpoint", ["load_seq"])
