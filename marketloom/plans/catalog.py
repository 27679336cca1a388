"""All queries of the core by name, with the DuckDB statements they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.plans import problem_oracles as sql
from marketloom.plans import problems as p
from marketloom.plans import capture_queries, listing_queries, model_queries, series_queries, stream_queries  # noqa: F401 (registers)
from marketloom.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return {
        "p1_found": p.p1_found,
        "p1_table": p.p1_table,
        "p1_unions": p.p1_unions,
        "p1_kinds": p.p1_kinds,
        "p2_found": p.p2_found,
        "p2_nav_dates": p.p2_nav_dates,
        "p2_bars": p.p2_bars,
        "p3_found": p.p3_found,
        "p4_found": p.p4_found,
        "p5_found": p.p5_found,
        "p5_averages": p.p5_averages,
        "p6_found": p.p6_found,
        "p6_wide": p.p6_wide,
    } | QUERIES


def oracle_sql() -> dict[str, str]:
    return {
        "p1_kinds": sql.P1_KINDS,
        "p2_nav_dates": sql.P2_NAV_DATES,
        "p3_found": sql.P3_FOUND,
        "p4_found": sql.P4_FOUND,
        "p5_found": sql.P5_FOUND,
        "p5_averages": sql.P5_AVERAGES,
        "p6_found": sql.P6_FOUND,
    } | ORACLES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series_queries.downside(spark, sf_dir)
