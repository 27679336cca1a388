"""Fund NAVs out of semicolon text and per-scheme JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.market import finite, first_filled, nav_date_iso


def parse_lines(lines: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Rows of ``code;isin;isin;name[;more name];nav;date`` lines; headers, sections and lines with an
    unreadable NAV or date are no rows. A name may contain semicolons."""
    p = F.split(value, ";")
    d = lines.withColumn("_p", p).where(F.size("_p") >= 6)
    n = F.size("_p")
    out = d.select(
        *(keep or []),
        F.when(F.trim(F.get("_p", F.lit(0))).rlike(r"^\d{1,18}$"), F.trim(F.get("_p", F.lit(0))).try_cast("long")).alias("scheme_code"),
        first_filled(F.get("_p", F.lit(1)), F.get("_p", F.lit(2))).alias("isin"),
        F.trim(F.array_join(F.slice("_p", F.lit(4), n - 5), ";")).alias("scheme_name"),
        finite(F.trim(F.element_at("_p", -2)).try_cast("double")).alias("nav"),
        nav_date_iso(F.element_at("_p", -1)).alias("nav_date"),
        F.lit("amfi").alias("source"),
    )
    return out.where("scheme_code IS NOT NULL AND nav IS NOT NULL AND nav_date IS NOT NULL")


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path))


HISTORY = "status string, meta struct<scheme_code: long, scheme_name: string, isin_growth: string, isin_div_reinvestment: string>, data array<struct<date: string, nav: string>>"


def read_history(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """NAV rows of per-scheme JSON documents (one a file, or one a line); those without success or data give none. A bad row
    drops itself, not its scheme."""
    docs = spark.read.schema(HISTORY).option("multiLine", not lines).json(path).where("status = 'SUCCESS'")
    rows = docs.select("meta", F.explode("data").alias("r")).select(
        F.col("meta.scheme_code").alias("scheme_code"),
        nav_date_iso(F.col("r.date")).alias("nav_date"),
        first_filled(F.col("meta.isin_growth"), F.col("meta.isin_div_reinvestment")).alias("isin"),
        F.col("meta.scheme_name").alias("scheme_name"),
        finite(F.trim("r.nav").try_cast("double")).alias("nav"),
        F.lit("mfapi").alias("source"),
    )
    return rows.where("nav IS NOT NULL AND nav_date IS NOT NULL")
