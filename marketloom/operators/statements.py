"""Company statements: one row per period with a fixed set of metric columns for each of the seven tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.fundamentals import SYNONYMS, TABLE_METRICS, metric_of, norm_label, period_of, squeeze
from marketloom.functions.market import figure
from marketloom.operators.dedupe import keep_last

BASE = ("symbol", "financial_period")


def snake_label(label):
    """A label as a column name without the aliases, so that two names of one metric stay apart."""
    return F.regexp_replace(F.regexp_replace(norm_label(label), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def combined(df: DataFrame) -> DataFrame:
    """df with synonym columns folded into the canonical ones: the canonical value where there is one."""
    for name, other in SYNONYMS.items():
        if other in df.columns:
            value = F.coalesce(F.col(name), F.col(other)) if name in df.columns else F.col(other)
            df = df.withColumn(name, value).drop(other)
    return df


def canonical(table_name: str, df: DataFrame) -> DataFrame:
    """A statement's rows in the columns of its table: synonyms folded, missing metrics null, others dropped."""
    df = combined(df)
    metrics = TABLE_METRICS.get(table_name)
    if metrics is None:
        return df
    return df.select(*BASE, *(F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in metrics))


def cells(facts: DataFrame, aliases: bool = True) -> DataFrame:
    """(table_name, symbol, financial_period, metric, value): the last readable figure of each cell by loading."""
    label = metric_of(norm_label(F.col("metric_label"))) if aliases else snake_label(F.col("metric_label"))
    rows = facts.select("table_name", F.upper(F.trim("symbol")).alias("symbol"), period_of(F.upper(squeeze(F.col("financial_period")))).alias("financial_period"), label.alias("metric"), figure(F.col("metric_text")).alias("value"), "ingested_at", "load_seq")
    rows = rows.where("symbol <> '' AND financial_period IS NOT NULL AND metric IS NOT NULL AND value IS NOT NULL")
    return keep_last(rows, ["table_name", "symbol", "financial_period", "metric"], ["ingested_at", "load_seq"]).drop("ingested_at", "load_seq")


def by_period(cell: DataFrame, metrics: list[str]) -> DataFrame:
    """The transposed statement: one row per (table_name, symbol, financial_period), a column for each metric named."""
    return cell.where(F.col("metric").isin(metrics)).groupBy("table_name", *BASE).pivot("metric", metrics).agg(F.first("value"))


def seven_tables(facts: DataFrame, settle=lambda df, name: df) -> dict[str, DataFrame]:
    """Each table's frame out of one pass over the facts; ``settle`` may write the pivot that all of them read."""
    names = sorted({m for t in TABLE_METRICS.values() for m in t} | set(SYNONYMS.values()))
    wide = settle(by_period(cells(facts), names), "statements")
    return {t: canonical(t, wide.where(F.col("table_name") == t).select(*BASE, *(m for m in (*TABLE_METRICS[t], *SYNONYMS.values())))) for t in TABLE_METRICS}
