"""News items collapsed to one article per address, with the companies it was listed under."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.market import strip
from marketloom.functions.names import flat_names

LAST = ("heading", "content", "date")


def collapsed(items: DataFrame, seq: str) -> DataFrame:
    """(url, heading, content, date, companies): of each url the last non-empty texts in the order of ``seq``, its companies as a set.

    Items without a url are none; a text that is empty everywhere is empty.
    """
    rows = items.withColumn("url", strip(F.col("url"))).where("url <> ''")
    last = [F.coalesce(F.max_by(c, F.when(F.col(c) != "", F.col(seq))), F.lit("")).alias(c) for c in LAST]
    company = strip(F.col("company"))
    return rows.groupBy("url").agg(*last, F.array_sort(F.collect_set(F.when(company != "", company))).alias("companies"))


def with_existing(new: DataFrame, stored: DataFrame, companies: str = "companies") -> DataFrame:
    """new articles whose companies also hold those already stored under their url (lists, or lists as JSON text), sorted."""
    old = stored.join(new.select("url"), "url", "left_semi")
    names = flat_names(F.col(companies) if dict(old.dtypes)[companies] == "string" else F.to_json(companies))
    old = old.groupBy("url").agg(F.flatten(F.collect_list(names)).alias("_old"))
    none = F.array().cast("array<string>")
    return new.join(old, "url", "left").withColumn("companies", F.array_sort(F.array_union("companies", F.coalesce("_old", none)))).drop("_old")
