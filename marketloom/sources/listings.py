"""Exchange and fund listings out of captured CSV and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.market import first_filled, flag
from marketloom.operators.dedupe import keep_first

COLUMNS = ["exchange", "symbol", "company_name", "isin", "series", "listing_date", "face_value", "exchange_code"]
FUND_FLAGS = ("purchase_allowed", "redemption_allowed")
FUND_FIGURES = ("minimum_purchase_amount", "purchase_amount_multiplier", "minimum_additional_purchase_amount", "minimum_redemption_quantity", "redemption_quantity_multiplier", "last_price")


def _tidy(c: str):
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalised(df: DataFrame) -> DataFrame:
    """Trimmed upper-case symbols and names with single blanks; other columns as they are."""
    return df.withColumn("symbol", F.upper(F.trim("symbol"))).withColumn("company_name", _tidy("company_name"))


def _in_order(raw: DataFrame) -> DataFrame:
    """raw with seq, the place of a row in its file; a master is one small file, read in one task."""
    return raw.coalesce(1).withColumn("seq", F.monotonically_increasing_id())


def nse_master(spark: SparkSession, path: str) -> DataFrame:
    """The CSV master with padded headers, the first row of each symbol; ISINs and codes of this exchange are left blank."""
    raw = spark.read.option("header", True).csv(path)
    raw = _in_order(raw.toDF(*(c.strip().upper() for c in raw.columns)))
    rows = raw.select(
        F.lit("NSE").alias("exchange"),
        F.col("SYMBOL").alias("symbol"),
        _tidy("`NAME OF COMPANY`").alias("company_name"),
        F.lit("").alias("isin"),
        F.trim("SERIES").alias("series"),
        F.trim("`DATE OF LISTING`").alias("listing_date"),
        F.trim("`FACE VALUE`").try_cast("double").alias("face_value"),
        F.lit("").alias("exchange_code"),
        "seq",
    ).dropna(subset=["symbol"])
    return keep_first(rows, ["exchange", "symbol"], ["seq"])


def bse_master(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The JSON master (an array, or one object a line): issuer's name or else the scrip's, equities (INE) only, the first row of each symbol."""
    schema = "Issuer_Name string, Scrip_Name string, scrip_id string, ISIN_NUMBER string, GROUP string, FACE_VALUE string, SCRIP_CD string"
    raw = _in_order(spark.read.schema(schema).option("multiLine", not lines).json(path))
    out = raw.select(
        F.lit("BSE").alias("exchange"),
        F.upper(F.trim("scrip_id")).alias("symbol"),
        F.trim(F.regexp_replace(first_filled(F.col("Issuer_Name"), F.col("Scrip_Name")), r"\s+", " ")).alias("company_name"),
        F.upper(F.trim("ISIN_NUMBER")).alias("isin"),
        F.trim("GROUP").alias("series"),
        F.lit("").alias("listing_date"),
        F.trim("FACE_VALUE").try_cast("double").alias("face_value"),
        F.trim("SCRIP_CD").alias("exchange_code"),
        "seq",
    )
    ok = (F.col("symbol") != "") & (F.col("company_name") != "") & F.startswith("isin", F.lit("INE"))
    return keep_first(out.where(ok), ["exchange", "symbol"], ["seq"])


def universe(nse: DataFrame, bse: DataFrame) -> DataFrame:
    """Both masters, the first row of each exchange and symbol in source order, NSE's file before BSE's."""
    both = nse.select(*COLUMNS, F.lit(0).alias("_file"), "seq").unionByName(bse.select(*COLUMNS, F.lit(1).alias("_file"), "seq"))
    return keep_first(both, ["exchange", "symbol"], ["_file", "seq"]).select(*COLUMNS)


def fund_master(spark: SparkSession, path: str) -> DataFrame:
    """Fund instruments of a headed CSV: flags and figures typed, blank and bad figures null. A file without rows is an error."""
    raw = spark.read.option("header", True).csv(path)
    if raw.isEmpty():
        raise ValueError(f"no fund instruments in {path}")
    typed = {c: F.coalesce(flag(F.col(c)), F.lit(False)) for c in FUND_FLAGS if c in raw.columns} | {c: F.trim(c).try_cast("double") for c in FUND_FIGURES if c in raw.columns}
    return raw.withColumns(typed)


def growth_only(funds: DataFrame, purchasable: bool = True) -> DataFrame:
    """Growth plans (and only those open for purchase)."""
    g = funds.where(F.lower(F.trim("dividend_type")) == "growth")
    return g.where("purchase_allowed") if purchasable else g


def symbols(df: DataFrame, exchange: str | None, limit: int | None = None) -> DataFrame:
    """Distinct symbols of an exchange ('' , BOTH, ALL and * mean all), sorted."""
    d = normalised(df)
    if exchange and exchange.strip().upper() not in ("", "BOTH", "ALL", "*"):
        d = d.where(F.col("exchange") == exchange.strip().upper())
    d = d.where("symbol <> ''").select("symbol").distinct().orderBy("symbol")
    return d.limit(limit) if limit else d
