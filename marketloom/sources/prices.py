"""Price bars: captured OHLCV files, in-memory price lists, symbol lists, and the row forms they are stored in."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.market import adr_ticker, bar_time_iso, dotted_symbol, finite
from marketloom.operators.dedupe import first_seen, keep_last, require_unique

# The columns of a stored price row, and the tickers of the market series.
PRICE_COLUMNS = ("symbol", "exchange", "interval", "bar_time", "open", "high", "low", "close", "volume", "source")
MARKET_TICKERS = {"nifty": "^NSEI", "nifty_it": "^CNXIT", "usdinr": "INR=X", "nasdaq": "^IXIC"}
ALL_EXCHANGES = ("", "BOTH", "ALL", "*")


def _instant(c: Column, kind: T.DataType) -> Column:
    """A stamp as an instant: text with a zone is converted, text without one is UTC; unreadable text is null."""
    return c.try_cast("timestamp") if isinstance(kind, T.StringType) else c.cast("timestamp")


def period_start(period: str, now: dt.datetime) -> dt.datetime:
    """Where a period like ``5d``, ``2mo`` or ``1y`` before ``now`` begins."""
    n, unit = int("".join(c for c in period if c.isdigit())), "".join(c for c in period if not c.isdigit())
    if unit not in ("d", "mo", "y"):
        raise ValueError(f"unknown period {period!r}")
    if unit == "d":
        return now - dt.timedelta(days=n)
    months = now.year * 12 + now.month - 1 - n * (12 if unit == "y" else 1)
    year, month = divmod(months, 12)
    last = [31, 29 if year % 4 == 0 and (year % 100 or year % 400 == 0) else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][month]
    return now.replace(year=year, month=month + 1, day=min(now.day, last))


def captured_bars(raw: DataFrame, entries: DataFrame | None = None, start: str | None = None, end: str | None = None, period: str | None = None, now: dt.datetime | None = None, adjusted: bool = False) -> DataFrame:
    """(symbol, exchange, ts, open, high, low, close, volume) of captured bars; all symbols in one scan.

    ``raw`` has symbol, exchange, ts (a time or its text), Open, High, Low, Close, Volume and, for
    ``adjusted`` prices, Adj Close. ``start`` (inclusive) and ``end`` (exclusive) override
    ``period``, which counts back from ``now``. ``entries`` (exchange, symbol) keeps the listings
    asked for. Rows with an unreadable stamp are skipped.
    """
    at = _instant(F.col("ts"), raw.schema["ts"].dataType)
    number = lambda c: finite(F.col(f"`{c}`").try_cast("double"))
    factor = F.try_divide(number("Adj Close"), number("Close")) if adjusted else F.lit(1.0)
    price = lambda c: (number(c) * factor if adjusted else number(c)).alias(c.lower())
    out = raw.select(F.upper(F.trim("symbol")).alias("symbol"), F.upper(F.trim("exchange")).alias("exchange"), at.alias("ts"), *(price(c) for c in ("Open", "High", "Low", "Close")), number("Volume").alias("volume")).where("ts IS NOT NULL")
    if start or end:
        if start:
            out = out.where(F.col("ts") >= F.lit(start).cast("timestamp"))
        if end:
            out = out.where(F.col("ts") < F.lit(end).cast("timestamp"))
    elif period and period != "max":
        out = out.where(F.col("ts") >= F.lit(period_start(period, now or dt.datetime.now(dt.timezone.utc))))
    if entries is not None:
        out = out.join(entries.select("exchange", "symbol").distinct(), ["exchange", "symbol"], "left_semi")
    return out.select("symbol", "exchange", "ts", "open", "high", "low", "close", "volume")


def price_rows(bars: DataFrame, interval: str, source: str) -> DataFrame:
    """Bars as stored rows of PRICE_COLUMNS; figures that aren't finite are null, stamps are UTC text."""
    safe = [finite(F.col(c)).alias(c) for c in ("open", "high", "low", "close", "volume")]
    rows = bars.where("ts IS NOT NULL").select("symbol", "exchange", F.lit(interval).alias("interval"), bar_time_iso(F.col("ts")).alias("bar_time"), *safe, F.lit(source).alias("source"))
    return rows.select(*PRICE_COLUMNS)


def sound_bars(bars: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Adjusted hourly bars fit for a model: positive prices, no negative volume, the last of each instant."""
    ok = (finite(F.col("close")) > 0) & (finite(F.col("open")) > 0) & (finite(F.col("volume")) >= 0)
    return keep_last(bars.where(ok & F.col("ts").isNotNull()), [*key, "ts"], order)


def daily_returns(bars: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """(key..., ts, day_return): log return of each positive daily close over the one before; the first has none."""
    days = keep_last(bars.where((finite(F.col("close")) > 0) & F.col("ts").isNotNull()), [*key, "ts"], order)
    w = Window.partitionBy(*key).orderBy("ts")
    return days.select(*key, "ts", (F.ln("close") - F.lag(F.ln("close")).over(w)).alias("day_return"))


def market_tickers(symbols: DataFrame) -> DataFrame:
    """(symbol, series_name, ticker): the market series of each symbol, with the depositary receipt where it has one."""
    fixed = F.array(*(F.struct(F.lit(n).alias("series_name"), F.lit(t).alias("ticker")) for n, t in MARKET_TICKERS.items()))
    adr = F.struct(F.lit("adr").alias("series_name"), adr_ticker(F.upper("symbol")).alias("ticker"))
    rows = symbols.select("symbol").distinct().select("symbol", F.explode(F.concat(fixed, F.array(adr))).alias("x"))
    return rows.select("symbol", "x.*").where("ticker IS NOT NULL")


def symbols_csv(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, seq): distinct tickers of a CSV in the order of their first row; of the column ``symbol``, else the first.

    A CSV without any ticker is an error.
    """
    raw = spark.read.option("header", True).csv(path)
    column = "symbol" if "symbol" in raw.columns else raw.columns[0]
    # a list of symbols is one small file, read in one task, so rows are numbered in order
    rows = raw.coalesce(1).select(dotted_symbol(F.col(f"`{column}`")).alias("symbol"), F.monotonically_increasing_id().alias("seq"))
    out = first_seen(rows.where("symbol IS NOT NULL"), "symbol", "seq")
    if out.isEmpty():
        raise ValueError(f"no symbols in {path}")
    return out


def parse_entries(raw: DataFrame, text: str, seq: str, default_exchange: str = "NSE") -> DataFrame:
    """(exchange, symbol, seq): ``EX:SYM`` or ``SYM`` texts as listings, each once where it first comes; blanks are no entries."""
    d = (default_exchange or "NSE").strip().upper()
    d = "NSE" if d in ALL_EXCHANGES else d
    t = F.trim(text)
    named = F.contains(t, F.lit(":"))
    exchange = F.when(named, F.upper(F.trim(F.substring_index(t, ":", 1)))).otherwise(F.lit(d))
    symbol = F.upper(F.trim(F.when(named, F.expr(f"substring(trim({text}), instr(trim({text}), ':') + 1)")).otherwise(t)))
    rows = raw.select(exchange.alias("exchange"), symbol.alias("symbol"), F.col(seq).alias("seq")).where("symbol <> ''")
    return rows.groupBy("exchange", "symbol").agg(F.min("seq").alias("seq"))


def resolve_entries(spark: SparkSession, universe: DataFrame, entries: Sequence[tuple[str, str]] | None = None, symbols: Sequence[str] | None = None, setting: str | None = None, exchange: str | None = None, limit: int | None = None, limit_setting: int | None = None) -> DataFrame:
    """(exchange, symbol, seq) to load: given entries, else a symbol list, else the setting's list, else the universe.

    ``limit`` cuts any of them; ``limit_setting`` all but a given symbol list. An empty symbol list
    counts as none. The universe is sorted by exchange and symbol.
    """
    schema = "raw string, seq long"
    parsed = [s for s in symbols or [] if str(s).strip()]
    if entries is not None:
        out = spark.createDataFrame([(e.strip().upper(), s.strip().upper(), i) for i, (e, s) in enumerate(entries)], "exchange string, symbol string, seq long")
    elif parsed or (setting or "").strip():
        texts = parsed or [p for p in setting.split(",") if p.strip()]
        out = parse_entries(spark.createDataFrame(list(zip(map(str, texts), range(len(texts)))), schema), "raw", "seq", exchange or "NSE")
    else:
        u = universe.select(F.upper(F.trim("exchange")).alias("exchange"), F.upper(F.trim("symbol")).alias("symbol")).where("symbol <> ''").distinct()
        if (exchange or "").strip().upper() not in ALL_EXCHANGES:
            u = u.where(F.col("exchange") == exchange.strip().upper())
        out = u.withColumn("seq", F.lit(0).cast("long"))
    most = limit if limit is not None else (limit_setting if not parsed or entries is not None else None)
    return out.orderBy("seq", "exchange", "symbol").limit(int(most)) if most is not None else out


def load_counts(entries: DataFrame, rows: DataFrame, failed: DataFrame) -> DataFrame:
    """One row: symbols_requested, and how many of them came with rows (ok), without (skip), or failed (error), and n_rows."""
    key = ["exchange", "symbol"]
    per = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    bad = failed.select(*key).distinct().withColumn("bad", F.lit(True))
    j = entries.select(*key).join(per, key, "left").join(bad, key, "left")
    err, ok = F.coalesce("bad", F.lit(False)), F.col("n") > 0
    return j.agg(F.count(F.lit(1)).alias("symbols_requested"), F.count_if(ok & ~err).alias("ok"), F.count_if(~F.coalesce(ok, F.lit(False)) & ~err).alias("skip"), F.count_if(err).alias("error"), F.coalesce(F.sum(F.when(~err, F.col("n"))), F.lit(0)).alias("n_rows"))


def session_stamps(n: int, end: dt.datetime | None = None) -> list[dt.datetime]:
    """The last n hourly stamps 09:15 to 15:15 of weekdays up to ``end`` (its zone is dropped), oldest first."""
    end = (end or dt.datetime.now()).replace(tzinfo=None)
    out, day = [], dt.datetime(end.year, end.month, end.day)
    while len(out) < n:
        if day.weekday() < 5:
            out += [t for h in range(15, 8, -1) if (t := day + dt.timedelta(hours=h, minutes=15)) <= end]
        day -= dt.timedelta(days=1)
    return out[:n][::-1]


def price_frame(spark: SparkSession, prices: Iterable[float], timestamps: Iterable | None = None, volumes: Iterable[float] | None = None, opens: Iterable[float] | None = None, symbol: str = "prices") -> DataFrame:
    """Bars (symbol, feed_id, ts, open, close, volume) of a list of closes, oldest first.

    Without stamps session hours are made up; without volumes they are 0, without opens the closes.
    Prices must be finite and positive, lengths equal and stamps unique, or it is an error.
    """
    close = [float(x) for x in prices]
    if not close:
        raise ValueError("no prices")
    if any(not math.isfinite(x) or x <= 0 for x in close):
        raise ValueError("every price must be finite and above 0")
    stamps = session_stamps(len(close)) if timestamps is None else list(timestamps)
    columns = {"timestamps": stamps, "volumes": [0.0] * len(close) if volumes is None else [float(v) for v in volumes], "opens": close if opens is None else [float(o) for o in opens]}
    for name, values in columns.items():
        if len(values) != len(close):
            raise ValueError(f"{name}: {len(values)} values for {len(close)} prices")
    stamps = [dt.datetime.fromisoformat(t) if isinstance(t, str) else t.to_pydatetime() if hasattr(t, "to_pydatetime") else t for t in stamps]
    stamps = [t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc) for t in stamps]
    if len(set(stamps)) != len(stamps):
        raise ValueError("timestamps must be unique")
    rows = list(zip([symbol] * len(close), [0] * len(close), stamps, columns["opens"], close, columns["volumes"]))
    return spark.createDataFrame(rows, "symbol string, feed_id long, ts timestamp, open double, close double, volume double")


def validated(bars: DataFrame, key: list[str]) -> DataFrame:
    """bars themselves; the query fails on a price that isn't finite and positive, or on two bars of one instant."""
    ok = F.coalesce(finite(F.col("close")) > 0, F.lit(False))
    checked = bars.where(F.when(~ok, F.raise_error(F.lit("every price must be finite and above 0")).cast("boolean")).otherwise(F.lit(True)))
    return require_unique(checked, [*key, "ts"])


def scheme_codes(nav: DataFrame | None, spark: SparkSession, given: Iterable[int] | None = None, setting: str | None = None, limit: int | None = None) -> DataFrame:
    """(scheme_code, seq): given codes, else the setting's, in their order and each once; else all codes of ``nav``, sorted."""
    if given is not None or (setting or "").strip():
        codes = dict.fromkeys(int(c) for c in (given if given is not None else (x for x in setting.split(",") if x.strip())))
        out = spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "scheme_code long, seq long")
    else:
        out = nav.where("scheme_code IS NOT NULL").select("scheme_code").distinct().withColumn("seq", F.lit(0).cast("long"))
    out = out.orderBy("seq", "scheme_code")
    return out.limit(limit) if limit is not None else out
