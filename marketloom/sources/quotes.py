"""Quotes fetched in batches of instruments, with a fallback, as one price row per listing and day."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.market import finite, symbol_of_key
from marketloom.operators.dedupe import keep_first
from marketloom.sources.prices import PRICE_COLUMNS

BATCH = 300
#: Keys of a batch to their JSON payloads.
Fetcher = Callable[[list[str]], dict[str, str]]


def fetched(keys: DataFrame, key: str, seq: str, fetch: Fetcher, fallback: Fetcher | None = None, batch: int = BATCH, tries: int = 3, wait_s: float = 0.0) -> DataFrame:
    """(key, seq, payload, status) of every key; ``fetch`` gets up to ``batch`` keys at a time, many batches at once.

    A batch is tried ``tries`` times, then given to ``fallback``; where that fails too its keys come
    out without a payload. status is ``ok``, ``fallback``, ``missing`` (not in the answer) or
    ``error``. A batch is what one task holds; tasks run side by side as the cluster allows.
    """
    kind = keys.schema[key].dataType.simpleString()

    def attempt(call: Fetcher, block: list[str], times: int) -> dict[str, str] | None:
        for n in range(times):
            try:
                return call(block)
            except Exception:  # noqa: BLE001 - whatever a connector raises counts as one failed try
                if n + 1 < times and wait_s:
                    time.sleep(wait_s * 2**n)
        return None

    def blocks(batches: Iterable[pa.RecordBatch]):
        rows: list[tuple] = []
        for b in batches:
            rows += zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            while len(rows) >= batch:
                yield rows[:batch]
                del rows[:batch]
        if rows:
            yield rows

    def run(batches):
        for rows in blocks(batches):
            asked = list(dict.fromkeys(k for k, _ in rows))
            got, good = attempt(fetch, asked, tries), "ok"
            if got is None and fallback is not None:
                got, good = attempt(fallback, asked, 1), "fallback"
            status = lambda k: "error" if got is None else good if k in got else "missing"  # noqa: E731, B023
            columns = ([k for k, _ in rows], [s for _, s in rows], [(got or {}).get(k) for k, _ in rows], [status(k) for k, _ in rows])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string()))], names=[key, seq, "payload", "status"])

    asked = keys.where(F.col(key).isNotNull()).select(F.col(key), F.col(seq).cast("long"))
    return asked.mapInArrow(run, f"`{key}` {kind}, `{seq}` long, payload string, status string")


def quote_rows(quotes: DataFrame, bar_time, key: str = "key", seq: str = "seq", source: str = "quotes") -> DataFrame:
    """Daily price rows out of quotes (key, seq, payload); one per listing.

    A listing's main series comes before its trade-to-trade twin (``-BE``), then the earlier in
    ``seq``. A close that is missing is the last price, a missing volume the traded one.
    """
    q = F.from_json("payload", "last_price string, ohlc struct<open: string, high: string, low: string, close: string>, volume string, volume_traded string")
    number = lambda c: finite(F.col(c).try_cast("double"))
    rows = quotes.where("payload IS NOT NULL").select(
        F.upper(F.trim(F.substring_index(key, ":", 1))).alias("exchange"),
        symbol_of_key(F.col(key)).alias("symbol"),
        F.col(key).rlike("(?i)-BE$").cast("int").alias("_be"),
        F.col(seq).alias("_seq"),
        q.alias("q"),
    )
    rows = keep_first(rows.where("symbol <> ''"), ["exchange", "symbol"], ["_be", "_seq"])
    rows = rows.withColumns({"interval": F.lit("1d"), "bar_time": bar_time, "source": F.lit(source)})
    rows = rows.withColumns({c: number(f"q.ohlc.{c}") for c in ("open", "high", "low")})
    raw = lambda *c: finite(F.coalesce(*(F.col(f"q.{x}") for x in c)).try_cast("double"))
    return rows.withColumns({"close": raw("ohlc.close", "last_price"), "volume": raw("volume", "volume_traded")}).select(*PRICE_COLUMNS)
