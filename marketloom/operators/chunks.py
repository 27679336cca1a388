"""Trailing windows and recursions over a source's rows, cut into chunks of consecutive rows.

Rows are numbered per source through counts of (source, period), so no window runs over a whole
source. A chunk holds the rows of one stretch of numbers and, before them, as many earlier rows
(its halo) as the longest window needs; a source with a third of all rows is many tasks, and a
task holds one chunk at a time. Widths may differ by source, as frames aren't literals here.

Recursions go the other way round: what a chunk does to a state is an affine map, so each chunk
is run from a zero state, the maps are composed over a source's few chunks, and each chunk runs
again from its true state. Results don't depend on the cut but for rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 4096
PERIOD_DAYS = 64


def ranked(df: DataFrame, source: list[str], ts: str = "ts", days: int = PERIOD_DAYS) -> DataFrame:
    """df with i, the place of each row in its source by time from 0, and n, the rows of its source."""
    by_period = Window.partitionBy(*source, "_p").orderBy(ts)
    cut = df.withColumn("_p", F.floor(F.unix_micros(ts) / F.lit(days * 86_400_000_000)).cast("int"))
    placed = cut.withColumn("_k", F.row_number().over(by_period))
    counts = cut.groupBy(*source, "_p").agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(Window.partitionBy(*source).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*source, "_p", F.coalesce(before, F.lit(0)).alias("_b"), F.sum("_c").over(Window.partitionBy(*source)).alias("n"))
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*source, "_p")]
    return placed.alias("r").join(counts.alias("c"), on).select(*(F.col(f"r.`{c}`") for c in df.columns), (F.col("_b") + F.col("_k") - 1).alias("i"), "n")


def chunked(rows: DataFrame, halo: Column, chunk: int = CHUNK) -> DataFrame:
    """rows (with i, n) once for their own chunk and once for each later chunk that begins within ``halo`` rows."""
    home = F.floor(F.col("i") / chunk).cast("int")
    last = F.floor((F.col("n") - 1) / chunk).cast("int")
    reach = F.least(last, F.floor((F.col("i") + halo) / chunk).cast("int"))
    return rows.withColumn("chunk", F.explode(F.sequence(home, F.greatest(home, reach))))


def _starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for c in keys:
        codes = pc.dictionary_encode(t.column(c).combine_chunks(), null_encoding="encode")
        codes = codes.indices.to_numpy() if isinstance(codes, pa.DictionaryArray) else codes.combine_chunks().indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def by_chunk(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of one chunk each out of batches in the order of the keys; only the open chunk is kept."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        at = _starts(held, keys)
        for a, z in zip(at[:-1], at[1:]):
            yield held.slice(a, z - a).combine_chunks()
        held = held.slice(at[-1]) if len(at) else held
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def map_chunks(rows: DataFrame, source: list[str], work: Callable[[pa.Table], pa.Table], schema: T.StructType) -> DataFrame:
    """work over each chunk's rows in order; one shuffle."""
    keys = [*source, "chunk"]
    names = schema.fieldNames()

    def run(batches):
        for t in by_chunk(batches, keys):
            out = work(t)
            yield from out.select(names).to_batches()

    return rows.repartition(*(F.col(c) for c in keys)).sortWithinPartitions(*keys, "i").mapInArrow(run, schema)


def _np(t: pa.Table, c: str) -> np.ndarray:
    return t.column(c).to_numpy().astype(float)


def window_moments(x: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, population deviation) of the w values up to each place; NaN where one is missing. A constant window has deviation 0."""
    n = len(x)
    ok = np.isfinite(x)
    shift = x[ok].mean() if ok.any() else 0.0
    y = np.where(ok, x - shift, 0.0)
    lead = np.zeros(1)
    s1, s2, c = (np.concatenate([lead, np.cumsum(v)]) for v in (y, y * y, ok.astype(float)))
    mean, std = np.full(n, np.nan), np.full(n, np.nan)
    if n >= w:
        full = c[w:] - c[:-w] == w
        m = (s1[w:] - s1[:-w]) / w
        v = np.sqrt(np.maximum((s2[w:] - s2[:-w]) / w - m * m, 0))
        turns = np.concatenate([lead, np.cumsum(np.concatenate([lead, (x[1:] != x[:-1]).astype(float)]))])
        same = turns[w:] - turns[1 : n - w + 2] == 0
        mean[w - 1 :] = np.where(full, m + shift, np.nan)
        std[w - 1 :] = np.where(full, np.where(same, 0.0, v), np.nan)
    return mean, std


def window_zscore(x: np.ndarray, w: int) -> np.ndarray:
    mean, std = window_moments(x, w)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = (x - mean) / std
    return np.where(std > 0, z, np.nan)


def window_quantile(x: np.ndarray, w: int, least: int, q: float) -> np.ndarray:
    """The q-quantile (linear) of the present values among the w up to each place; NaN below ``least`` of them."""
    m = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(w - 1, np.nan), x]), w)
    out = np.empty(len(x))
    for lo in range(0, len(x), 1024):
        part = np.sort(m[lo : lo + 1024], axis=1)  # missing values last
        have = np.isfinite(part).sum(1)
        pos = q * np.maximum(have - 1, 0)
        at = np.floor(pos).astype(int)
        rows = np.arange(len(part))
        a, b = part[rows, at], part[rows, np.minimum(at + 1, w - 1)]
        frac = pos - at
        out[lo : lo + 1024] = np.where(have >= least, np.where(frac > 0, a + (b - a) * frac, a), np.nan)
    return out


def _lagged(x: np.ndarray, k: int) -> np.ndarray:
    return x - np.concatenate([np.full(min(k, len(x)), np.nan), x[: max(len(x) - k, 0)]])


def _home(t: pa.Table, chunk: int) -> np.ndarray:
    return t.column("i").to_numpy() // chunk == t.column("chunk").to_numpy()


def _with(t: pa.Table, home: np.ndarray, new: dict[str, np.ndarray]) -> pa.Table:
    out = t.filter(pa.array(home))
    for c, v in new.items():
        out = out.append_column(c, pa.array(v[home], from_pandas=True))
    return out


def _added(df: DataFrame, new: Iterable[str]) -> T.StructType:
    return T.StructType([*(f for f in df.schema if f.name != "chunk"), *(T.StructField(c, T.DoubleType()) for c in new)])


SIZED = ("log_return", "ret_5d", "ret_20d", "vol_5d", "vol_20d", "log_volume_norm", "volume_change")
DOWNSIDE, LEAST = 120, 30


def sized_windows(rows: DataFrame, source: list[str], zscores: tuple[str, ...] = (), chunk: int = CHUNK) -> DataFrame:
    """rows (source..., i, n, bars, close, volume, ...) with the columns SIZED, whose windows are days of ``bars`` rows.

    Columns named in ``zscores`` are replaced by their z-scores over the window of log_volume_norm.
    """
    wide = chunked(rows, F.greatest(F.col("bars") * 20, F.lit(35)) + 1, chunk)

    def work(t: pa.Table) -> pa.Table:
        k = int(t.column("bars")[0].as_py())
        z = max(20 * k, 35)
        price, volume = np.log(_np(t, "close")), np.log1p(_np(t, "volume"))
        r = _lagged(price, 1)
        new = {
            "log_return": r,
            "ret_5d": _lagged(price, 5 * k),
            "ret_20d": _lagged(price, 20 * k),
            "vol_5d": window_moments(r, 5 * k)[1],
            "vol_20d": window_moments(r, 20 * k)[1],
            "log_volume_norm": window_zscore(volume, z),
            "volume_change": window_zscore(_lagged(volume, 1), 20 * k),
        }
        home = _home(t, chunk)
        out = _with(t, home, new)
        for c in zscores:
            out = out.set_column(out.schema.get_field_index(c), c, pa.array(window_zscore(_np(t, c), z)[home], from_pandas=True))
        return out

    return map_chunks(wide, source, work, _added(wide, SIZED))


def downside(rows: DataFrame, source: list[str], width: int = DOWNSIDE, least: int = LEAST, q: float = 0.1, chunk: int = CHUNK) -> DataFrame:
    """rows (source..., i, n, close, ...) with fall_probability (a bar without a return counts as not falling) and fall_q10."""
    wide = chunked(rows, F.lit(width + 1), chunk)

    def work(t: pa.Table) -> pa.Table:
        r = _lagged(np.log(_np(t, "close")), 1)
        i = t.column("i").to_numpy()
        falls = np.concatenate([[0.0], np.cumsum(r < 0)])
        n = np.minimum(i + 1, width)
        at = np.arange(1, len(r) + 1)
        share = (falls[at] - falls[np.maximum(at - width, 0)]) / n
        new = {"fall_probability": np.where(n >= least, share, np.nan), "fall_q10": window_quantile(r, width, least, q)}
        return _with(t, _home(t, chunk), new)

    return map_chunks(wide, source, work, _added(wide, ("fall_probability", "fall_q10")))


# States of the recursions: mean gain, mean loss, fast and slow mean of the log price, mean of their difference.
STATE = ("s_gain", "s_loss", "s_fast", "s_slow", "s_signal")


def _step(length: float, fast: int, slow: int, signal: int) -> tuple[np.ndarray, np.ndarray]:
    """(M, B): a bar takes state s and inputs u = (gain, loss, log price) to M s + B u."""
    w, a, b, g = 1.0 / length, *(2.0 / (span + 1) for span in (fast, slow, signal))
    m = np.diag([1 - w, 1 - w, 1 - a, 1 - b, 1 - g])
    m[4, 2:4] = g * (1 - a), -g * (1 - b)
    u = np.zeros((5, 3))
    u[0, 0] = u[1, 1] = w
    u[2, 2], u[3, 2], u[4, 2] = a, b, g * (a - b)
    return m, u


def _scan(decay: float, x: np.ndarray, start: float) -> np.ndarray:
    """y[t] = decay * y[t-1] + x[t] from y[-1] = start, in blocks short enough for powers of decay to stay exact."""
    out, block = np.empty(len(x)), max(1, min(len(x), int(-60 / np.log(decay)) if 0 < decay < 1 else 1))
    for lo in range(0, len(x), block):
        part = x[lo : lo + block]
        p = decay ** np.arange(1, len(part) + 1)
        out[lo : lo + block] = y = p * (start + np.cumsum(part / p))
        start = y[-1]
    return out


def _recursion(inputs: np.ndarray, start: np.ndarray, m: np.ndarray, u: np.ndarray) -> np.ndarray:
    """All states after each bar."""
    driven = inputs @ u.T
    s = np.empty((len(inputs), 5))
    for j in range(4):
        s[:, j] = _scan(m[j, j], driven[:, j], start[j])
    before = np.concatenate([start[None, 2:4], s[:-1, 2:4]])
    s[:, 4] = _scan(m[4, 4], driven[:, 4] + before @ m[4, 2:4], start[4])
    return s


def exponential_means(rows: DataFrame, source: list[str], fast: int = 12, slow: int = 26, signal: int = 9, chunk: int = CHUNK, settle=lambda df, name: df) -> DataFrame:
    """rows (source..., i, n, close, rsi_length, ...) with avg_gain, avg_loss and macd_hist.

    Means are recursive from a source's first value (gains from its second); gains and losses are
    null until ``rsi_length`` of them have come. ``settle`` may write the chunks, which are read twice.
    """
    wide = settle(chunked(rows, F.lit(1), chunk), "chunks")
    plan = (fast, slow, signal)

    def prepared(t: pa.Table):
        price, i = _np(t, "close"), t.column("i").to_numpy()
        move = np.diff(price, prepend=np.nan)
        inputs = np.column_stack([np.maximum(move, 0), np.maximum(-move, 0), np.log(price)])
        home = _home(t, chunk)
        return inputs[home], i[home], home, _step(float(t.column("rsi_length")[0].as_py()), *plan)

    def true_start(inputs, i, m, u):
        """The state before the first bar of a source, such that its first price and its first move are taken whole."""
        x = inputs[0, 2]
        first = np.zeros(5)
        first[2:4] = x
        if len(inputs) > 1:
            first[0], first[1] = inputs[1, 0], inputs[1, 1]
        return first

    def states_of(inputs, i, start, m, u):
        if i[0] == 0:
            start, inputs = true_start(inputs, i, m, u), inputs.copy()
            inputs[0, :2] = start[:2]  # the first bar has no move: it leaves the state to the second
        return _recursion(inputs, start, m, u)

    def summary(t: pa.Table) -> pa.Table:
        inputs, i, home, (m, u) = prepared(t)
        end = states_of(inputs, i, np.zeros(5), m, u)[-1]
        head = t.select([*source, "chunk", "rsi_length"]).slice(0, 1)
        head = head.append_column("rows", pa.array([len(i)], pa.int64()))
        for c, v in zip(STATE, end):
            head = head.append_column(c, pa.array([v], pa.float64()))
        return head

    doubles = [T.StructField(c, T.DoubleType()) for c in STATE]
    kept = [wide.schema[c] for c in (*source, "chunk", "rsi_length")]
    ends = map_chunks(wide, source, summary, T.StructType([*kept, T.StructField("rows", T.LongType()), *doubles]))

    def compose(t: pa.Table) -> pa.Table:
        """The true state at the beginning of each chunk of a source: one row per CHUNK bars."""
        t = t.sort_by("chunk")
        own = np.column_stack([_np(t, c) for c in STATE])
        size = t.column("rows").to_numpy()
        m, _ = _step(float(t.column("rsi_length")[0].as_py()), *plan)
        start = np.zeros_like(own)
        now = own[0]
        for j in range(1, len(own)):
            start[j] = now
            now = np.linalg.matrix_power(m, int(size[j])) @ now + own[j]
        out = t.select([*source, "chunk"])
        for c, v in zip(STATE, start.T):
            out = out.append_column(c, pa.array(v))
        return out

    starts = ends.groupBy(*source).applyInArrow(compose, T.StructType([*kept[:-1], *doubles]))

    def work(t: pa.Table) -> pa.Table:
        inputs, i, home, (m, u) = prepared(t)
        start = np.array([t.column(c)[0].as_py() for c in STATE])
        s = states_of(inputs, i, start, m, u)
        n = t.column("rsi_length")[0].as_py()
        known = i >= n
        full = {c: np.full(t.num_rows, np.nan) for c in ("avg_gain", "avg_loss", "macd_hist")}
        full["avg_gain"][home], full["avg_loss"][home] = np.where(known, s[:, 0], np.nan), np.where(known, s[:, 1], np.nan)
        full["macd_hist"][home] = s[:, 2] - s[:, 3] - s[:, 4]
        return _with(t.drop_columns(list(STATE)), home, full)

    on = [F.col(f"w.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*source, "chunk")]
    joined = wide.alias("w").join(starts.alias("s"), on).select("w.*", *(F.col(f"s.{c}") for c in STATE))
    return map_chunks(joined, source, work, _added(wide, ("avg_gain", "avg_loss", "macd_hist")))
