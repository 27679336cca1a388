import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketloom.operators import chunks

T0 = dt.datetime(2024, 1, 1)


def bars(spark, sizes, seed=1):
    r, rows = random.Random(seed), []
    for s, n in sizes.items():
        x = 100.0
        for t in range(n):
            x *= math.exp(r.gauss(0, 0.01)) if t % 9 else 1.0
            v = 7.0 if 40 < t < 80 else float(r.randint(0, 900))
            rows.append((s, T0 + dt.timedelta(hours=t * (1 if s != "gappy" else 37)), x, v, {"a": 2, None: 3}.get(s, 1), "clash"))
    r.shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, ts timestamp, close double, volume double, bars int, s_gain string")


SIZES = {"a": 260, None: 130, "gappy": 150, "one": 1, "two": 2}


def sorted_frame(df):
    return df.toPandas().sort_values(["symbol", "ts"], na_position="first").reset_index(drop=True)


def test_ranks_count_across_periods(spark):
    got = chunks.ranked(bars(spark, SIZES), ["symbol"], days=3)
    for r in got.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("ts", "i", "n"))).alias("x")).collect():
        assert [y["i"] for y in r["x"]] == list(range(SIZES[r["symbol"]])) and {y["n"] for y in r["x"]} == {len(r["x"])}


@pytest.mark.parametrize("chunk", [4096, 60, 7])
def test_windows_equal_pandas_however_they_are_cut(spark, chunk):
    df = chunks.ranked(bars(spark, SIZES), ["symbol"]).withColumn("zed", F.col("close") * 2)
    got = sorted_frame(chunks.sized_windows(df, ["symbol"], zscores=("zed",), chunk=chunk))
    down = sorted_frame(chunks.downside(df, ["symbol"], width=20, least=5, chunk=chunk))
    assert len(got) == len(down) == sum(SIZES.values())
    for s in SIZES:
        mine = (got["symbol"].isna() if s is None else got["symbol"] == s)
        g, d = got[mine], down[mine]
        k = int(g["bars"].iloc[0])
        z = max(20 * k, 35)
        lc, lv = np.log(g["close"]), np.log1p(g["volume"])
        r = lc.diff()
        score = lambda x, w: (x - x.rolling(w).mean()) / x.rolling(w).std(ddof=0).where(lambda v: v > 1e-9)
        want = {"log_return": r, "ret_5d": lc.diff(5 * k), "ret_20d": lc.diff(20 * k), "vol_5d": r.rolling(5 * k).std(ddof=0), "vol_20d": r.rolling(20 * k).std(ddof=0), "log_volume_norm": score(lv, z), "volume_change": score(lv.diff(), 20 * k), "zed": score(g["close"] * 2, z)}
        for c, w in want.items():
            assert np.allclose(g[c], w, atol=1e-9, equal_nan=True), (s, c)
        assert np.allclose(d["fall_probability"], (r < 0).astype(float).rolling(20, min_periods=5).mean(), equal_nan=True)
        assert np.allclose(d["fall_q10"], r.rolling(20, min_periods=5).quantile(0.1), equal_nan=True)


@pytest.mark.parametrize("chunk", [4096, 50, 3])
def test_recursive_means_equal_one_pass_however_they_are_cut(spark, chunk):
    df = chunks.ranked(bars(spark, SIZES).withColumn("rsi_length", F.col("bars") * 14), ["symbol"]).drop("s_gain")
    got = sorted_frame(chunks.exponential_means(df, ["symbol"], chunk=chunk))
    assert len(got) == sum(SIZES.values())
    for s in SIZES:
        g = got[got["symbol"].isna() if s is None else got["symbol"] == s]
        n = int(g["rsi_length"].iloc[0])
        fast = slow = signal = None
        gain = loss = None
        for j, (x, row) in enumerate(zip(g["close"], g.itertuples())):
            y = math.log(x)
            fast = y if j == 0 else fast + (y - fast) * 2 / 13
            slow = y if j == 0 else slow + (y - slow) * 2 / 27
            signal = 0.0 if j == 0 else signal + (fast - slow - signal) * 2 / 10
            if j:
                up, down = max(x - prev, 0), max(prev - x, 0)
                gain = up if j == 1 else gain + (up - gain) / n
                loss = down if j == 1 else loss + (down - loss) / n
            prev = x
            assert abs(row.macd_hist - (fast - slow - signal)) < 1e-12
            if j >= n:
                assert abs(row.avg_gain - gain) < 1e-9 and abs(row.avg_loss - loss) < 1e-9
            else:
                assert pd.isna(row.avg_gain) and pd.isna(row.avg_loss)


def test_empty_tables_and_one_chunk_at_a_time(spark):
    df = chunks.ranked(bars(spark, {"a": 5}).limit(0), ["symbol"])
    assert chunks.sized_windows(df, ["symbol"]).collect() == [] and chunks.downside(df, ["symbol"]).collect() == []
    assert chunks.exponential_means(df.withColumn("rsi_length", F.lit(14)).drop("s_gain"), ["symbol"]).collect() == []
    import pyarrow as pa

    t = pa.table({"k": [None] * 3 + ["a"] * 4 + ["b"] * 2, "chunk": [0, 0, 1, 0, 0, 0, 1, 0, 0]})
    cut = [p.num_rows for p in chunks.by_chunk(t.to_batches(max_chunksize=2), ["k", "chunk"])]
    assert cut == [2, 1, 3, 1, 2]


def test_sliding_contexts_are_whole_however_they_are_cut(spark):
    from marketloom.operators import forecast
    from marketloom.operators.features import MODEL_COLUMNS

    df = chunks.ranked(bars(spark, SIZES), ["symbol"])
    f = df.select("symbol", "ts", "i", "n", *((F.col("i") + j).cast("double").alias(c) for j, c in enumerate(MODEL_COLUMNS)), (F.col("i") % 5 == 0).alias("mark"))
    seen = lambda w: np.stack([w[:, 0, 0], w[:, -1, 1], w.sum((1, 2))], 1)
    for chunk in (4096, 16, 7):
        for origins, keep in (("all", lambda i, n: True), ("last", lambda i, n: i == n - 1), ("mark", lambda i, n: i % 5 == 0)):
            got = {(r.symbol, round(r.returns[0])): r.returns for r in forecast.sliding(f, seen, 12, origins, ["symbol"], batch=3, chunk=chunk).collect()}
            want = {(s, i - 11) for s, n in SIZES.items() for i in range(11, n) if keep(i, n)}
            assert set(got) == want
            for (_, a), (first, last, total) in got.items():
                assert (first, last, total) == (a, a + 12, sum(a + t + j for t in range(12) for j in range(len(MODEL_COLUMNS))))
