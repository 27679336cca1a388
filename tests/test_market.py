import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__
from marketloom.functions import market as m
from marketloom.operators import forecast, gap_model, lake, series
from marketloom.sources import nav_text, pages

COMPANY = """<section id="quarters"><table><tr><th></th><th>Mar 2024</th><th>Notes</th><th>TTM</th></tr>
<tr><td>Sales +</td><td>1,234</td><td>x</td><td>—</td></tr><tr><td>OPM %</td><td>12%</td></tr>
<tr><td>Raw PDF</td><td>1</td><td>2</td><td>3</td></tr></table></section>
<section id="shareholding"><table><tr><th></th><th>Jun 2024</th></tr><tr><td>Promoters</td><td>51.5%</td></tr></table>
<table><tr><th></th><th>Mar 2023</th></tr><tr><td>Public<td>48.5%</table></section>"""
NEWS = """<div class="eachStory"><h3>Up</h3><div class="secCategory">News</div><a href="/a/articleshow/1.cms">x</a><p>body</p><time>1 Jan</time></div>
<div class="eachStory"><h3></h3><a href="/b">x</a></div><div class="eachStory"><h3>Ad</h3><div class="secCategory">Video</div></div>
<div class="eachStory"><h3>No link</h3><p>b2</p></div>"""


def test_company_pages(spark):
    df = spark.createDataFrame([("ab", True, COMPANY), ("zz", True, "<html></html>"), ("zz", False, COMPANY), ("none", True, None)], "symbol string, consolidated boolean, html string")
    got = {(r.symbol, r.table_name, r.financial_period, r.metric): r.value for r in pages.fundamentals(df).collect()}
    for s in ("AB", "ZZ"):
        assert got[s, "quarterly_results", "Mar 2024", "sales"] == 1234.0
        assert got[s, "quarterly_results", "TTM", "sales"] is None  # the junk header doesn't shift it
        assert got[s, "shareholding_yearly", "Mar 2023", "public_pct"] == 48.5
    assert not any("raw" in k[3] for k in got) and not any(k[0] == "NONE" for k in got)


def test_stories_and_companies(spark):
    df = spark.createDataFrame([("https://e.org/n", "A", NEWS), ("https://e.org/n", "B", NEWS)], "page_url string, company_name string, html string")
    got = {r.url: r for r in pages.stories(df).collect()}
    assert set(got) == {"https://e.org/a/articleshow/1.cms", "https://e.org/n"}
    assert got["https://e.org/a/articleshow/1.cms"].companies == ["A", "B"]
    idx = '<a href="/x/stocks/companyid-7.cms">Foo  Ltd Share Price</a>'
    c = pages.companies(spark.createDataFrame([(1, "https://e.org", idx), (2, "https://e.org", idx)], "page_no int, page_url string, html string")).collect()
    assert [(r.company_id, r.company_name) for r in c] == [("7", "Foo Ltd")]


def test_captured_pages_source(spark, tmp_path):
    (tmp_path / "a.html").write_text(COMPANY)
    (tmp_path / "b.txt").write_text("no")
    spark.dataSource.register(pages.CapturedPages)
    got = spark.read.format("captured_pages").load(str(tmp_path)).collect()
    assert [r.name for r in got] == ["a.html"] and got[0].html == COMPANY


def test_nav_sources(spark, tmp_path):
    (tmp_path / "nav.txt").write_text("Open Ended Schemes\nScheme Code;ISIN;ISIN2;Name;Net Asset Value;Date\n101;-;INF2;A; B - Growth;10.5;03-Jul-2023\n102;INF1;-;C;N.A.;03-Jul-2023\n103;INF1;-;C;nan;2023-07-03\n104;INF1;-;C;7;2023/07/03\n")
    assert [tuple(r)[:5] for r in nav_text.read_daily(spark, str(tmp_path / "nav.txt")).collect()] == [(101, "INF2", "A; B - Growth", 10.5, "2023-07-03")]
    doc = {"status": "SUCCESS", "meta": {"scheme_code": 5, "scheme_name": "S", "isin_growth": "", "isin_div_reinvestment": "INF9"}, "data": [{"date": "01-01-2024", "nav": "1.5"}, {"date": "bad", "nav": "x"}]}
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "a.json").write_text(json.dumps(doc))
    (tmp_path / "h" / "b.json").write_text(json.dumps(doc | {"status": "FAIL"}))
    assert [(r.scheme_code, r.nav_date, r.isin, r.nav) for r in nav_text.read_history(spark, str(tmp_path / "h")).collect()] == [(5, "2024-01-01", "INF9", 1.5)]


def test_ridge_chooses_by_true_leave_one_out():
    r = np.random.default_rng(0)
    x = np.column_stack([r.normal(size=(60, 3)), np.zeros(60)])
    y = x[:, 0] * 2 + r.normal(size=60)
    _, _, alpha = gap_model.fit_ridge(x, y)
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)

    def loo(a):
        e = 0.0
        for i in range(60):
            k = np.arange(60) != i
            one = np.column_stack([np.ones(59), z[k]])
            w = np.linalg.solve(one.T @ one + a * np.diag([0, 1, 1, 1, 1]), one.T @ y[k])
            e += (y[i] - w[0] - z[i] @ w[1:]) ** 2
        return e

    assert alpha == min(gap_model.ALPHAS, key=loo)


def test_labels_are_strict_and_antisymmetric(spark):
    v = [0.005, -0.005, 0.0051, -0.0051, 0.0, None]
    df = spark.createDataFrame([(x,) for x in v], "x double")
    assert [r[0] for r in df.select(m.label(F.col("x"), 0.005)).collect()] == ["HOLD", "HOLD", "BUY", "SELL", "HOLD", None]


def test_first_step_takes_the_gap_and_signals_ignore_it(spark):
    p = spark.createDataFrame([("a", h, 0.001, 0.5, 100.0) for h in range(1, 25)], "s string, horizon int, predicted_log_return double, g double, origin_price double")
    r = forecast.reconstruct(forecast.with_gap(p, "g"), ["s"])
    s = forecast.signals(r, ["s"]).first()
    assert abs(s.path_return - 0.023) < 1e-9 and s.signal == "BUY" and s.flat_steps == 23


SPEC = lake.TableSpec("t", T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("w", T.StringType())]), ["k"], "merge")


def test_merge_is_idempotent_full_row_or_partial(spark, tmp_path):
    store = lake.Lake(spark, str(tmp_path / "lake"))
    rows = lambda x: spark.createDataFrame(x, "k long, v double, w string, seq long")
    store.write(SPEC, rows([(1, 1.0, "a", 1), (1, 2.0, "b", 2), (None, 5.0, "n", 1)]), ["seq"])
    now = lambda: sorted((tuple(r) for r in store.read(SPEC).collect()), key=str)
    first = now()
    assert first == sorted([(1, 2.0, "b"), (None, 5.0, "n")], key=str)
    store.write(SPEC, rows([(1, 1.0, "a", 1), (1, 2.0, "b", 2), (None, 5.0, "n", 1)]), ["seq"])
    assert now() == first
    store.write(SPEC, rows([(1, None, "c", 3), (2, float("inf"), "d", 3)]), ["seq"], partial=True)
    assert (1, 2.0, "c") in now() and (2, None, "d") in now()
    store.write(SPEC, rows([(1, None, "e", 4)]), ["seq"])
    assert (1, None, "e") in now()
    assert store.version(SPEC) == 4
    with pytest.raises(ValueError):
        store.write(SPEC, rows([]), ["seq"], allow_empty=False)


def test_csv_upsert_keeps_the_last_of_a_second(spark, tmp_path):
    t = dt.datetime(2024, 1, 1, 9, 15)
    rows = lambda x: spark.createDataFrame(x, "symbol string, timestamp timestamp, close double, seq long")
    lake.upsert_csv(spark, None, rows([("a", t, 1.0, 2), ("a", t, 0.5, 1), ("b", t, 2.0, 3), ("b", None, 2.0, 4)]), str(tmp_path / "one"), ["seq"])
    got = lake.upsert_csv(spark, str(tmp_path / "one"), rows([("a", t + dt.timedelta(milliseconds=300), 3.0, 1)]), str(tmp_path / "two"), ["seq"])
    assert [(r.symbol, r.close) for r in got.collect()] == [("a", 3.0), ("b", 2.0)]


def test_a_crash_at_publishing_loses_nothing(spark, tmp_path, monkeypatch):
    store = lake.Lake(spark, str(tmp_path / "lake"))
    rows = lambda n: spark.createDataFrame([(i, 1.0, "x", 1) for i in n], "k long, v double, w string, seq long")
    store.write(SPEC, rows(range(10)), ["seq"])
    real = lake.Lake._publish

    def crash(self, *a):
        raise OSError("lost the connection")

    monkeypatch.setattr(lake.Lake, "_publish", crash)
    with pytest.raises(OSError):
        store.write(SPEC, rows([99]), ["seq"])
    monkeypatch.setattr(lake.Lake, "_publish", real)
    assert store.version(SPEC) == 1 and store.read(SPEC).count() == 10
    # a crash between the file and its rename leaves a hidden part
    (tmp_path / "lake" / "t" / "_versions" / ".0123").write_text("{}")
    store.write(SPEC, rows([99]), ["seq"])
    assert store.version(SPEC) == 2 and store.read(SPEC).count() == 11 and store.read(SPEC, 1).count() == 10
    with pytest.raises(RuntimeError):
        store._publish(SPEC, 2, [])


def test_append_writes_new_rows_only_and_compaction_drops_orphans(spark, tmp_path):
    store = lake.Lake(spark, str(tmp_path / "lake"))
    wide = lake.TableSpec("a", T.StructType().add("k", "long").add("v", "double").add("old", "string"), disposition="append")
    slim = lake.TableSpec("a", T.StructType().add("k", "long").add("v", "double").add("fresh", "string"), disposition="append")
    store.write(wide, spark.createDataFrame([(1, 1.0, "x")], "k long, v double, old string"))
    first = store.folders(wide)
    store.write(slim, spark.createDataFrame([(2, float("nan"), "y")], "k long, v double, fresh string"))
    assert store.folders(slim)[0] == first[0] and len(store.folders(slim)) == 2
    want = [(1, 1.0, None), (2, None, "y")]
    assert sorted(tuple(r) for r in store.read(slim).collect()) == want
    assert store.compact(slim) == ["old"]
    assert store.columns(slim) == ["k", "v", "fresh"] and len(store.folders(slim)) == 1
    assert sorted(tuple(r) for r in store.read(slim).collect()) == want
    assert store.compact(slim) == [] and store.version(slim) == 3


def test_entry_points_agree():
    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q) and {f"p{n}_found" for n in (1, 2, 3, 4, 5, 6)} <= set(q)


def test_sessions_come_from_their_days_ends(spark):
    """Bar by bar against a plain walk: masks, hours, gaps that carry over a zero gap, daily returns."""
    r = np.random.default_rng(2)
    rows = []
    for s in ("a", None):
        price, t = 100.0, dt.datetime(2024, 1, 1, 4)
        for day in range(12):
            for h in range(1 + day % 3):
                o = price if (h == 0 and day in (4, 5)) else price * float(np.exp(r.normal(0, 0.01)))
                price = o * float(np.exp(r.normal(0, 0.01)))
                rows.append((s, 1, t + dt.timedelta(days=day * (3 if day == 7 else 1), hours=h), o, price))
    df = spark.createDataFrame(rows, "symbol string, feed_id long, ts timestamp, open double, close double")
    got = {(x.symbol, x.ts): x for x in series.session_gaps(df).collect()}
    assert len(got) == len(rows)
    for s in ("a", None):
        mine = sorted((x for x in rows if x[0] == s), key=lambda x: x[2])
        pc = gap = last_gap = dr = last_dr = None
        for i, (_, _, ts, o, c) in enumerate(mine):
            day = lambda x: (x[2] + dt.timedelta(hours=5, minutes=30)).date()
            opens = i == 0 or day(mine[i - 1]) != day(mine[i])
            closes = i + 1 == len(mine) or day(mine[i + 1]) != day(mine[i])
            hours = (ts - mine[i - 1][2]).total_seconds() / 3600 if i else 1.0
            gap = (np.log(o / pc) if pc else None) if opens else 0.0
            x = got[s, ts]
            near = lambda p, q: (p is None) == (q is None) and (p is None or abs(p - q) < 1e-12)
            assert (x.is_open, x.is_close) == (opens, closes) and near(x.hours_since, hours) and near(x.gap, gap)
            assert near(x.last_gap, last_gap) and near(x.prev_day_return, last_dr) and x.is_weekend_gap == float(hours >= 40 and opens)
            if gap is not None and abs(gap) > 1e-15:
                last_gap = gap
            if closes:
                dr = np.log(c / pc) if pc else None
                last_dr = dr if dr is not None else last_dr
                pc = c
