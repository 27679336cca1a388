import datetime as dt
import pickle
import random
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators import asof, eav, known_at, rolling
from marketloom.session import work_dir, written

T0 = dt.datetime(2024, 1, 1)


def test_as_known_equals_brute_force_and_never_looks_ahead(spark):
    r = random.Random(3)
    obs = [("ab"[r.random() < 0.4], dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(60)), r.choice([0.1, None, float("nan"), -0.2]), T0 + dt.timedelta(seconds=r.randrange(60 * 86400)), i) for i in range(200)]
    obs += [("a", dt.date(2024, 1, 5), 0.3, T0 + dt.timedelta(days=9), 900 + i) for i in range(3)] + [("a", dt.date(2024, 1, 6), 0.3, None, 950)]
    events = [(i, T0 + dt.timedelta(seconds=r.randrange(-86400, 90 * 86400))) for i in range(300)] + [(1000, obs[5][3]), (1001, None), (1002, dt.datetime(2300, 1, 1)), (1003, dt.datetime(1850, 1, 1))]
    o = spark.createDataFrame(obs, "series string, day date, v double, known_at timestamp, obs_id long")
    e = spark.createDataFrame([(*x, "clash") for x in events], "event_id long, at timestamp, node string")
    iv = known_at.validity_intervals(o, ["series"], "known_at", ["day", "known_at", "obs_id"], "v")
    answer = lambda n: {(x["event_id"], x["series"]): x["version"]["obs_id"] for x in known_at.as_known(e, "event_id", "at", iv, ["series"], broadcast_intervals=n).collect()}
    got = answer(20_000)
    assert answer(0) == got
    want = {}
    for i, at in events:
        for s in "ab":
            c = [(d, k, n) for z, d, v, k, n in obs if z == s and v is not None and v == v and k is not None and at is not None and k <= at]
            if c:
                want[i, s] = max(c)[2]
    assert got == want
    lone = lambda n: sorted((x["event_id"], x["series"], x["version"]["obs_id"]) for x in known_at.as_known(e, "event_id", "at", iv, ["series"], broadcast_intervals=n, disjoint=True).collect())
    assert lone(0) == lone(20_000) == sorted((*k, v) for k, v in want.items())
    line = known_at.timeline(iv, "series", ["a", "b", "never"])
    twice = e.unionByName(e)
    for n in (0, 20_000):
        rows = known_at.attach(twice, "at", line, ["a", "b", "never"], broadcast_intervals=n).collect()
        assert len(rows) == 2 * e.count() and {x["node"] for x in rows} == {"clash"}
        assert all(x["never"] is None and (x[s]["obs_id"] if x[s] else None) == want.get((x["event_id"], s)) for x in rows for s in "ab")
    assert known_at.attach(e.limit(0), "at", line, ["a"]).collect() == []
    assert len(known_at.attach(e, "at", known_at.timeline(iv.limit(0), "series", ["a"]), ["a"]).collect()) == e.count()
    assert known_at.as_known(e.limit(0), "event_id", "at", iv, ["series"]).collect() == []
    assert known_at.as_known(e, "event_id", "at", iv.limit(0), ["series"]).collect() == []


def test_asof_backward(spark):
    left = spark.createDataFrame([("x", 1), ("x", 5), ("x", None), ("y", 9)], "k string, t long")
    right = spark.createDataFrame([("x", 1, 1.0), ("x", 4, None), ("x", 6, 3.0)], "k string, rt long, v double")
    got = {(r.k, r.t): r.v for r in asof.backward(left, right, "t", "rt", ["k"], ["v"], default=0.0).collect()}
    assert got == {("x", 1): 1.0, ("x", 5): 1.0, ("x", None): 0.0, ("y", 9): 0.0}
    strict = {(r.k, r.t): r.v for r in asof.backward(left, right, "t", "rt", ["k"], ["v"], strict=True).collect()}
    assert strict["x", 1] is None


def test_asof_backward_across_stretches(spark):
    r = random.Random(8)
    left = [(r.choice(["x", "y", None]), r.choice([None, *range(100)]), i) for i in range(300)]
    right = [(k, t, r.choice([None, float(t)])) for k in ("x", None) for t in r.sample(range(-40, 100), 40)]
    l, rt = spark.createDataFrame(left, "k string, t long, id long"), spark.createDataFrame(right, "k string, rt long, v double")
    for strict in (False, True):
        want = {}
        for k, t, i in left:
            c = [(a, v) for j, a, v in right if j == k and v is not None and t is not None and (a < t or (a == t and not strict))]
            want[i] = max(c)[1] if c else None
        for width in (7, 1000):
            assert {x["id"]: x["v"] for x in asof.backward(l, rt, "t", "rt", ["k"], ["v"], strict=strict, width=width).collect()} == want
    assert asof.backward(l.limit(0), rt, "t", "rt", ["k"], ["v"]).collect() == []
    assert {x["v"] for x in asof.backward(l, rt.limit(0), "t", "rt", ["k"], ["v"]).collect()} == {None}


SCHEMA = "symbol string, feed_id long, ts timestamp, m double, ingested_at timestamp, load_seq long, day string"


def readings(seed, n):
    r = random.Random(seed)
    out = []
    for i in range(n):
        out.append((r.choice(["a", "b", None]), 1, T0 + dt.timedelta(hours=r.randrange(24 * 50)), r.choice([0.000001, -0.5, 1.25, None, float("nan")]), T0 + dt.timedelta(days=r.randrange(100)), i, "clash"))
    return out + [("a", 1, None, 3.0, T0, 10**6, "clash"), out[0]]


def by_day(rows):
    last = {}
    for s, f, t, m, at, seq, _ in rows:
        if t is not None and (k := (s, f, t)) and (k not in last or (at, seq) > last[k][0]):
            last[k] = ((at, seq), m)
    days = defaultdict(list)
    for (s, f, t), (_, m) in last.items():
        days[s, f, (t.date() - dt.date(1970, 1, 1)).days].append(m)
    return {k: (sum(x is not None and abs(x) < 9e12 for x in v), sum(round(x * 1e6) for x in v if x is not None and abs(x) < 9e12)) for k, v in days.items()}


def brute_roll(days):
    out = {}
    for s, f in {k[:2] for k in days}:
        mine = {d: v for (a, b, d), v in days.items() if (a, b) == (s, f)}
        for d in range(min(mine), max(mine) + 1):
            w = lambda k: [sum(mine.get(x, (0, 0))[j] for x in range(d - k + 1, d + 1)) for j in (0, 1)]  # noqa: E731, B023
            out[s, f, d] = (*w(7), *w(30))
    return out


SRC = T.StructType().add("symbol", "string").add("feed_id", "long")


def state_of(df):
    return {(r["symbol"], r["feed_id"], r["day"]): (r["n_m_7"], r["s_m_7"], r["n_m_30"], r["s_m_30"]) for r in df.collect()}


def fresh_state(spark):
    return rolling.DailyState(spark, work_dir(spark, "rolling"), SRC, ["m"])


def test_rolling_state_and_corrections(spark):
    loads = [readings(1, 300), readings(2, 12), [("c", 1, T0 + dt.timedelta(days=400), 1.0, T0, 1, ""), ("a", 1, T0 + dt.timedelta(days=160), 2.0, T0, 2, ""), ("b", 1, T0 - dt.timedelta(days=50), 2.0, T0, 3, "")], [("c", 1, T0 + dt.timedelta(days=390), float("inf"), T0, 4, "")]]
    loads = [[(*x[:5], x[5] + 5000 * i, x[6]) for x in rows] for i, rows in enumerate(loads)]
    state, seen, versions = fresh_state(spark), [], {}
    for i, rows in enumerate(loads):
        seen += rows
        now = by_day(seen)
        touched = {(s, f, (t.date() - dt.date(1970, 1, 1)).days) for s, f, t, *_ in rows if t is not None}
        amounts = rolling.daily_amounts(spark.createDataFrame(seen, SCHEMA), SRC.fieldNames(), "ts", ["m"])
        changed = amounts.join(spark.createDataFrame(list(touched), "s string, f long, d int"), F.expr("symbol <=> s AND feed_id <=> f AND day = d"), "left_semi")
        assert state.advance(written(changed, "changed")) == i + 1
        want = brute_roll(now)
        got = state.current().collect()
        assert state_of(state.current()) == want
        # only dates whose windows hold a changed day, and new dates, are written again
        hit = {k for k in want if k not in versions or any(k[:2] == x[:2] and 0 <= k[2] - x[2] < 30 for x in touched)}
        assert {(r["symbol"], r["feed_id"], r["day"]) for r in got if r["version"] == i + 1} == hit
        assert i == 0 or len(hit) < len(want)
        versions = {(r["symbol"], r["feed_id"], r["day"]): r["version"] for r in got}
    assert sum(r["n_m_7"] for r in got if r["symbol"] == "c") == 7 - 6  # an infinite reading is none


def test_loads_cut_by_loading_time_end_in_the_same_state(spark):
    rows = readings(5, 400) + [("a", 1, T0 + dt.timedelta(days=3), 9.0, None, 7_000, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    cuts = rolling.load_bounds(df, "ingested_at", 5)
    assert len(cuts) == 4 and rolling.load_bounds(df.limit(0), "ingested_at", 5) == []
    # one row has no loading time: it is the oldest
    want = brute_roll(by_day([(*r[:4], r[4] or dt.datetime.min, *r[5:]) for r in rows]))
    for bounds in (cuts, []):
        state = rolling.maintain(fresh_state(spark), df, "ts", "ingested_at", bounds, written)
        assert state.version == len(bounds) + 1
        assert state_of(state.current()) == want
    empty = rolling.maintain(fresh_state(spark), df.limit(0), "ts", "ingested_at", [], written)
    assert empty.current().collect() == []


def facts(spark, rows):
    return spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], "load_seq long, symbol string, financial_period string, table_name string, metric_label string, metric_text string, ingested_at timestamp, metric string")


def test_cells_and_wide_rows(spark):
    t1, t2 = T0, T0 + dt.timedelta(days=1)
    rows = [
        ("AB", "Mar 2022", "ratios", "ROE %", "12.5%", t1),
        ("AB", "mar-22", "ratios", "ROE  +", "(1,234.5)", t2),
        ("AB", "2022-03", "ratios", "ROE %", "restated", t2 + dt.timedelta(days=1)),
        ("ab ", "March 2022", "ratios", "Debtor Days", "−7", t1),
        ("AB", "March 2022", "ratios", "Debtor Days", "8", None),
        ("AB", "TTM", "ratios", "Net NPA %", "+1.005", t1),
        ("AB", "ttm", "ratios", "Net NPA %", "+1.005", t1),
        ("AB", "Particulars", "ratios", "ROE %", "3", t1),
        ("AB", None, "ratios", "ROE %", "3", t1),
        (None, "TTM", "ratios", "ROE %", "3", t1),
        ("AB", "TTM", "ratios", None, "3", t1),
        ("AB", "TTM", "ratios", "ROE %", None, t1),
        ("AB", "TTM", "ratios", "ROE %", "9" * 60_000, t1),
        ("AB", "TTM", None, "Sales", "5", t1),
    ]
    got = {tuple(r) for r in eav.filled_cells(facts(spark, rows)).collect()}
    assert got == {("ratios", "AB", "Mar 2022", "roe", -123450), ("ratios", "AB", "Mar 2022", "debtor_days", -700), ("ratios", "AB", "TTM", "net_npa", 101), (None, "AB", "TTM", "sales", 500)}
    f = facts(spark, rows)
    w = {(r["table_name"], r["financial_period"]): r.asDict() for r in eav.wide(f).collect()}
    assert w["ratios", "Mar 2022"]["roe"] == -1234.5 and w["ratios", "Mar 2022"]["net_npa"] is None
    assert eav.filled_cells(f.limit(0)).collect() == []


def test_registers_merge_in_any_order():
    r = random.Random(5)
    cells = [(r.choice("xyz"), r.choice(["p", None]), r.choice("mno"), r.randrange(3), r.randrange(3), r.randrange(9)) for _ in range(300)]
    want = {}
    for s, p, slot, *v in cells:
        reg = want.setdefault((s, p), {})
        reg[slot] = max(reg.get(slot, tuple(v)), tuple(v))
    names = ["s", "p", "slot", "at", "seq", "v"]
    first = eav._batch_registers(["s", "p"], "slot", ["at", "seq", "v"], nullable=("p",))
    for _ in range(20):
        r.shuffle(cells)
        got, at = {}, 0
        while at < len(cells):
            n = r.randrange(1, 120)
            batch = pa.RecordBatch.from_pylist([dict(zip(names, c)) for c in cells[at : at + n]], schema=pa.schema([("s", pa.string()), ("p", pa.string()), ("slot", pa.string()), *((c, pa.int64()) for c in names[3:])]))
            for out in first([batch]):
                for x in out.to_pylist():
                    reg = pickle.loads(x["register"])
                    got[x["s"], x["p"]] = eav._merge(got[x["s"], x["p"]], reg) if (x["s"], x["p"]) in got else reg
            at += n
        assert got == want
