import datetime as dt
import json

from marketloom.operators import drift


def files(spark, spec, extra=()):
    rows = [(1, "ratios", f, i, dt.datetime(2024, 1, f), json.dumps(r) if isinstance(r, dict) else r, "clash") for f, records in spec.items() for i, r in enumerate(records)]
    return spark.createDataFrame(rows + list(extra), "feed_id long, table_name string, file_no int, row_no int, received_at timestamp, payload string, kind string")


def found(df):
    _, k, renamed = drift.infer(df)
    return sorted(tuple(r)[1:] for r in drift.changes(k, renamed).collect())


def rows(sym="symbol", per="financial_period", load="ingested_at", period=lambda i: f"Mar 20{10 + i}", at="2024-01-01T00:00:00+00:00", **cols):
    return [{sym: f"X{'ABCDEFGH'[i] * 4}", per: period(i), load: at} | {c: f(i) for c, f in cols.items()} for i in range(6)]


def test_every_kind_of_change(spark):
    x, y = lambda i: 10.5 + i * 3, lambda i: 200.25 + i
    spec = {
        1: rows(sales=x, gone=y) + ['{"symbol": "XA', "", None, "[1]"],
        2: rows(sales=x, fresh=lambda i: f"note {i}"),
        3: rows(turnover=lambda i: f"{x(i):,.2f}" if i else None, fresh=lambda i: None),
        5: rows(per="period", period=lambda i: 201003 + 100 * i, load="loaded", at=1704067200, turnover=lambda i: [x(i)] if i else "n/a", fresh=lambda i: {"amount": 1.5, "unit": "cr"}),
    }
    assert found(files(spark, spec)) == sorted([
        (2, "removed", "gone", ""),
        (2, "added", "", "fresh"),
        (3, "renamed", "sales", "turnover"),
        (3, "retyped", "sales", "turnover"),
        (5, "renamed", "financial_period", "period"),
        (5, "retyped", "financial_period", "period"),
        (5, "renamed", "ingested_at", "loaded"),
        (5, "retyped", "ingested_at", "loaded"),
        (5, "retyped", "turnover", "turnover"),
        (5, "retyped", "fresh", "fresh"),
    ])


def test_repeated_records_and_other_figures_are_no_rename(spark):
    spec = {1: rows(a=lambda i: i + 0.5) * 2, 2: rows(b=lambda i: i * 7 + 0.25)}
    assert found(files(spark, spec)) == [(2, "added", "", "b"), (2, "removed", "a", "")]
    assert found(files(spark, spec).limit(0)) == []


def test_one_consistent_table_with_typed_branches(spark):
    spec = {1: rows(sales=lambda i: i + 0.5, note=lambda i: "audited"), 2: rows(sales=lambda i: f"{i + 0.5}", note=lambda i: "audited"), 3: rows(revenue=lambda i: i + 0.5, note=lambda i: 7)}
    f = files(spark, spec)
    t = drift.consistent_rows(f).collect()
    assert len(t) == 18
    assert all(r["figures"]["sales"] == float(r["row_no"]) + 0.5 for r in t)
    assert {r["financial_period"] for r in t} == {f"Mar 20{10 + i}" for i in range(6)}
    assert {(r["texts"] or {}).get("note") for r in t if r["file_no"] < 3} == {"audited"}
    u = {(r["field"], r["kind"]): r["first_file"] for r in drift.unions(f).collect()}
    assert u["sales", "number"] == 1 and u["sales", "text"] == 2 and u["note", "number"] == 3


def test_lists_objects_and_booleans_are_kept_whole(spark):
    spec = {1: rows(several=lambda i: [1.5, i], one=lambda i: [2.5], crore=lambda i: {"amount": 3.5, "unit": "cr"}, lakh=lambda i: {"amount": 4.5, "unit": "lakh"}, deep=lambda i: {"a": {"b": [i]}}, flag=lambda i: i > 2, gap=lambda i: [7, None])}
    t = drift.consistent_rows(files(spark, spec)).collect()
    assert len(t) == 6
    for r in t:
        i = r["row_no"]
        assert r["figures"] == {"one": 2.5, "crore": 3.5, "flag": float(i > 2)} and r["texts"] == {} and r["truths"] == {"flag": i > 2}
        assert {k: json.loads(v) for k, v in r["nested"].items()} == {"several": [1.5, i], "one": [2.5], "crore": {"amount": 3.5, "unit": "cr"}, "lakh": {"amount": 4.5, "unit": "lakh"}, "deep": {"a": {"b": [i]}}, "gap": [7, None]}


def test_a_chain_of_renames_keeps_its_first_name_and_the_plan_stays_small(spark):
    n = 20
    value = lambda i: i * 3 + 0.5
    spec = {f: rows(**{f"sales{f}": value, "still": lambda i: i * 11 + 0.25}) for f in range(1, n + 1)}
    df = files(spark, spec)
    _, k, renamed = drift.infer(df)
    assert renamed.count() == n - 1
    origin = drift.lineage(k, renamed)
    got = {(r.file_no, r.field): r.origin for r in origin.collect()}
    assert all(got[f, f"sales{f}"] == "sales1" and got[f, "still"] == "still" for f in range(1, n + 1))
    assert origin._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 4
    # a field that comes back after a gap begins anew
    spec = {1: rows(a=value), 2: rows(), 3: rows(a=value)}
    _, k, renamed = drift.infer(files(spark, spec))
    assert {(r.file_no, r.field, r.origin) for r in drift.lineage(k, renamed).where("field = 'a'").collect()} == {(1, "a", "a"), (3, "a", "a")}


def test_kind_counts(spark):
    spec = {1: rows(a=lambda i: [1, "x", True, None, {"b": 1}, [2]][i])}
    got = {(r.field, r.kind): r.n for r in drift.kind_counts(files(spark, spec)).collect()}
    assert {k for f, k in got if f == "a"} == {"number", "text", "boolean", "object", "list"} and got["symbol", "text"] == 6
