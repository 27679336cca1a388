import __spark_entry__
from marketloom.plans import listing_queries
from marketloom.sources import listings


def test_universe_with_and_without_limit(spark, monkeypatch):
    rows = [(x, f" s{i:03d} ", "n") for i in range(130) for x in ("NSE", "BSE")] + [("BSE", "only", "n"), ("NSE", " ", "n")]
    u = spark.createDataFrame(rows, "exchange string, symbol string, company_name string")
    monkeypatch.setattr(listing_queries, "universe", lambda *_: u)
    run = lambda name: [tuple(r) for r in __spark_entry__.queries()[name](spark, "").collect()]
    every = sorted([(f"S{i:03d}",) for i in range(130)] + [("ONLY",)])
    assert run("src14_universe_all") == every and run("src13_14_universe_scan") == [s for s in every if s != ("ONLY",)][:50]
    pairs = sorted({(x, s.strip().upper()) for x, s, _ in rows})
    assert run("srt03_all_pairs") == pairs and run("srt03_sorted_pairs") == pairs[:100]
    for x in ("", "BOTH", "all", "*", None):
        assert [tuple(r) for r in listings.symbols(u, x).collect()] == every
    assert [r.symbol for r in listings.symbols(u, "bse", 1).collect()] == ["ONLY"]
