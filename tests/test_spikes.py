import itertools
import math
import random
from statistics import median

import numpy as np
from pyspark.accumulators import AccumulatorParam

from marketloom.operators import spikes



class Most(AccumulatorParam):
    def zero(self, value):
        return 0

    def addInPlace(self, a, b):
        return max(a, b)


RULES = {("p", "close"): spikes.LEVEL, ("p", "volume"): spikes.AMOUNT}


def brute(rows):
    """The stated limits, reading by reading."""
    out = set()
    for field, rule in (("close", spikes.LEVEL), ("volume", spikes.AMOUNT)):
        sources = {}
        for src, t, seq, c, v in rows:
            x = c if field == "close" else v
            if src is not None and t is not None and x is not None and not math.isnan(x):
                sources.setdefault(src, {}).setdefault(t, []).append((seq, x))
        for by_t in sources.values():
            order = sorted(by_t)
            judged = [min(by_t[t])[1] for t in order]
            bad = lambda x: math.isinf(x) or (x <= 0 if rule.level else x < 0)
            good = [(i, x) for i, x in enumerate(judged) if not bad(x)]
            xs = [x for _, x in good]
            if rule.level:
                moves = [abs(b / a - 1) for a, b in zip(xs, xs[1:]) if a != b]
            else:
                moves = [x for x in xs if x]
            scale = median(moves) if moves else math.inf
            reps = [i > 0 and judged[i] == judged[i - 1] for i in range(len(judged))]
            quiet = sum(reps) / len(reps) >= rule.most_repeats
            run_of, i = {}, 0
            while i < len(judged):
                j = i
                while j + 1 < len(judged) and reps[j + 1]:
                    j += 1
                for k in range(i, j + 1):
                    run_of[k] = j - i + 1
                i = j + 1
            pos = {i: k for k, (i, _) in enumerate(good)}
            for i, t in enumerate(order):
                for seq, x in by_t[t]:
                    hit = bad(x)
                    if not hit and rule.level and i in pos:
                        k = pos[i]
                        b, a = xs[max(0, k - 5) : k], xs[k + 1 : k + 6]
                        hit = bool(b and a) and min(abs(x / median(b) - 1), abs(x / median(a) - 1)) > 20 * scale
                    elif not hit and not rule.level:
                        hit = x > 25 * scale
                    hit = hit or (reps[i] and run_of[i] >= 8 and not quiet)
                    if hit and x == judged[i]:
                        out.add(("p", field, seq))
    return out


def series(n, seed, src):
    r = random.Random(seed)
    x, rows = 100.0, []
    for t in range(n):
        x *= math.exp(r.gauss(0, 0.004))
        rows.append([src, t, round(x, 2), float(r.randint(500, 1500))])
    for t in r.sample(range(10, n - 10), 6):
        rows[t][2] = r.choice([rows[t][2] * 100, rows[t][2] / 100, 0.0, -5.0, math.inf, None, math.nan])
    for t in r.sample(range(10, n - 10), 3):
        rows[t][3] = r.choice([-1.0, 90_000.0, None])
    start = r.randrange(20, n - 30)
    for t in range(start, start + 9):
        rows[t][2] = rows[start][2]
    for t in range(n // 2, n):
        if rows[t][2] is not None:
            rows[t][2] *= 2  # a lasting new level
    return rows


def run(spark, rows, chunk):
    df = spark.createDataFrame(rows, "s string, t long, seq long, close double, volume double")
    long = spikes.readings(df, "p", {"close": spikes.LEVEL, "volume": spikes.AMOUNT}, ["s"], df["t"] * 3_600_000_000, "seq")
    return {tuple(r) for r in spikes.flag(long, RULES, chunk=chunk, period_days=3).collect()}


def test_flags_equal_brute_force_for_whole_and_cut_sources(spark):
    rows = [r for k in range(4) for r in series(400, k, f"s{k}")] + [[None, 1, 5.0, 5.0], ["s0", None, 5.0, 5.0], ["one", 3, 5.0, 5.0]]
    rows = [[s, t, i + 1, c, v] for i, (s, t, c, v) in enumerate(rows)]
    again = [[s, t, 10_000 + i, (c or 1.0) * 1.001, v] for s, t, i, c, v in rows if t is not None and t % 17 == 0]
    again += [[s, t, 20_000 + i, c, v] for s, t, i, c, v in rows if t is not None and t % 23 == 0]
    rows += again
    want = {x for x in brute([(s or "", t, i, c, v) for s, t, i, c, v in rows])}
    assert len(want) > 30
    assert run(spark, rows, 4096) == want
    assert run(spark, rows, 150) == want


def test_steps_between_periods_count(spark):
    rows = []
    for src, apart in (("quarterly", 90), ("mixed", 40)):  # hours; the periods here are of 72
        for k, (_, _, c, v) in enumerate(series(60, 7, src)):
            rows.append([src, k * apart, len(rows) + 1, c, v])
    want = brute(rows)
    assert {"quarterly", "mixed"} == {rows[s - 1][0] for _, f, s in want if f == "close" and rows[s - 1][3] > 1000}
    assert run(spark, rows, 4096) == want


def test_last_chunk_sends_nothing_beyond_itself(spark):
    rows = []
    for k in range(8):
        one = [r for r in series(200, k, f"s{k}")[: 150 if k % 2 else 100]]
        one[-1][2] = 5_000.0  # no spike, as nothing comes after it
        rows += [[s, t, len(rows) + i + 1, c, v] for i, (s, t, c, v) in enumerate(one)]
    want = brute(rows)
    assert not {s for _, f, s in want if f == "close" and rows[s - 1][3] == 5_000.0}
    assert run(spark, rows, 150) == want


def test_empty_and_motionless(spark):
    assert run(spark, [["a", None, 1, None, None]], 4096) == set()
    still = [["a", t, t, 5.0, 0.0] for t in range(50)]
    assert run(spark, still, 4096) == set()


def test_posterior_is_that_of_one_sequence_alone():
    r = np.random.default_rng(1)
    emit = r.random((30, 4))
    both = spikes.posterior_normal(emit, np.array([0, 10]), np.array([10, 20]))
    a = spikes.posterior_normal(emit[:10], np.array([0]), np.array([10]))
    b = spikes.posterior_normal(emit[10:], np.array([0]), np.array([20]))
    assert np.allclose(both, np.concatenate([a, b]))


def test_posterior_equals_summing_over_all_state_paths():
    r = np.random.default_rng(2)
    move = spikes.transitions(4)
    far, rep = r.uniform(0, 2, 6), np.array([0, 1, 1, 1, 0, 0], bool)
    emit = spikes.emissions(far, rep, np.array([0, 0, 0, 0, 0, 1], bool), np.zeros(6, bool))
    total, normal = 0.0, np.zeros(6)
    for path in itertools.product(range(4), repeat=6):
        p = move[spikes.NORMAL, path[0]] * emit[0, path[0]] * move[path[-1], spikes.NORMAL]
        for t in range(1, 6):
            p *= move[path[t - 1], path[t]] * emit[t, path[t]]
        total += p
        normal += np.where(np.array(path) == spikes.NORMAL, p, 0)
    assert np.allclose(spikes.posterior_normal(emit, np.array([0]), np.array([6]), move), normal / total)


def repeats_of(sizes):
    return np.concatenate([[False] + [True] * (k - 1) for k in sizes])


def test_the_model_tells_stuck_stretches_from_chance_by_their_length():
    for run in (3, 8, 20):
        sizes = [run - 1, 1, run, 2 * run, 1, run - 1, 5 * run, run - 1]
        rep = repeats_of(sizes)
        n = len(rep)
        emit = spikes.emissions(np.full(n, 0.3), rep, np.zeros(n, bool), np.zeros(n, bool))
        got = spikes.posterior_normal(emit, np.array([0]), np.array([n]), spikes.transitions(run)) < 0.5
        want = np.concatenate([[False] + [k >= run] * (k - 1) for k in sizes])
        assert (got == want).all()
        calm = spikes.emissions(np.full(n, 0.3), rep, np.zeros(n, bool), np.ones(n, bool))
        assert not (spikes.posterior_normal(calm, np.array([0]), np.array([n]), spikes.transitions(run)) < 0.5).any()


def test_flags_come_from_forward_backward_alone(spark, monkeypatch):
    rows = [[s, t, i + 1, c, v] for i, (s, t, c, v) in enumerate(series(400, 0, "s"))]
    want = brute(rows)
    assert run(spark, rows, 4096) == want and len(want) > 8

    def judged_by(model):
        monkeypatch.setattr(spikes, "posterior_normal", model)
        cols = {c: np.array([r[i] if r[i] is not None else np.nan for r in rows], float) for i, c in ((1, "t"), (3, "x"))}
        x = cols["x"][~np.isnan(cols["x"])]
        n = len(x)
        full = lambda v, k=float: np.full(n, v, k)
        return spikes.judge(x, np.arange(n), full(0, int), full(True, bool), full(0.004), full(0.01), full(8, int), full(20.0), full(25.0), full(0.2))

    real = spikes.posterior_normal
    kept = judged_by(real)
    assert kept.any()
    # without the sequence: each reading by its own emissions
    alone = judged_by(lambda emit, starts, lengths, move: emit[:, 0] * move[0, 0] / (emit * move[0]).sum(1))
    assert (alone != kept).any()
    assert not judged_by(lambda emit, *_: np.ones(len(emit))).any()


def test_memory_is_that_of_a_chunk(spark, monkeypatch):
    """However many chunks a task has, judge never sees more than a batch and the open chunk."""
    rows = [[f"s{k}", t, k * 1000 + t + 1, 100.0 + (t * 7 + k) % 13, 5.0 + t % 3] for k in range(60) for t in range(300)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 500)
    seen = spark.sparkContext.accumulator(0, Most())
    real = spikes.judge

    def watched(x, *a):
        seen.add(len(x))
        return real(x, *a)

    try:
        df = spark.createDataFrame(rows, "s string, t long, seq long, close double, volume double").coalesce(1)
        long = spikes.readings(df, "p", {"close": spikes.LEVEL}, ["s"], df["t"] * 3_600_000_000, "seq")
        monkeypatch.setattr(spikes, "judge", watched)
        spikes.flag(long.coalesce(1), RULES, chunk=150, period_days=3).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert 0 < seen.value <= 500 + 150 + 2 * spikes.HALO


def test_limits_turn_on_the_mean_of_the_middle_two(spark):
    """An even number of amounts, one of them between 25 times the lower and 25 times the true median."""
    rows = [["s", t, t + 1, 5.0, v] for t, v in enumerate([1.0] * 10 + [3.0] * 9 + [40.0])]
    assert median([r[4] for r in rows]) == 2.0
    assert run(spark, rows, 4096) == brute(rows) == set()
    rows[-1][4] = 51.0
    assert run(spark, rows, 4096) == brute(rows) == {("p", "volume", 20)}
