"""Implausible readings, judged per source by a hidden Markov model.

Every source (one measured series) is a sequence of readings with four hidden states: normal,
spike, stuck and out of range. A reading's evidence is its distance from the levels just before
and just after it in units of the source's own limit (amounts: in units of a multiple of the
source's median), whether it repeats the reading before it, and whether it violates a hard bound.
The limits of ``Rule`` are part of the model: they are the edges of the emissions' supports and
the price of a stuck stretch. Forward-backward probabilities over the whole sequence assign the
flags: a reading is flagged where any state but normal is the likelier, and by nothing else.

How the limits enter:

* distance: normal readings lie within the limit (an exponential cut off there), spikes beyond
  it (a power law from there), stuck ones anywhere;
* repeats: in the normal state a source repeats a reading with the small chance ``_REPEAT``, in
  the stuck state always. Entering and leaving the stuck state cost as much together as
  ``run - 1.5`` normal repeats, so that a stretch of ``run - 1`` repeats (a run of ``run`` equal
  readings) is likelier stuck and a shorter one likelier chance. A source of which
  ``most_repeats`` or more of the readings repeat does so normally, and a repeat says nothing;
* bounds: only the out-of-range state emits a reading outside them.

Scale: sources are cut into chunks by the rank of the reading, each with a halo of readings
from its neighbours, so a source with a third of all rows is many tasks; ranks come from
per-(source, period) counts, never from one window over a whole source. Chunks reach Python one
after the other and only those of the current batch and the open one are held, however many a
task has. Source medians are those of mergeable sketches (``percentile_approx``), exact up to
``accuracy / 2`` readings of a source; the mean of the two middle ones for an even number.

Defined results: null and NaN are missing and never flagged, nor do they break a run; each
instant counts once, with the reading loaded first; other rows of the instant are flagged with it
if they hold the same reading, and never otherwise; readings without a neighbour on one side are
no spikes; a source whose readings never move has no spikes; an empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Readings in a chunk, and readings of the neighbouring chunks that it also sees on either side.
CHUNK, HALO = 4096, 64
#: Readings on either side that make a level.
REACH = 5


@dataclass(frozen=True)
class Rule:
    """Limits of a field. ``level`` fields move around a level, the others scatter from zero upwards."""

    level: bool
    steps: float = 20.0
    multiple: float = 25.0
    run: int = 8
    most_repeats: float = 0.2


LEVEL, AMOUNT = Rule(level=True), Rule(level=False)

# The model: states normal, spike, stuck, out of range.
NORMAL, SPIKE, STUCK, OUT = range(4)
#: Chance of a repeat in the normal state, and a chance that rules a state out.
_REPEAT, _NEVER = 1e-8, 1e-200
#: Chances of a spike or a bad reading after a sound one, and of another one after it.
_BREAK, _LAST = 0.02, 0.4


def transitions(run: int = 8) -> np.ndarray:
    """The move matrix; the last row and column are the sequence's beginning and its end, which is as after a normal reading."""
    edge = _REPEAT ** ((run - 1.5) / 2)  # the price of entering, and of leaving, the stuck state
    m = np.empty((4, 4))
    m[NORMAL] = 1 - 2 * _BREAK, _BREAK, edge, _BREAK
    m[SPIKE] = 1 - 2 * _LAST, _LAST, edge, _LAST
    m[OUT] = 1 - 2 * _LAST, _LAST, edge, _LAST
    m[STUCK] = edge, edge * _BREAK, 1.0, edge * _BREAK
    return m


def emissions(far: np.ndarray, repeat: np.ndarray, bound: np.ndarray, restless: np.ndarray) -> np.ndarray:
    """P(evidence | state) of each reading; ``far`` in limits (1 is the limit), ``restless`` where the source repeats anyway."""
    near = far <= 1
    within = 12 * np.exp(-12 * np.minimum(far, 1))
    beyond = np.maximum(np.maximum(far, 1) ** -2.0, 1e-30)
    chance = np.where(repeat, np.where(restless, 1.0, _REPEAT), 1.0)
    out = np.empty((len(far), 4))
    out[:, NORMAL] = np.where(near, within, _NEVER) * chance
    out[:, SPIKE] = np.where(near, _NEVER, beyond) * chance
    out[:, STUCK] = np.where(near, within, beyond) * np.where(repeat, 1.0, _NEVER)
    out[:, OUT] = _NEVER
    out[bound] = _NEVER, _NEVER, _NEVER, 1.0
    return out


def posterior_normal(emit: np.ndarray, starts: np.ndarray, lengths: np.ndarray, move: np.ndarray | None = None) -> np.ndarray:
    """Forward-backward over many sequences at once; P(normal | all evidence) of every reading."""
    move = transitions() if move is None else move
    out = np.ones(len(emit))
    order = np.argsort(-lengths, kind="stable")
    for lo in range(0, len(order), 512):
        rows = order[lo : lo + 512]
        if not len(rows) or lengths[rows[0]] == 0:
            break
        first, size = starts[rows], lengths[rows]
        steps = int(size[0])
        live = np.searchsorted(-size, -np.arange(steps), side="left")  # sequences longer than t
        ahead = np.empty((steps, len(rows), 4))
        f = move[NORMAL][None, :]
        for t in range(steps):
            n = live[t]
            f = (f[:n] @ move if t else np.repeat(f, n, 0)) * emit[first[:n] + t]
            f /= f.sum(1, keepdims=True)
            ahead[t, :n] = f
        b = np.repeat(move[:, NORMAL][None, :], len(rows), 0)
        for t in range(steps - 1, -1, -1):
            n = live[t]
            g = ahead[t, :n] * b[:n]
            out[first[:n] + t] = g[:, NORMAL] / g.sum(1)
            if t:
                nb = (b[:n] * emit[first[:n] + t]) @ move.T
                b[:n] = nb / nb.sum(1, keepdims=True)
    return out


def _levels(x: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Medians of up to REACH readings before and after each, within its segment; NaN where there are none."""

    def one(step: int) -> np.ndarray:
        n = len(x)
        m = np.full((n, REACH), np.inf)
        for k in range(1, min(REACH, n - 1) + 1):
            if step < 0:
                m[k:, k - 1] = np.where(seg[k:] == seg[:-k], x[:-k], np.inf)
            else:
                m[:-k, k - 1] = np.where(seg[k:] == seg[:-k], x[k:], np.inf)
        m.sort(axis=1)
        have = np.isfinite(m).sum(1)
        at = np.arange(n)
        lo, hi = m[at, np.maximum(have - 1, 0) // 2], m[at, np.minimum(have // 2, REACH - 1)]
        with np.errstate(invalid="ignore"):
            return np.where(have > 0, (lo + hi) / 2, np.nan)

    return one(-1), one(1)


def judge(x, rank, seg, level, scale, rate, run, steps, multiple, most):
    """Flags of rows in (segment, rank, load) order; the per-row arguments are those of the row's source.

    ``x`` has no missing readings. The first row of each (segment, rank) is the judged one.
    """
    n = len(x)
    if n == 0:
        return np.zeros(0, bool)
    lead = np.ones(n, bool)
    lead[1:] = (seg[1:] != seg[:-1]) | (rank[1:] != rank[:-1])
    of = np.cumsum(lead) - 1  # the judged reading each row belongs to
    at = np.flatnonzero(lead)
    jx, jseg, jlevel = x[at], seg[at], level[at]
    jbound = ~np.isfinite(jx) | np.where(jlevel, jx <= 0, jx < 0)
    # levels are those of readings inside the bounds
    inside = np.flatnonzero(~jbound & jlevel)
    before, after = np.full(len(at), np.nan), np.full(len(at), np.nan)
    if len(inside):
        b, a = _levels(jx[inside], jseg[inside])
        before[inside], after[inside] = b, a
    with np.errstate(divide="ignore", invalid="ignore"):
        off = np.minimum(np.abs(jx / before - 1), np.abs(jx / after - 1)) / (steps[at] * scale[at])
        far = np.where(jlevel, off, jx / (multiple[at] * scale[at]))
    far = np.where(jbound | ~np.isfinite(far), 0.0, np.maximum(far, 0.0))
    jrep = np.zeros(len(at), bool)
    jrep[1:] = (jx[1:] == jx[:-1]) & (jseg[1:] == jseg[:-1])
    starts = np.flatnonzero(np.append(True, jseg[1:] != jseg[:-1]))
    lengths = np.diff(np.append(starts, len(at)))
    emit = emissions(far, jrep, jbound, rate[at] >= most[at])
    flagged = np.zeros(len(at), bool)
    for r in np.unique(run[at]):  # the fields' rules may price stretches differently
        some = run[at][starts] == r
        normal = posterior_normal(emit, starts[some], lengths[some], transitions(int(r)))
        flagged |= normal < 0.5
    return flagged[of] & (x == jx[of])


def readings(df: DataFrame, table_name: str, fields: dict[str, Rule], key: list[str], at_us, load_seq: str) -> DataFrame:
    """Long form of one table: table_name, field_name, k1, k2 (the source), at_us, load_seq, x."""
    k = [F.col(c).cast("string") for c in key] + [F.lit("")] * (2 - len(key))
    cells = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).cast("double").alias("x")) for f in fields))
    long = df.select(k[0].alias("k1"), k[1].alias("k2"), at_us.alias("at_us"), F.col(load_seq).alias("load_seq"), F.explode(cells).alias("c"))
    return long.where(F.col("at_us").isNotNull() & F.col("c.x").isNotNull() & ~F.isnan("c.x")).select(F.lit(table_name).alias("table_name"), "c.field_name", "k1", "k2", "at_us", "load_seq", "c.x")


def flag(long: DataFrame, rules: dict[tuple[str, str], Rule], chunk: int = CHUNK, period_days: int = 64, accuracy: int = 200_000) -> DataFrame:
    """(table_name, field_name, load_seq) of the rows whose reading its source can't have produced."""
    kinds = sorted(rules)
    code = F.expr("CASE " + " ".join(f"WHEN table_name = '{t}' AND field_name = '{f}' THEN {i}" for i, (t, f) in enumerate(kinds)) + " END")
    is_level = F.col("kind").isin([i for i, k in enumerate(kinds) if rules[k].level])
    src = ["kind", "k1", "k2"]
    rows = (
        long.withColumn("kind", code.cast("int"))
        .withColumn("period", F.floor(F.col("at_us") / F.lit(period_days * 86_400_000_000)).cast("int"))
        .select(*src, "period", "at_us", "load_seq", "x")
    )
    in_period = Window.partitionBy(*src, "period").orderBy("at_us", "load_seq")
    before = F.lag("at_us").over(in_period)
    ranked = rows.withColumn("judged", F.coalesce(before != F.col("at_us"), F.lit(True)))
    sound = ~F.col("x").isin(float("inf"), float("-inf")) & F.when(is_level, F.col("x") > 0).otherwise(F.col("x") >= 0)
    ranked = ranked.withColumn("u", F.when(F.col("judged") & sound, F.col("x")))
    ranked = ranked.withColumn("pos", F.sum(F.col("judged").cast("int")).over(in_period.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("pu", F.last("u", ignorenulls=True).over(in_period.rowsBetween(Window.unboundedPreceding, -1)))
    # one row per (source, period): where its ranks begin and what reading came before it
    by_source = Window.partitionBy(*src).orderBy("period")
    periods = (
        ranked.groupBy(*src, "period")
        .agg(F.max("pos").alias("n"), F.min_by("u", F.when(F.col("u").isNotNull(), F.col("at_us"))).alias("first_u"), F.max_by("u", F.when(F.col("u").isNotNull(), F.col("at_us"))).alias("last_u"))
        .withColumn("base", F.coalesce(F.sum("n").over(by_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("last_chunk", F.floor((F.sum("n").over(Window.partitionBy(*src)) - 1) / chunk).cast("int"))
        .withColumn("before_u", F.last("last_u", ignorenulls=True).over(by_source.rowsBetween(Window.unboundedPreceding, -1)))
    )
    move = F.when(is_level, F.abs(F.try_divide("u", "pu") - 1)).otherwise(F.col("u"))
    inner = ranked.where("judged").select(*src, "u", "pu", move.alias("move"), F.lit(1).alias("one"))
    # the step from one period to the next; an amount is itself its move and counted already
    edges = periods.where("first_u IS NOT NULL AND before_u IS NOT NULL").select(*src, F.col("first_u").alias("u"), F.col("before_u").alias("pu"))
    edges = edges.select(*src, "u", "pu", F.when(is_level, move).alias("move"), F.lit(0).alias("one"))
    figures = inner.unionByName(edges).groupBy(*src).agg(
        # the lower of the middle two, and by symmetry the upper one
        ((F.percentile_approx(F.when(F.col("move") > 0, F.col("move")), 0.5, accuracy) - F.percentile_approx(F.when(F.col("move") > 0, -F.col("move")), 0.5, accuracy)) / 2).alias("scale"),
        F.count_if(F.col("u") == F.col("pu")).alias("reps"),
        F.sum("one").alias("n"),
    )
    same = lambda a, b, keys: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in keys]
    stats = figures.select(
        *src,
        F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / chunk).cast("int"))).alias("chunk"),
        F.lit(-1).cast("long").alias("rank"),
        F.lit(None).cast("long").alias("load_seq"),
        F.coalesce(F.col("scale"), F.lit(float("inf"))).alias("x"),
        (F.col("reps") / F.col("n")).alias("rate"),
    )
    offsets = periods.select(*src, "period", "base", "last_chunk")
    placed = ranked.select(*src, "period", "pos", "load_seq", "x").alias("r").join(offsets.alias("o"), same("r", "o", [*src, "period"])).select(*(f"r.{c}" for c in src), (F.col("base") + F.col("pos") - 1).alias("rank"), "last_chunk", "load_seq", "x")
    home = F.floor(F.col("rank") / chunk).cast("int")
    inside = F.col("rank") % chunk
    homes = F.array_compact(F.array(home, F.when((inside < HALO) & (home > 0), home - 1), F.when((inside >= chunk - HALO) & (home < F.col("last_chunk")), home + 1)))
    chunks = placed.select(*src, F.explode(homes).alias("chunk"), "rank", "load_seq", "x", F.lit(None).cast("double").alias("rate"))
    parts = chunks.unionByName(stats).repartition(*[F.col(c) for c in (*src, "chunk")]).sortWithinPartitions(*src, "chunk", "rank", "load_seq")
    limits = [rules[k] for k in kinds]

    names = np.array(kinds, object)

    def hits(t: pa.Table):
        col = lambda c: t.column(c).to_numpy(zero_copy_only=False)
        kind, at, rank, x = col("kind"), col("chunk"), col("rank"), col("x")
        head = np.flatnonzero(rank == -1)
        # rows of a chunk follow the row with its source's figures
        seg = np.cumsum(rank == -1) - 1
        rate, scale = col("rate")[head][seg], x[head][seg]
        body = rank >= 0
        pick = lambda a: a[body]
        kind, seg, rank, x, rate, scale, at = map(pick, (kind, seg, rank, x, rate, scale, at))
        of = lambda f: np.array([getattr(r, f) for r in limits])[kind]
        hit = judge(x, rank, seg, of("level"), scale, rate, of("run"), of("steps"), of("multiple"), of("most_repeats"))
        hit &= rank // chunk == at  # the halo is judged at home
        seq, which = pick(col("load_seq"))[hit].astype(np.int64), kind[hit]
        return pa.RecordBatch.from_arrays([*(pa.array(names[which, i], pa.string()) for i in (0, 1)), pa.array(seq)], names=["table_name", "field_name", "load_seq"])

    def run(batches):
        open_ = []  # the rows of the chunk that isn't over, from its head
        for b in batches:
            heads = np.flatnonzero(b.column("rank").to_numpy() == -1)
            if not len(heads):
                open_.append(b)
                continue
            over = pa.Table.from_batches([*open_, b.slice(0, heads[-1])])
            open_ = [b.slice(heads[-1])]
            if over.num_rows:
                yield hits(over)
        if open_:
            yield hits(pa.Table.from_batches(open_))

    return parts.mapInArrow(run, "table_name string, field_name string, load_seq long")
