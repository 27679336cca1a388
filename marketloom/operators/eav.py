"""Entity–attribute–value rows to wide rows with typed columns.

Cells are parsed and keyed on the JVM side. Each Arrow batch is turned into slot registers, one
per entity it holds, by sorting and keeping the greatest version of a cell; ``combineByKey`` then
merges registers, first on the map side, so that a re-delivered hot cell never travels, then
across the shuffle. Its merger is associative and commutative (the greatest version of a cell
wins). A typed encoder emits a full row, or one row per filled slot.

Defined results: rows of no period, with a blank symbol, or with an unreadable number are
ignored and erase nothing; entities without a readable cell don't come out; equal versions of
a cell resolve to the greater number; an empty table gives an empty one.

Scale: what is pickled is one row per entity and batch, not one per cell; reducers grow with the
number of input partitions. A hot entity has no more than one register per map task to shuffle,
as many cells as there are attributes.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.fundamentals import hundredths, metric_name, metric_of, norm_label, period_of, squeeze
from marketloom.session import written

#: Slots of an entity that hold something: {slot: (version..., value)}.
Register = dict[str, tuple]


def _merge(a: Register, b: Register) -> Register:
    if len(a) < len(b):
        a, b = b, a
    for slot, version in b.items():
        held = a.get(slot)
        if held is None or held < version:
            a[slot] = version
    return a


def _changes(columns: list[pa.Array]) -> np.ndarray:
    """Whether each row differs from the one before it in any column (nulls equal nulls)."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    out[:1] = True
    for c in columns:
        codes = pc.dictionary_encode(c, null_encoding="encode").indices.to_numpy()
        out[1:] |= codes[1:] != codes[:-1]
    return out


def _batch_registers(entity: list[str], slot: str, version: list[str], nullable: tuple[str, ...] = ()):
    """An Arrow map: the registers of each batch, one row per entity with its packed register.

    Rows without a cell are left out here, as a filter before would compute every cell twice.
    """
    required = [c for c in (*entity, slot, version[-1]) if c not in nullable]

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            for c in required:
                t = t.filter(pc.is_valid(t.column(c)))
            t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in (*entity, slot, *version)])).combine_chunks()
            if not t.num_rows:
                continue
            col = lambda c: t.column(c).combine_chunks() if isinstance(t.column(c), pa.ChunkedArray) else t.column(c)
            of_entity = _changes([col(c) for c in entity])
            of_cell = of_entity | _changes([col(slot)])
            last = np.append(of_cell[1:], True)
            keep = np.flatnonzero(last)  # the greatest version of each cell comes last
            group = np.cumsum(of_entity)[keep]
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            heads = pa.array(keep[first])
            slots, *versions = (col(c).take(pa.array(keep)).to_pylist() for c in (slot, *version))
            cells = list(zip(slots, zip(*versions)))
            packed = [pickle.dumps(dict(cells[a:z]), protocol=5) for a, z in zip(first, np.append(first[1:], len(keep)))]
            yield pa.RecordBatch.from_arrays([*(col(c).take(heads) for c in entity), pa.array(packed, pa.binary())], names=[*entity, "register"])

    return run


def registers(df: DataFrame, entity: list[str], slot: str, order: list[str], value: str, nullable: tuple[str, ...] = ()):
    """RDD of (entity values, register).

    Rows whose entity (but for the ``nullable`` parts), slot or value is null hold no cell. The
    order columns must not be null.
    """
    k, version = len(entity), [*order, value]
    cells = df.select(*entity, slot, *version)
    schema = T.StructType([*(cells.schema[c] for c in entity), T.StructField("register", T.BinaryType())])
    # written, as executors that are lost would else parse again
    rows = written(cells.mapInArrow(_batch_registers(entity, slot, version, nullable), schema), "registers").rdd
    keyed = rows.map(lambda r: (tuple(r[:k]), pickle.loads(r[k])))
    reducers = max(2 * df.sparkSession.sparkContext.defaultParallelism, rows.getNumPartitions())
    return keyed.combineByKey(lambda register: register, _merge, _merge, reducers)


def fundamentals_cells(facts: DataFrame) -> DataFrame:
    """Typed cells of screener facts: table_name, symbol, financial_period, metric, hundredths and their version; null where there is none."""
    staged = facts.select(
        "table_name",
        F.nullif(F.upper(F.trim("symbol")), F.lit("")).alias("symbol"),
        F.upper(squeeze(F.col("financial_period"))).alias("_period"),
        norm_label(F.col("metric_label")).alias("_label"),
        F.coalesce(F.unix_micros("ingested_at"), F.lit(-(2**62))).alias("_at"),
        F.coalesce(F.col("load_seq"), F.lit(-(2**62))).alias("_seq"),
        "metric_text",
    )
    return staged.select("table_name", "symbol", period_of(F.col("_period")).alias("financial_period"), metric_of(F.col("_label")).alias("metric"), "_at", "_seq", hundredths(F.col("metric_text")).alias("hundredths"))


ENTITY = ["table_name", "symbol", "financial_period"]


def _fundamentals(facts: DataFrame):
    return registers(fundamentals_cells(facts), ENTITY, "metric", ["_at", "_seq"], "hundredths", nullable=("table_name",))


def filled_cells(facts: DataFrame) -> DataFrame:
    """One row per filled cell of the wide table, out of the slot registers; any number of metrics."""
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in (*ENTITY, "metric")), T.StructField("hundredths", T.LongType())])
    rows = _fundamentals(facts).flatMap(lambda kv: [(*kv[0], slot, v[-1]) for slot, v in kv[1].items()])
    return facts.sparkSession.createDataFrame(rows, schema, verifySchema=False)


def slot_names(facts: DataFrame, most: int = 20_000) -> list[str]:
    """The metrics that the labels of the facts name, sorted: the columns of the wide table.

    More than ``most`` raises, as no table of so many columns can be planned.
    """
    found = [r[0] for r in facts.select("metric_label").distinct().select(metric_name(F.col("metric_label")).alias("m")).where(F.col("m").isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} metrics: not attributes of one wide table")
    return sorted(found)


def wide(facts: DataFrame) -> DataFrame:
    """One row per table_name, symbol and financial_period, a double column for each metric that is labelled."""
    slots = slot_names(facts)
    number = {s: i for i, s in enumerate(slots)}

    def encode(kv):
        row = [None] * len(slots)
        for s, v in kv[1].items():
            row[number[s]] = v[-1] / 100.0
        return (*kv[0], *row)

    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in ENTITY), *(T.StructField(m, T.DoubleType()) for m in slots)])
    return facts.sparkSession.createDataFrame(_fundamentals(facts).map(encode), schema, verifySchema=False)
