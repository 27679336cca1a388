"""Lake tables: declared layouts, and replace, append, merge and compaction writes that can be repeated.

A version of a table is a manifest file that names the data folders it consists of; manifests
are never changed, and the greatest one counts. A write puts new data folders down first and
publishes its manifest last, by one rename to a new name, so that a crash at any moment leaves
the version before it. An append writes its new rows only; Parquet has no MERGE, so an upsert
writes old rows without a new version plus the new rows.
"""

from __future__ import annotations

import json
import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.market import finite
from marketloom.operators.dedupe import keep_last


@dataclass(frozen=True)
class TableSpec:
    name: str
    layout: T.StructType
    keys: list[str] = field(default_factory=list)
    disposition: str = "replace"  # replace, append or merge


def conform(df: DataFrame, layout: T.StructType) -> DataFrame:
    """df in the layout's columns, order and types: missing ones null, others dropped, bad casts null."""
    have = set(df.columns)
    return df.select(*((F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in layout))


def null_safe(df: DataFrame) -> DataFrame:
    """NaN and infinities of double columns as null."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite(F.col(f"`{c}`")) for c in doubles})


def stamped(df: DataFrame, at: str, column: str = "ingested_at") -> DataFrame:
    """df ready to load: numbers null-safe, every row with the batch's loading time."""
    return null_safe(df).withColumn(column, F.lit(at).cast("timestamp"))


def merged(old: DataFrame, new: DataFrame, keys: list[str], order: list[str], partial: bool = False, insert_only: bool = False) -> DataFrame:
    """old with new rows put in by key; of new rows with one key the last in ``order`` counts.

    Full rows replace (nulls of the new row too). ``partial`` keeps old values where the new ones
    are null; ``insert_only`` leaves existing keys alone. Null keys match each other.
    """
    fresh = keep_last(new, keys, order).select(*old.columns)
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    o, n = old.alias("o"), fresh.alias("n")
    if insert_only:
        return old.unionByName(n.join(o, same("n", "o"), "left_anti"))
    if partial:
        joined = n.join(o, same("n", "o"), "left")
        fresh = joined.select(*(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in old.columns))
    return o.join(n, same("o", "n"), "left_anti").unionByName(fresh)


class Lake:
    """Versioned Parquet tables under a root folder that all executors share; one writer a table at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, p: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(p)

    def _manifest(self, spec: TableSpec, version: int) -> str:
        return f"{self.root}/{spec.name}/_versions/{version:08d}.json"

    def version(self, spec: TableSpec) -> int:
        """The greatest published version; 0 for a table without any."""
        folder = self._path(f"{self.root}/{spec.name}/_versions")
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n[:8]) for n in names if n.endswith(".json") and n[:8].isdigit()), default=0)

    def folders(self, spec: TableSpec, version: int | None = None) -> list[str]:
        """The data folders of a version, the newest by default."""
        v = self.version(spec) if version is None else version
        if not v:
            return []
        stream = self._fs.open(self._path(self._manifest(spec, v)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())["folders"]
        finally:
            stream.close()

    def _publish(self, spec: TableSpec, version: int, folders: list[str]) -> None:
        part, final = self._path(f"{self.root}/{spec.name}/_versions/.{uuid.uuid4().hex}"), self._path(self._manifest(spec, version))
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps({"version": version, "folders": folders}).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(part, final):
            self._fs.delete(part, False)
            raise RuntimeError(f"{spec.name}: version {version} was written by someone else")

    def _raw(self, spec: TableSpec, version: int | None = None) -> DataFrame | None:
        paths = [f"{self.root}/{spec.name}/{f}" for f in self.folders(spec, version)]
        return self.spark.read.option("mergeSchema", True).parquet(*paths) if paths else None

    def read(self, spec: TableSpec, version: int | None = None) -> DataFrame:
        """A version of the table in the layout of ``spec``."""
        raw = self._raw(spec, version)
        return self.spark.createDataFrame([], spec.layout) if raw is None else conform(raw, spec.layout)

    def columns(self, spec: TableSpec) -> list[str]:
        """The columns that the table's files hold."""
        raw = self._raw(spec)
        return spec.layout.fieldNames() if raw is None else raw.columns

    def write(self, spec: TableSpec, rows: DataFrame, order: list[str] | None = None, allow_empty: bool = True, **how) -> int:
        """Write by the table's disposition; the new version's number. Without ``allow_empty`` no rows is an error."""
        new = null_safe(conform(rows, spec.layout) if spec.disposition != "merge" else rows)
        if not allow_empty and new.isEmpty():
            raise ValueError(f"{spec.name}: refusing an empty load")
        v = self.version(spec)
        kept = self.folders(spec, v) if spec.disposition == "append" else []
        out = merged(self.read(spec, v), _with(new, spec.layout), spec.keys, order or spec.keys, **how) if spec.disposition == "merge" else new
        return self._put(spec, v, out, kept)

    def _put(self, spec: TableSpec, v: int, rows: DataFrame, kept: list[str]) -> int:
        folder = f"data-{v + 1:08d}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.root}/{spec.name}/{folder}")
        self._publish(spec, v + 1, [*kept, folder])
        return v + 1

    def compact(self, spec: TableSpec) -> list[str]:
        """Rewrites the table with the layout's columns only, in one folder; the columns dropped. A failure is logged and leaves the table as it is."""
        orphans = [c for c in self.columns(spec) if c not in spec.layout.fieldNames()]
        try:
            v = self.version(spec)
            if v and (orphans or len(self.folders(spec, v)) > 1):
                self._put(spec, v, self.read(spec, v), [])
        except Exception as e:  # noqa: BLE001 - an unfinished compaction harms nothing
            logging.getLogger(__name__).warning("%s: columns %s stay: %s", spec.name, orphans, e)
            return []
        return orphans


def _with(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Columns of the layout, then those that only order versions."""
    extra = [c for c in df.columns if c not in layout.fieldNames()]
    full = T.StructType([*layout.fields, *(df.schema[c] for c in extra)])
    return conform(df, full)


def upsert_csv(spark: SparkSession, old_path: str | None, new: DataFrame, out_path: str, order: list[str], keys: tuple[str, ...] = ("symbol", "timestamp")) -> DataFrame:
    """Existing and incoming rows, the last of each (symbol, second), sorted by key, as CSV in a new folder.

    Incoming rows come after existing ones, among themselves in the order of the columns
    ``order``, which aren't written; rows without a stamp are no rows.
    """
    layout = T.StructType([f for f in new.schema if f.name not in order])
    rows = new.where(F.col(keys[1]).isNotNull()).withColumn("_in", F.lit(1))
    if old_path:
        old = spark.read.schema(layout).option("header", True).csv(old_path)
        rows = rows.unionByName(old.withColumn("_in", F.lit(0)), allowMissingColumns=True)
    rows = rows.withColumn("_sec", F.date_trunc("second", keys[1]))
    out = keep_last(rows, [keys[0], "_sec"], ["_in", *order]).select(*layout.fieldNames()).orderBy(*keys)
    out.write.mode("errorifexists").option("header", True).csv(out_path)
    return spark.read.schema(layout).option("header", True).csv(out_path)
