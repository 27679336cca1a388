"""Session factory and table access shared by queries, tests and the bench."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "marketloom", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session with UTC, AQE and Arrow on; keyword names use ``__`` for dots."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("MARKETLOOM_DRIVER_MEMORY", "8g"))
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local one is set only where it is unset (tests)."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not where:
            import tempfile

            if not (sc.master or "").startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="marketloom-checkpoint-")
        sc.setCheckpointDir(where)
    return sc.getCheckpointDir()


_FOLDERS: dict[str, str] = {}


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder of this application below the checkpoint folder, seen by all executors."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = f"{checkpoint_dir(spark)}/marketloom-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(discard, spark)
    return f"{_FOLDERS[app]}/{name}-{uuid.uuid4().hex[:8]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet and read back: its lineage is cut and its branches don't repeat it."""
    where = work_dir(df.sparkSession, name)
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def discard(spark: SparkSession) -> None:
    """Removes what ``work_dir`` and ``written`` left behind; results that were not read yet are lost."""
    try:
        where = _FOLDERS.pop(spark.sparkContext.applicationId, None)
        if where:
            path = spark._jvm.org.apache.hadoop.fs.Path(where)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass
