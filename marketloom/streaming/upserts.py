"""Micro-batch ingestion: a file stream upserted into a lake table, once per file, restartable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketloom.operators.lake import Lake, TableSpec


def ingest(spark: SparkSession, source: str, schema: T.StructType, lake: Lake, spec: TableSpec, checkpoint: str, order: list[str], files_per_batch: int = 25, **how) -> DataFrame:
    """Everything new under ``source`` merged into ``spec``; the table afterwards.

    Batches run in order; the checkpoint remembers files, and a batch repeated after a failure
    changes nothing because the merge is idempotent.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    q = (
        stream.writeStream.foreachBatch(lambda batch, _: lake.write(spec, batch, order, **how) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return lake.read(spec)
