"""Incremental refresh as Structured Streaming (S11 + S12 in streaming form).

The reference refreshes in daily batches: a created/modified timestamp filter
followed by an upsert by natural key. Run as a stream with
``trigger(availableNow=True)``, each new set of delta files is processed
exactly once (the checkpoint records which files were consumed) and the
upsert runs per micro-batch in ``foreachBatch``. Batch ``b`` reads the newest
complete version at or below ``b`` and writes version ``b + 1``. A version is
complete once its ``_SUCCESS`` marker exists, so a batch that dies half way
(a lost executor, a killed driver) leaves an incomplete folder that no reader
uses. The retry of the same batch id reads the same base and overwrites that
folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.ranges import RangeTable
from ..sources.sinks import incremental, upsert


def stream_incremental_extract(spark: SparkSession, source: str, schema: StructType | str,
                               since, sink: str, checkpoint: str) -> StreamingQuery:
    """S11 as a stream: rows created or modified after ``since``, appended to ``sink``."""
    rows = incremental(spark.readStream.schema(schema).parquet(source), since)
    return (rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start(sink))


def stream_upsert(spark: SparkSession, source: str, schema: StructType | str, table: str,
                  key: str, update_cols: Sequence[str], order: Sequence[str],
                  checkpoint: str) -> StreamingQuery:
    """S12 as a stream: upsert each micro-batch of deltas into versioned ``table``.

    ``table`` holds ``v=<n>`` folders; version 0 is the base load. Readers use
    ``latest_version(spark, table)``.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        base = spark.read.parquet(_version_path(table, _newest(spark, table, batch_id)))
        merged = upsert(base, batch, key, update_cols, order).drop("change")
        merged.write.mode("overwrite").parquet(_version_path(table, batch_id + 1))

    return (spark.readStream.schema(schema).parquet(source).writeStream
            .foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_merge(spark: SparkSession, source: str, schema: StructType | str, table: RangeTable,
                 update_cols: Sequence[str], order: Sequence[str], checkpoint: str) -> StreamingQuery:
    """S12 as a stream into a table laid out by key range: a micro-batch rewrites the ranges it touches.

    The batch id names the batch, so one that is run again after a failure is finished from
    what it staged, or left alone where it was applied.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        table.upsert(f"stream-{batch_id}", batch, update_cols, order)

    return (spark.readStream.schema(schema).parquet(source).writeStream
            .foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _version_path(table: str, version: int) -> str:
    return f"{table.rstrip('/')}/v={version}"


def complete_versions(spark: SparkSession, table: str) -> list[int]:
    """Version numbers whose folder holds a ``_SUCCESS`` marker, ascending.

    Only the table's top-level folder is listed (one entry per version), on
    the driver, through the Hadoop file system the session is configured for.
    """
    jvm = spark.sparkContext._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path
    root = fs_path(table)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if (status.isDirectory() and name.startswith("v=") and name[2:].isdigit()
                and fs.exists(fs_path(status.getPath(), "_SUCCESS"))):
            out.append(int(name[2:]))
    return sorted(out)


def _newest(spark: SparkSession, table: str, at_most: int | None = None) -> int:
    versions = [v for v in complete_versions(spark, table) if at_most is None or v <= at_most]
    if not versions:
        raise FileNotFoundError(f"no complete version under {table}")
    return versions[-1]


def latest_version(spark: SparkSession, table: str) -> DataFrame:
    """The newest complete version of a versioned table."""
    return spark.read.parquet(_version_path(table, _newest(spark, table)))
