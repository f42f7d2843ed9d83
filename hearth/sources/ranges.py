"""A written table laid out by key range: a batch rewrites only the ranges it touches.

``create`` cuts the keys into ranges of about equal size (bounds from Spark's own range
partitioning) and writes one folder a range; the bounds are kept beside the data. ``apply``
finds the ranges of a batch's keys, reads those folders only, combines them with the batch and
replaces them by dynamic partition overwrite. The files of all other ranges stay as they are,
so the cost follows the batch and not the table.

A batch has a name and survives interruption. Its new ranges are first written to
``staged/<batch>``, which ends with a marker; only then are they put into the table. A rerun
that finds the marker puts the same rows in again and computes nothing from a half replaced
table; a rerun of a finished batch changes nothing.

The range of a key is the number of bounds not above it, found by a balanced tree of comparisons
(some hundred ranges at most; a larger range is several files): no join, no Python. A key that
is null is refused (the table's key is NOT NULL).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import storage
from .sinks import upsert

RANGE = "key_range"


def _position(key: Column, bounds: Sequence[str], kind: T.DataType) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``: a balanced tree of comparisons."""
    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(key < F.lit(bounds[mid]).cast(kind), among(low, mid)).otherwise(among(mid + 1, high))
    return among(0, len(bounds))


def _with_range(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RANGE, T.IntegerType())])


def _write(rows: DataFrame, key: str, path: str) -> None:
    """Replace the folders of the ranges that ``rows`` hold.

    Rebalancing deals rows out by range without a sampling pass; adaptive execution then joins
    small ranges into one task and splits a range that has outgrown the others.
    """
    (rows.hint("rebalance", RANGE).sortWithinPartitions(RANGE, key).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(RANGE).parquet(path))


class RangeTable:
    """Handle on a table that ``create`` wrote."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        layout = storage.get(spark, f"{self.root}/layout.json")
        if layout is None:
            raise FileNotFoundError(f"no table at {root}")
        self.key, self.schema = layout["key"], T.StructType.fromJson(layout["schema"])
        self.bounds = layout["bounds"]

    @classmethod
    def create(cls, df: DataFrame, root: str, key: str, ranges: int = 64) -> RangeTable:
        """Write ``df`` in about ``ranges`` key ranges; ``key`` must not be null."""
        spark, root = df.sparkSession, root.rstrip("/")
        df = df.where(F.col(key).isNotNull())
        lows = (df.select(key).repartitionByRange(ranges, key).groupBy(F.spark_partition_id().alias("p"))
                .agg(F.min(key).alias("low")).orderBy("low").select(F.col("low").cast("string")).collect())   # at most ``ranges`` rows
        bounds = [r.low for r in lows[1:]]
        _write(df.withColumn(RANGE, _position(F.col(key), bounds, df.schema[key].dataType)), key, f"{root}/data")
        storage.put(spark, f"{root}/layout.json", {"key": key, "bounds": bounds, "schema": df.schema.jsonValue()})
        return cls(spark, root)

    def range_of(self, key: Column) -> Column:
        return _position(key, self.bounds, self.schema[self.key].dataType)

    def _data(self) -> DataFrame:
        return self.spark.read.schema(_with_range(self.schema)).parquet(f"{self.root}/data")

    def read(self) -> DataFrame:
        return self._data().drop(RANGE)

    def read_ranges(self, touched: Sequence[int]) -> DataFrame:
        """The rows of some ranges; other folders are not opened."""
        return self._data().where(F.col(RANGE).isin(list(touched))).drop(RANGE)

    def apply(self, batch: str, delta: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace the touched ranges by ``combine(their rows, delta)``; returns the ranges replaced.

        ``combine`` must keep the table's columns and every key of both sides. A batch applied
        before is left alone.
        """
        done, staged = f"{self.root}/applied/{batch}.json", f"{self.root}/staged/{batch}"
        if storage.get(self.spark, done) is None:
            if not storage.complete(self.spark, staged):
                delta = delta.where(F.col(self.key).isNotNull())
                found = delta.select(self.range_of(F.col(self.key)).alias("r")).distinct().collect()   # at most a row per range
                touched = [r.r for r in found]
                rows = combine(self.read_ranges(touched), delta).select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
                _write(rows.withColumn(RANGE, self.range_of(F.col(self.key))), self.key, staged)
            touched = self._staged(staged)
            if touched:
                rows = self.spark.read.schema(_with_range(self.schema)).parquet(staged)
                _write(rows, self.key, f"{self.root}/data")
            storage.put(self.spark, done, {"batch": batch, "ranges": touched})
        return self._staged(staged)

    def _staged(self, staged: str) -> list[int]:
        """Ranges that a staged batch holds."""
        return sorted(int(n.split("=")[1]) for n in storage.children(self.spark, staged) if n.startswith(f"{RANGE}="))

    def upsert(self, batch: str, delta: DataFrame, update_cols: Sequence[str], order: Sequence[str],
               updated_at: Column | None = None) -> list[int]:
        """S12 on the touched ranges: last row per key wins, listed columns are replaced, new keys inserted."""
        return self.apply(batch, delta, lambda base, d: upsert(base, d, self.key, update_cols, order, updated_at).drop("change"))
