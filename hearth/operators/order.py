"""L4: a global order with row numbers, without a single-task window.

Rows are range-partitioned on the order and sorted inside each partition, then written: one
part file after the other is the whole order. A row's number is its place in its file plus the
rows of all files before it; only the counts (one per file) are added up in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILE, PLACE = "part", "place"


def write_ordered(df: DataFrame, path: str, order: Sequence[Column], partitions: int | None = None) -> None:
    """Write ``df`` in order under ``part=<n>`` folders; each row carries its ``place`` (from 0) in its part.

    ``order`` should end in a unique column, so that reruns agree.
    """
    shuffled = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    # monotonically_increasing_id numbers the rows of a partition, above its number in the high bits
    (shuffled.sortWithinPartitions(*order)
     .select("*", F.spark_partition_id().alias(FILE), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(PLACE))
     .write.mode("overwrite").partitionBy(FILE).parquet(path))


def ranked(written: DataFrame, name: str = "rank") -> DataFrame:
    """The rows of a written order with their number from 1."""
    counts = written.groupBy(FILE).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(FILE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))  # one row per file
    return (written.join(starts, FILE).withColumn(name, F.col("_start") + F.col(PLACE) + 1).drop("_start", FILE, PLACE))
