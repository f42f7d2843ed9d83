"""S6-S9 sinks and S11 / S12 incremental extract and upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append to a parquet table, optionally laid out by partition columns."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_batch(df: DataFrame, path: str, batch: str) -> bool:
    """S6 that can be repeated: ``df`` as batch ``batch`` of a table; False where it stands already.

    A batch is one folder whose ``_SUCCESS`` marker is its commit record. A repeated batch
    changes nothing; one that died half way has no marker, is not read, and is overwritten.
    """
    at = f"{path.rstrip('/')}/batch={batch}"
    if storage.complete(df.sparkSession, at):
        return False
    df.write.mode("overwrite").parquet(at)
    return True


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The committed batches of a table written by ``append_batch``, with their name as ``batch``."""
    path = path.rstrip("/")
    names = [n for n in storage.children(spark, path) if n.startswith("batch=") and storage.complete(spark, f"{path}/{n}")]
    if not names:
        raise FileNotFoundError(f"no committed batch under {path}")
    kept = spark.read.option("basePath", path).parquet(*[f"{path}/{n}" for n in names])
    return kept.withColumn("batch", F.col("batch").cast("string"))


def replace(df: DataFrame, path: str) -> None:
    """Replace a staging table."""
    df.write.mode("overwrite").parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines export."""
    df.write.mode("overwrite").json(path)


def incremental(df: DataFrame, since, created: str = "created_ts", modified: str = "modified_ts",
                latest_change: str | None = None) -> DataFrame:
    """Rows created or modified after ``since``.

    Where ``modified`` is computed from ``created`` a scan cannot use the filter. If no row
    is modified later than ``latest_change`` (an interval, e.g. ``"47 hours"``) after it was
    created, the bound this implies on ``created`` is added; it reaches the scan.
    """
    ts = F.lit(since).cast("timestamp_ntz")
    if latest_change is not None:
        df = df.where(F.col(created) > ts - F.expr(f"INTERVAL {latest_change}"))
    return df.where((F.col(modified) > ts) | (F.col(created) > ts))


def latest_per_key(delta: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The latest row per key by ``order`` (last wins).

    A ``max(struct(order..., row))`` aggregate rather than a ranked window:
    it combines map-side, so a key with millions of versions is reduced in
    every map task instead of being sorted in one.
    """
    cols = [c for c in delta.columns if c not in order]
    packed = F.struct(*[F.col(c) for c in order], F.struct(*cols).alias("_row"))
    return (delta.groupBy(key).agg(F.max(packed).alias("_m"))
            .select("_m._row.*"))


def upsert(base: DataFrame, delta: DataFrame, key: str, update_cols: Sequence[str],
           order: Sequence[str], updated_at: Column | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE SET c = EXCLUDED.c``.

    The delta is first reduced to its latest row per key. On a match every
    listed column takes the delta value, NULL included (not ``coalesce``), and
    the other columns keep the base value. A new key is inserted with every
    column the delta carries. ``updated_at`` (an input time, so that reruns
    agree) stamps inserted and updated rows. A ``change`` column says which
    rows moved.
    """
    d = latest_per_key(delta, key, order)
    carried = [c for c in d.columns if c != key]
    d = d.select(F.col(key), F.lit(True).alias("_in_delta"),
                 *[F.col(c).alias(f"_d_{c}") for c in carried])
    b = base.withColumn("_in_base", F.lit(True))
    j = b.join(d, key, "full_outer")
    in_d, in_b = F.col("_in_delta").isNotNull(), F.col("_in_base").isNotNull()
    sets: dict[str, Column] = {}
    for c in carried:
        if c in update_cols:
            sets[c] = F.when(in_d, F.col(f"_d_{c}")).otherwise(F.col(c))
        elif c in base.columns:
            sets[c] = F.when(in_b, F.col(c)).otherwise(F.col(f"_d_{c}"))
    if updated_at is not None:
        old = F.col("updated_at") if "updated_at" in base.columns else F.lit(None)
        sets["updated_at"] = F.when(in_d, updated_at).otherwise(old)
    sets["change"] = (F.when(in_b & in_d, "updated").when(in_d, "inserted")
                      .otherwise("unchanged"))
    return (j.withColumns(sets)
            .drop("_in_delta", "_in_base", *[f"_d_{c}" for c in carried]))
