"""Sharding by jump consistent hashing.

A stable key and a shard count decide the shard; no ring table is kept. When a shard is
appended, a row either stays or moves to the new shard, which takes its even share.

Slots number the rows of a shard without a gap: rows fall into buckets of a mixed key, bucket
counts (a narrow aggregate with map-side combine) give each bucket's first slot, and
windows run per (shard, bucket), so a shard is never ordered in one task.

Defined results: a null text has no bytes (size 1, CRC 0); a null id is placed like id -1 and
its bucket follows its text; repeated ids share a shard and have a slot each; an empty table
gives an empty result; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise, pick

SHARDS = 8
PER_BUCKET = 10_000

_STEP = np.uint64(2862933555777941757)  # fixed value: the generator of the published algorithm


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key (Lamping and Veach); all keys jump together."""
    key = keys.astype(np.uint64)
    at = np.zeros(len(key), np.int64)
    jump = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    with np.errstate(over="ignore"):
        while len(live):
            at[live] = jump[live]
            key[live] = key[live] * _STEP + np.uint64(1)
            scale = float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
            jump[live] = ((at[live] + 1) * scale).astype(np.int64)
            live = live[jump[live] < shards]
    return at


def mixed(keys: np.ndarray) -> np.ndarray:
    """The top 20 bits of one generator step."""
    with np.errstate(over="ignore"):
        return ((keys.astype(np.uint64) * _STEP + np.uint64(1)) >> np.uint64(44)).astype(np.int64)


def shard(docs: DataFrame, shards: int = SHARDS, per_bucket: int = PER_BUCKET) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per row."""
    docs = pick(docs, "doc_id", "text")
    shift = 20 - min(20, max(6, math.ceil(math.log2(max(1, docs.count() / per_bucket)))))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            ids = b.column(0).fill_null(-1).to_numpy().view(np.uint64)
            with np.errstate(over="ignore"):   # by id and text: the rows of one repeated id spread
                mix = mixed(ids ^ b.column(2).to_numpy().astype(np.uint64) * _STEP) >> shift
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(jump_hash(ids, shards), pa.int32()), pa.array(jump_hash(ids, shards + 1), pa.int32()),
                 pa.array(mix, pa.int32())], names=["doc_id", "size", "text_crc32", "shard", "grown_shard", "bucket"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = materialise(rows.mapInArrow(
        run, "doc_id bigint, size bigint, text_crc32 bigint, shard int, grown_shard int, bucket int"), "shard-rows")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = materialise(rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
                         .withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "shard-firsts")
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return rows.join(broadcast_if_small(firsts, 24), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("first") + F.row_number().over(inside) - 1).cast("bigint").alias("slot"), "grown_shard")
