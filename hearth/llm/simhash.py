"""SimHash near-dedup with covering locality-sensitive hashing.

A document's fingerprint has bit i set when over half of its word-shingle hashes
(XXH64, seed 42) have it set. Fingerprints at up to ``radius`` differing bits are
linked. The candidate search is exact: bit position i carries a non-zero vector
m(i) of radius+1 bits, and table v keeps the positions whose dot product with v is
odd. For any ``radius`` positions some v is orthogonal to all of them, so every
pair within the radius agrees on all bits kept by some table and shares its bucket.

Defined results: a null or blank text has fingerprint 0 and links like any other; a
text of fewer words than a shingle is one shingle of all its words; repeated rows and
equal texts share a fingerprint class and are never expanded into pairs; an empty
table gives an empty result; null ids sort after all others (a group of null ids only
has a null component_id); columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (broadcast_if_small, components, fresh, group_roots, materialise, min_nulls_last,
                     pick, run_bounds, sorted_runs)

BITS = 64
SHINGLE = 3
RADIUS = 3
SEED = 42
# Distinct fingerprints of one bucket compared in one task; larger buckets are
# split into pairs of blocks, which together test the same pairs.
BLOCK = 4096


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the UTF-8 bytes of a text."""
    import xxhash

    joined = b" ".join(text.lower().split())  # bytes: lowers A-Z only, splits at \x20 \x09-\x0D
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    n = max(1, len(gaps) + 2 - shingle)
    starts = np.concatenate(([0], gaps[:n - 1] + 1)).tolist()
    ends = np.append(gaps[shingle - 1:], len(joined)).tolist() if n > 1 or len(gaps) >= shingle - 1 else [len(joined)]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 16):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i:i + (1 << 16)], ends[i:i + (1 << 16)])],
                          np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_hash, fp)`` per row; one pass over whole texts, no shuffle."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            fps = [fingerprint(t.as_py() or b"", shingle) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())],
                                             names=["doc_id", "text_hash", "fp"])

    docs = pick(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"),
                       F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One signed 64-bit mask per non-zero vector of radius+1 bits."""
    vectors = 2 ** (radius + 1) - 1
    masks = []
    for v in range(1, vectors + 1):
        m = sum(1 << i for i in range(bits) if bin((i % vectors + 1) & v).count("1") % 2)
        masks.append(m - (1 << bits) if m >= 1 << (bits - 1) else m)
    return masks


def _linked_in_runs(radius: int):
    def run(batches):
        import pyarrow as pa
        for t in sorted_runs(batches, ["t", "key", "a", "b"]):
            bounds = run_bounds(t, ["t", "key", "a", "b"])
            fp = t["fp"].to_numpy()
            x = fp.view(np.uint64)
            src, dst = [], []
            for s, e in zip(bounds[:-1], bounds[1:]):
                y = x[s:e]
                root = group_roots(e - s, lambda i, j: np.bitwise_count(y[i][:, None] ^ y[j][None, :]) <= radius)
                more = np.flatnonzero(root != np.arange(e - s))
                src.append(fp[s:e][more])
                dst.append(fp[s:e][root[more]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))],
                                             names=["src", "dst"])
    return run


def links(classes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges ``(src, dst)`` whose components are those of all distinct ``fp`` within the radius."""
    masks = covering_masks(radius)
    tables = classes.select("fp", F.inline(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)])))
    buckets = materialise(tables.groupBy("t", "key")
                          .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
                          .where("n > 1"), "simhash-buckets")
    pairs = (buckets.where((F.col("n") == 2) & (F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) <= radius))
             .select(F.col("lo").alias("src"), F.col("hi").alias("dst")))
    larger = buckets.where("n > 2").select("t", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    members = (tables.join(broadcast_if_small(larger, 32), ["t", "key"])
               .select("t", "key", "fp", own.alias("own"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
               .select("t", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp"))
    by = ["t", "key", "a", "b"]
    found = (members.repartition(*by).sortWithinPartitions(*by, "fp")
             .mapInArrow(_linked_in_runs(radius), "src bigint, dst bigint"))
    return pairs.unionByName(found)


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``(doc_id, text_hash, fp, root, component_id)`` per row of ``docs``."""
    rows = materialise(fingerprints(docs, shingle), "simhash-rows")
    # one row per distinct fingerprint: copies never meet in a bucket
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    roots = components(links(classes, radius, block), "simhash")
    placed = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id")
    smallest = materialise(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-smallest")
    found = materialise(materialise(placed, "simhash-placed").join(smallest, "root")
                        .select("fp", "root", "component_id"), "simhash-found")
    return rows.join(found, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one document of each group: its smallest (doc_id, text hash).

    All columns are kept. Losers are removed by an anti join on (doc_id, text hash), so
    texts are shuffled only when the losers are too many to broadcast.
    """
    groups = materialise(simhash_groups(docs, shingle, radius), "simhash-groups")
    order = F.struct(*[c.alias(f"k{i}") for i, c in enumerate([*min_nulls_last("doc_id"), F.col("text_hash")])])
    winners = materialise(groups.groupBy("root").agg(F.min(order).alias("w")), "simhash-winners")
    judged = groups.join(winners, "root").withColumn("lost", order != F.col("w"))
    cases = materialise(judged.groupBy("doc_id", "text_hash")
                        .agg(F.max("lost").alias("lost"), F.count(F.lit(1)).alias("n"))
                        .where("lost or n > 1"), "simhash-cases")
    lost_id, lost_hash = fresh("lost_id", docs), fresh("lost_hash", docs)
    losers = broadcast_if_small(cases.where("lost").select(F.col("doc_id").alias(lost_id),
                                                           F.col("text_hash").alias(lost_hash)), 32)
    kept = docs.join(losers, docs["doc_id"].cast("bigint").eqNullSafe(F.col(lost_id))
                     & (F.xxhash64(docs["text"]) == F.col(lost_hash)), "left_anti")
    if cases.where("not lost").isEmpty():
        return kept
    # repeated winners: the same id and text more than once
    text_hash = fresh("text_hash", docs)
    return kept.withColumn(text_hash, F.xxhash64("text")).dropDuplicates(["doc_id", text_hash]).drop(text_hash)
