"""Helpers shared by the operators: written intermediates, size-checked broadcasts,
block-wise link search inside a group, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

# A table is broadcast only when its counted rows stay under this size.
BROADCAST_BYTES = 16 * 1024 * 1024


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and reread it.

    Cuts the lineage with files every executor can read, and gives a later join
    two plain scans, so that adaptive execution can split a hot key.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int, more: Column | None = None) -> DataFrame:
    """Hint a broadcast when ``rows * row_bytes`` is under the bound; else leave the join to shuffle.

    ``df`` should be a written table: its rows are counted. ``more`` is what a row holds beyond
    ``row_bytes`` (its arrays and texts); it is summed.
    """
    if more is None:
        size = df.count() * row_bytes
    else:
        rows, beyond = df.agg(F.count(F.lit(1)), F.sum(more)).first()
        size = rows * row_bytes + (beyond or 0)
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named input columns only, so that other columns never clash with derived names."""
    return df.select(*[df[n] for n in names])


def fresh(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it (names differ in case only count as equal)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def min_nulls_last(col: str) -> list:
    """Sort key fields under which a null is larger than every value."""
    return [F.col(col).isNull(), F.col(col)]


# ------------------------------------------------------------ links inside a group
def group_roots(n: int, linked: Callable[[np.ndarray, np.ndarray], np.ndarray],
                chunk: int = 256) -> np.ndarray:
    """Index of the first member of each row's connected group.

    ``linked(a, b)`` gives the boolean link matrix between two index arrays. The
    search expands every row once against the rows not reached yet, a chunk at a
    time, so a dense group of m rows costs m*m/2 tests and no list of pairs.
    """
    root = np.full(n, -1, np.int64)
    left = np.arange(n)
    while len(left):
        seed = left[0]
        root[seed] = seed
        left, front = left[1:], np.array([seed])
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            for i in range(0, len(front), chunk):
                todo = np.flatnonzero(~hit)
                if not len(todo):
                    break
                hit[todo] = linked(front[i:i + chunk], left[todo]).any(axis=0)
            front, left = left[hit], left[~hit]
            root[front] = seed
    return root


def sorted_runs(batches: Iterator, keys: list[str]) -> Iterator:
    """Tables holding whole runs of equal ``keys`` from batches sorted by them.

    Only the unfinished last run is carried to the next batch, so memory is one
    batch plus the longest run.
    """
    import pyarrow as pa

    carry = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if carry is not None:
            t = pa.concat_tables([carry, t]).combine_chunks()
        n = t.num_rows
        same = np.ones(n, bool)
        for k in keys:
            v = t[k].to_numpy()
            same &= v == v[-1]
        cut = n - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield t.slice(0, cut)
        carry = t.slice(cut)
    if carry is not None and carry.num_rows:
        yield carry


def run_bounds(t, keys: list[str]) -> np.ndarray:
    """Start offsets of the runs of equal ``keys`` in a sorted table, plus its length."""
    n = t.num_rows
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        v = t[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), n)


# ------------------------------------------------------------ connected components
def components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, root)`` of every node of ``edges(src, dst)``; the root is the smallest node reachable.

    Alternating large-star and small-star rounds over written edge tables. Each
    round's minima are an aggregate with map-side combine, written before they
    are joined, so a hub with most of the edges is split by the skew join. Nothing
    is collected; the driver sees one count and one checksum per round.
    """
    def canonical(df, a, b):
        return (df.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())

    def fingerprint(df):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    e = materialise(canonical(edges, "src", "dst"), f"{name}-edges")
    seen = fingerprint(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-low")
        e = canonical(both.join(low, "u").where("v > u").select("v", "m"), "v", "m")
        e = materialise(e, f"{name}-large")
        low = materialise(e.groupBy("u").agg(F.min("v").alias("m")), f"{name}-low")
        e = materialise(canonical(e.join(low, "u").select(F.col("v").alias("a"), "m")
                                  .unionByName(low.select(F.col("u").alias("a"), "m")), "a", "m"),
                        f"{name}-small")
        now = fingerprint(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
