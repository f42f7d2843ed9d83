"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns unit vectors by fast Hadamard pseudo-rotations (sign flips and Hadamard
transforms, three rounds) and hashes a vector to its nearest signed axis. Every vector is
indexed in one bucket of each table; a query probes the buckets of its ``probes`` nearest
axes. Candidates of a bucket are reranked exactly, in blocks, by the inner product of the
original vectors in double precision; a task returns the best k of a query in its block.
The share of axes probed grows with their number, as near vectors of many dimensions are
less near, and with k over the number of vectors, as the k nearest of few vectors are not
near; every table is hashed, whatever its size. A query that finds fewer than
min(k, candidates) is compared with all vectors of its length, block by block.

Defined results: vectors that are null, zero or hold null or non-finite components, and null
ids, take no part; vectors meet only vectors of their length; repeated equal rows count once,
and an id with several vectors takes part with the smallest in array order; ties go to the
smaller id; with fewer than k candidates in the table, all of them; an inner product beyond
double precision is infinite and ranks so, one that is no number (infinite parts of both signs)
is NaN and ranks last; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise, pick, run_bounds, sorted_runs
from .embed_dedup import unit, valid

K = 20
TABLES = 6
PROBES = 24            # of the 2 * 64 signed axes of a 64-dimensional table; at least so many at every size
BLOCK = 4096           # vectors, and queries, of one bucket compared at once
SEED = 7
BOUND = float(np.finfo(np.float64).max) / 2


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), n)
        h *= 2
    return x


def axes(x: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """Closeness of each unit row to every signed axis of a table's rotated space."""
    size = 1 << max(0, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), size))
    y[:, :x.shape[1]] = x
    for r in range(3):
        signs = np.random.default_rng([seed, table, r, size]).choice([-1.0, 1.0], size)
        y = hadamard(y * signs) / np.sqrt(size)
    return np.concatenate((y, -y), axis=1)


def probes_of(signed: int, n: int, k: int = K) -> int:
    """How many of the signed axes are probed by a query among ``n`` vectors.

    A share of 24 / 128 at 2^7 axes, more by the logarithm at others, and at least twice k / n.
    """
    near = -(-PROBES * signed * (signed.bit_length() - 1) // (128 * 7))
    return min(signed, max(PROBES, near, -(-2 * k * signed // max(n, 1))))


def _codes(tables: int, probes: int | None, k: int):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            dims = b.column(2).to_numpy()
            code = np.zeros((b.num_rows, tables), np.int32)
            probe: list = [None] * b.num_rows
            asks = b.column(3).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = unit(b.column(1).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), int(dim))
                near = [axes(x, t) for t in range(tables)]
                for t in range(tables):
                    code[at, t] = near[t].argmax(axis=1)
                signed = near[0].shape[1]
                p = probes_of(signed, b.column(4)[int(at[0])].as_py(), k) if probes is None else min(probes, signed)
                q = np.flatnonzero(asks[at])
                best = [np.argsort(-near[t][q], axis=1, kind="stable")[:, :p] for t in range(tables)]
                for i, row in enumerate(at[q]):
                    probe[row] = [best[t][i].tolist() for t in range(tables)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(code.tolist(), pa.list_(pa.int32())),
                 pa.array(probe, pa.list_(pa.list_(pa.int32())))],
                names=["vec_id", "embedding", "dim", "asks", "n", "codes", "probes"])
    return run


KEYS = ["dim", "t", "bucket", "vb", "qb"]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products for ranking: finite always, in the order infinite, finite, minus infinite, no number."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = a @ b.T
        odd = np.argwhere(~np.isfinite(out))
        for s in range(0, len(odd), 4096):      # a block product may mix partial sums; take these one by one
            i, j = odd[s:s + 4096].T
            one = np.einsum("ij,ij->i", a[i], b[j])
            out[i, j] = np.where(np.isnan(one), -BOUND, np.clip(one, -BOUND / 2, BOUND))
    return out


def _rerank(k: int):
    def run(batches):
        import pyarrow as pa
        for table in sorted_runs(batches, KEYS):
            bounds = run_bounds(table, KEYS)
            for s, e in zip(bounds[:-1], bounds[1:]):
                part = table.slice(s, e - s)
                dim = part["dim"][0].as_py()
                x = part["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
                x = x.astype(np.float64).reshape(-1, dim)
                n = int(np.count_nonzero(part["side"].to_numpy() == 0))
                ids = part["vec_id"].to_numpy()
                out = []
                for q in range(n, e - s, 256):
                    asked = np.arange(q, min(q + 256, e - s))
                    near = products(x[asked], x[:n])
                    near[ids[asked][:, None] == ids[None, :n]] = -np.inf
                    least = np.partition(near, n - k, axis=1)[:, n - k] if n > k else np.full(len(asked), -np.inf)
                    margin = 1e-12 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
                    i, j = np.nonzero((near >= (least - margin)[:, None]) & (near > -np.inf))
                    with np.errstate(over="ignore", invalid="ignore"):
                        exact = np.einsum("ij,ij->i", x[asked[i]], x[j])  # the same sum in whatever block
                    order = np.lexsort((ids[j], -exact, i))  # NaN is last
                    i, j, exact = i[order], j[order], exact[order]
                    rank = np.arange(len(i)) - np.searchsorted(i, i)
                    top = rank < k
                    out.append((ids[asked[i[top]]], ids[j[top]], exact[top]))
                cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["query_id", "vec_id", "score"])
    return run


def _compare(index: DataFrame, asked: DataFrame, k: int, block: int, name: str) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest of each query among the vectors of its buckets.

    A bucket's vectors and queries are cut into blocks by counted size; every pair of
    blocks is one bounded group.
    """
    at = ["dim", "t", "bucket"]
    blocks = lambda n: F.ceil(F.count(F.lit(1)) / block).cast("int").alias(n)
    sizes = materialise(index.groupBy(*at).agg(blocks("vbs")).join(asked.groupBy(*at).agg(blocks("qbs")), at), name)
    sizes = broadcast_if_small(sizes, 48)
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    left = index.join(sizes, at).select(*at, own("vbs").alias("vb"), F.explode(F.expr("sequence(0, qbs - 1)")).alias("qb"),
                                        F.lit(0).alias("side"), "vec_id", "embedding")
    right = asked.join(sizes, at).select(*at, F.explode(F.expr("sequence(0, vbs - 1)")).alias("vb"), own("qbs").alias("qb"),
                                         F.lit(1).alias("side"), "vec_id", "embedding")
    found = (left.unionByName(right).repartition(*KEYS).sortWithinPartitions(*KEYS, "side", "vec_id")
             .mapInArrow(_rerank(k), "query_id bigint, vec_id bigint, score double"))
    # a candidate found by several tables has one rank: it ties with itself only
    order = Window.partitionBy("query_id").orderBy(F.isnan("score"), F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k)
            .dropDuplicates(["query_id", "rank"]).select("query_id", "rank", "vec_id", "score"))


def nearest(rows: DataFrame, is_query: Column, k: int = K, tables: int = TABLES, probes: int | None = None,
            block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of every query row.

    ``is_query`` is an expression over ``vec_id``; without ``probes`` their number follows
    from the number of axes.
    """
    rows = pick(rows, "vec_id", "embedding").where(valid(F.col("embedding")) & F.col("vec_id").isNotNull())
    one = rows.groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(F.min("embedding").alias("embedding"))
    base = materialise(one.select("vec_id", "embedding", F.size("embedding").alias("dim"), is_query.alias("asks")), "neighbour-rows")
    lengths = materialise(base.groupBy("dim").agg(F.count(F.lit(1)).alias("n")), "neighbour-lengths")
    base = base.join(broadcast_if_small(lengths, 16), "dim").select("vec_id", "embedding", "dim", "asks", "n")
    coded = materialise(base.mapInArrow(_codes(tables, probes, k), base.schema.simpleString().removeprefix("struct<")
                                        .removesuffix(">") + ",codes:array<int>,probes:array<array<int>>"), "neighbour-codes")
    index = coded.select("vec_id", "embedding", "dim", F.posexplode("codes").alias("t", "bucket"))
    asked = (coded.where("asks").select("vec_id", "embedding", "dim", F.posexplode("probes").alias("t", "b"))
             .select("vec_id", "embedding", "dim", "t", F.explode("b").alias("bucket")))
    best = materialise(_compare(index, asked, k, block, "neighbour-sizes"), "neighbour-best")
    hits = best.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("hits"))
    short = materialise(coded.where("asks").select("vec_id", "embedding", "dim", "n").join(hits, "vec_id", "left")
                        .where(F.coalesce("hits", F.lit(0)) < F.least(F.lit(k), F.col("n") - 1))
                        .select("vec_id", "embedding", "dim"), "neighbour-short")
    if short.isEmpty():
        return best
    whole = [F.lit(0).alias("t"), F.lit(0).alias("bucket")]
    rest = _compare(coded.select("vec_id", "embedding", "dim", *whole), short.select("*", *whole), k, block,
                    "neighbour-short-sizes")
    return best.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
