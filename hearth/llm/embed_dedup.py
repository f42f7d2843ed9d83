"""Embedding near-dedup: spherical k-means cells and blocked cosine products.

Equal vectors of a label form one class first. Spherical k-means, fitted on a bounded sample
of classes, assigns every class to a home cell. A linked vector can lie across a cell's
boundary only within the chord of the threshold, so a class is also copied to every cell whose
bisecting plane is that near: all neighbours of a class are in its home cell, and no link is
lost. Each home row is compared with all rows of its cell in blocks of bounded size; a task
returns link counts and a spanning forest, never pairs. Components come from the forests.

Defined results: labels that are null, and vectors that are null, zero or hold null or
non-finite components link with nothing and are kept; vectors of other lengths never link;
repeated rows are rows of one class and link with each other; null ids never win a group
that has another id, and are kept only where the component has no id; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, components, group_roots, materialise, pick, run_bounds, sorted_runs

THRESHOLD = 0.98
CELL = 2048            # classes of one label that a cell should hold
MAX_CELLS = 1024
SAMPLE = 20_000        # classes the cells are fitted on
BLOCK = 2048           # rows of either side compared at once
EDGE = 1e-12           # rounding of a blocked product of unit vectors stays far below this


def valid(vector) -> F.Column:
    """Not null, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit rows by cosine; empty cells keep their last centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        size = np.linalg.norm(total, axis=1)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    return c


def fit_cells(classes: DataFrame, cell: int = CELL, max_cells: int = MAX_CELLS, sample: int = SAMPLE) -> np.ndarray | None:
    """Centroids from a bounded sample (smallest id hashes) of the commonest vector length; None for one cell."""
    size = classes.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("dim", "n"), F.max("n")).first()
    if size[1] is None or size[1] <= cell:
        return None
    some = (classes.where(F.col("dim") == size[0]).orderBy(F.xxhash64("cid"), "cid").limit(sample)
            .select("embedding").toArrow())
    flat = some["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return spherical_kmeans(unit(flat, size[0]), min(max_cells, math.ceil(size[1] / cell)))


def distances(centroids: np.ndarray) -> np.ndarray:
    """Distance of every two centroids, a row at a time: memory is one table of cells by cells."""
    return np.stack([np.linalg.norm(centroids - c, axis=1) for c in centroids])


def near_cells(x: np.ndarray, centroids: np.ndarray, apart: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit row, and the matrix of cells that a linked vector may call home.

    x and a linked y (chord at most sqrt(2 - 2 threshold)) lie in cells h and j only if x is
    within that chord of the plane between the two centroids (``apart``: their distances).
    """
    dots = x @ centroids.T
    home = dots.argmax(axis=1)
    gap = dots[np.arange(len(x)), home][:, None] - dots
    return home, gap <= apart[home] * (math.sqrt(2 - 2 * threshold) + 1e-9) + 1e-12


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which unit rows of ``a`` and ``b`` have a cosine of at least ``threshold``.

    The last bits of a blocked product depend on the block. Pairs within ``EDGE`` of the
    threshold are summed by themselves, so that a pair is judged alike from either side.
    """
    dots = a @ b.T
    hit = dots >= threshold - EDGE
    if hit.any():
        i, j = np.nonzero(hit & (dots < threshold + EDGE))
        hit[i, j] = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
    return hit


def _assign(centroids, threshold):
    def run(batches):
        import pyarrow as pa
        apart = distances(centroids) if centroids is not None else None
        for b in batches:
            dims = b.column(3).to_numpy()
            homes = np.zeros(b.num_rows, np.int32)
            cells: list = [[0]] * b.num_rows
            at = np.flatnonzero(dims == centroids.shape[1]) if centroids is not None else ()
            for part in (at[i:i + 256] for i in range(0, len(at), 256)):
                x = unit(b.column(2).take(pa.array(part)).flatten().to_numpy(zero_copy_only=False), centroids.shape[1])
                homes[part], near = near_cells(x, centroids, apart, threshold)
                for row, cell in zip(part, near):
                    cells[row] = np.flatnonzero(cell).tolist()
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(homes, pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
                names=["cid", "label", "embedding", "dim", "n", "home", "cells"])
    return run


def _compare(threshold):
    keys = ["label", "dim", "cell", "hb", "ab"]

    def run(batches):
        import pyarrow as pa
        for t in sorted_runs(batches, keys):
            bounds = run_bounds(t, keys)
            out = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                part = t.slice(s, e - s)
                dim = part["dim"][0].as_py()
                x = unit(part["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False), dim)
                left = int(np.count_nonzero(part["side"].to_numpy() == 0))
                cid, n = part["cid"].to_numpy(), part["n"].to_numpy()
                links = np.zeros(left, np.int64)
                touched = np.zeros(e - s, bool)
                for i in range(0, left, 512):
                    j = min(i + 512, left)
                    hit = linked(x[i:j], x[left:], threshold)
                    hit &= cid[i:j, None] != cid[None, left:]
                    links[i:j] = hit @ n[left:]
                    touched[i:j] = hit.any(axis=1)
                    touched[left:] |= hit.any(axis=0)
                if not touched.any():
                    continue
                ids, first, back = np.unique(cid[touched], return_index=True, return_inverse=True)
                y = x[touched][first]
                root = group_roots(len(ids), lambda a, b: linked(y[a], y[b], threshold))
                out.append((cid[touched], np.append(links, np.zeros(e - s - left, np.int64))[touched], ids[root[back]]))
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["cid", "links", "root"])
    return run


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, cell: int = CELL, max_cells: int = MAX_CELLS,
                    sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``rows(vec_id, embedding, label)``."""
    rows = pick(rows, "vec_id", "embedding", "label").select(
        F.col("vec_id").cast("bigint"), "embedding", F.col("label").cast("bigint"),
        (valid(F.col("embedding")) & F.col("label").isNotNull()).alias("ok"))
    classes = materialise(rows.where("ok").groupBy("label", "embedding")
                          .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                          .select(F.monotonically_increasing_id().alias("cid"), "label", "embedding",
                                  F.size("embedding").alias("dim"), "n", "first_id"), "embed-classes")
    centroids = fit_cells(classes, cell, max_cells, sample)
    placed = materialise(classes.select("cid", "label", "embedding", "dim", "n").mapInArrow(
        _assign(centroids, threshold), classes.select("cid", "label", "embedding", "dim", "n").schema.simpleString()
        .removeprefix("struct<").removesuffix(">") + ",home:int,cells:array<int>"), "embed-cells")
    copies = placed.select("cid", "label", "embedding", "dim", "n", "home", F.explode("cells").alias("cell"))
    where = ["label", "dim", "cell"]
    sizes = materialise(copies.groupBy(*where).agg(
        F.ceil(F.count_if(F.col("home") == F.col("cell")) / block).cast("int").alias("hbs"),
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("abs")).where("hbs > 0"), "embed-sizes")
    members = copies.join(broadcast_if_small(sizes, 64), where)
    at = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    keep = [*where, "cid", "n", "embedding"]
    left = members.where("home = cell").select(*keep, at("hbs").alias("hb"),
                                               F.explode(F.expr("sequence(0, abs - 1)")).alias("ab"), F.lit(0).alias("side"))
    right = members.select(*keep, F.explode(F.expr("sequence(0, hbs - 1)")).alias("hb"), at("abs").alias("ab"),
                           F.lit(1).alias("side"))
    by = [*where, "hb", "ab"]
    found = materialise(left.unionByName(right).repartition(*by).sortWithinPartitions(*by, "side", "cid")
                        .select(*by, "side", "cid", "n", "embedding")
                        .mapInArrow(_compare(threshold), "cid bigint, links bigint, root bigint"), "embed-found")
    roots = components(found.where("cid <> root").select(F.col("cid").alias("src"), F.col("root").alias("dst")), "embed")
    per_class = found.groupBy("cid").agg(F.sum("links").alias("links"))
    judged = materialise(classes.select("cid", "first_id", "n").join(per_class, "cid", "left")
                         .join(roots, F.col("cid") == F.col("node"), "left")
                         .select("cid", "first_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                 F.coalesce("root", "cid").alias("root")), "embed-judged")
    smallest = materialise(judged.groupBy("root").agg(F.min("first_id").alias("component_id")), "embed-smallest")
    result = materialise(classes.join(judged.join(smallest, "root").select("cid", "n_links", "component_id"), "cid")
                         .select(F.col("label").alias("l"), F.col("embedding").alias("e"), "n_links", "component_id"),
                         "embed-result")
    linked = (rows.where("ok").join(result, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")))
              .select("vec_id", "n_links", "component_id"))
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
