"""Whitening of embeddings by an incremental eigendecomposition of their covariance.

Entries become integers x = floor(64 c) + 1000000; the fit list holds every distinct x vector
once. Each partition of the fit list keeps a spectrum (count, mean, eigenvalues and
eigenvectors of its centred scatter matrix) and adds one vector at a time: the centred vector
is a rank-one change, whose new eigenvalues are the roots of the secular equation between the
old ones. Directions that the change does not touch and directions of equal eigenvalues are
deflated first, and the weights are recomputed from the roots, so that the new eigenvectors
stay orthogonal. A direction not spanned yet joins the basis with eigenvalue 0. The spectra of
the partitions are combined by the same rank-one changes, one for each eigenvector and one for
the difference of the means, in a tree of small groups. A last pass over the fit list
(Rayleigh-Ritz) takes the covariance in the basis found and rotates the basis by its
eigenvectors, which removes what rounding the many updates have gathered.

A rank-one change costs d^3 for the basis and d^2 for the roots. A task holds one spectrum
(d^2 numbers), a combining group at most ``FAN`` of them, the driver one basis per vector
length. Sums are exact integers.

Defined results: rows whose vector is null, empty, or holds a null, a non-finite entry or one
of 2^55 and more (it has no x in 64 bits) are dropped; vectors of different lengths are
different spaces, each fitted by itself; repeated rows and null ids are kept, each with its
own result; components whose eigenvalue is not above 1e-12 of the largest do not exist (one
distinct vector has none, hence no rows); a deviation beyond 64 bits is null; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, pick

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
FAN = 16               # spectra combined by one group
TASK_ROWS = 1024       # a small fit list is spread over tasks of at least so many vectors
LEAST = 1e-12          # eigenvalues up to this share of the largest count as zero
EPS = np.finfo(float).eps

OUT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
       "identity_error double")


def valid(e: Column) -> Column:
    return F.coalesce((F.size(e) > 0) & F.forall(e, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < 2.0**55)), F.lit(False))


def coded(rows: DataFrame) -> DataFrame:
    """``(vec_id, x, dim)`` of the rows that take part."""
    rows = pick(rows, "vec_id", "embedding").where(valid(F.col("embedding")))
    return rows.select(F.col("vec_id").cast("bigint"), F.transform(
        "embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + SHIFT).alias("x"),
        F.size("embedding").alias("dim"))


# ------------------------------------------------------------ rank-one changes
def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z' and the matrix d_i - root_j, without cancellation.

    ``d`` is ascending and without ties, ``z`` without zeros. Root j lies between d_j and
    d_j+1 (the last one up to |z|^2 further). Each is sought as an offset from the nearer
    end by rational interpolation inside a shrinking bracket; all roots advance together.
    """
    m, z2 = len(d), (z * z)[:, None]
    if m == 1:
        return d + z2[0], -z2
    j = np.arange(m)
    gap = np.append(np.diff(d), z2.sum())
    half = gap / 2
    f = 1 + (z2 / (d[:, None] - d - half)).sum(0)
    right = f < 0
    right[-1] = False
    origin = j + right
    delta = d[:, None] - d[origin]
    low, high = np.where(right, -half, 0.0), np.where(right, 0.0, half)
    if f[-1] < 0:
        low[-1], high[-1] = half[-1], gap[-1] * (1 + 4 * EPS)
    t = (low + high) / 2
    below = j[:, None] <= j
    for _ in range(80):
        apart = delta - t
        q = z2 / apart
        slope = q / apart
        f = 1 + q.sum(0)
        off = np.abs(f) > 4 * EPS * (1 + np.abs(q).sum(0))
        if not off.any():
            break
        left = np.where(below, slope, 0.0).sum(0)
        total = slope.sum(0)
        rest = total - left
        high, low = np.where(f > 0, t, high), np.where(f < 0, t, low)
        first, second = apart[j, j], np.append(apart[j[1:], j[:-1]], 1.0)
        c = f - first * left - second * rest
        a = (first + second) * f - first * second * total
        b = first * second * f
        root = np.sqrt(np.abs(a * a - 4 * b * c))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = first[-1] + first[-1] ** 2 * left[-1] / (f[-1] - first[-1] * left[-1])
            step = np.where(np.isfinite(step) & (f * step < 0), step, -f / total)
        new = t + step
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        new = np.where(off, new, t)
        if (new == t).all():
            break
        t = new
    return d[origin] + t, delta - t


def merge_equal(d: np.ndarray, z: np.ndarray, u: np.ndarray, keep: np.ndarray, tol: float) -> None:
    """Rotate neighbours of (nearly) equal eigenvalue until one of them is untouched; in place."""
    at = np.flatnonzero(keep)
    i = at[0]
    for j in at[1:]:
        size = np.hypot(z[i], z[j])
        c, s = z[j] / size, z[i] / size
        if (d[j] - d[i]) * abs(c * s) <= tol:
            z[i], z[j] = 0.0, size
            u[:, i], u[:, j] = c * u[:, i] - s * u[:, j], s * u[:, i] + c * u[:, j]
            d[i], d[j] = d[i] * c * c + d[j] * s * s, d[i] * s * s + d[j] * c * c
            keep[i] = False
        i = j


class Spectrum:
    """Count, exact sums, mean and eigendecomposition of the centred scatter of some vectors."""

    def __init__(self, dim: int):
        self.n, self.sums = 0, [0] * dim
        self.mean, self.values, self.vectors = np.zeros(dim), np.zeros(0), np.zeros((dim, 0))

    def change(self, v: np.ndarray) -> None:
        """The decomposition after adding v v' to the scatter."""
        size = np.linalg.norm(v)
        if not size:
            return
        d, u = self.values, self.vectors
        z = u.T @ v
        if u.shape[1] < len(v):
            rest = v - u @ z
            rest -= u @ (u.T @ rest)
            out = np.linalg.norm(rest)
            if out > 1e-12 * size:
                u, d, z = np.column_stack([rest / out, u]), np.append(0.0, d), np.append(out, z)
        reach = np.sqrt(z @ z)
        tol = 8 * EPS * max(d[-1], reach * reach)
        keep = np.abs(z) * reach > tol
        if not keep.any():  # below the rounding of what is there
            return
        at = np.flatnonzero(keep)
        pair = z[at[:-1]] * z[at[1:]] / (z[at[:-1]] ** 2 + z[at[1:]] ** 2)
        if (np.diff(d[at]) * np.abs(pair) <= tol).any():
            d, u = d.copy(), u.copy()
            merge_equal(d, z, u, keep, tol)
            order = np.argsort(d, kind="stable")
            d, z, u, keep = d[order], z[order], u[:, order], keep[order]
        old, weight = d[keep], z[keep]
        roots, apart = secular_roots(old, weight)
        # weights for which the computed roots are exact (Gu and Eisenstat)
        ratio = old[:, None] - old
        np.fill_diagonal(ratio, 1.0)
        weight = np.copysign(np.sqrt(np.abs((apart / ratio).prod(axis=1))), weight)
        turn = weight[:, None] / apart
        turn /= np.sqrt((turn * turn).sum(0))
        d, u = d.copy(), u.copy()
        d[keep], u[:, keep] = roots, u[:, keep] @ turn
        order = np.argsort(d, kind="stable")
        self.values, self.vectors = d[order], u[:, order]

    def add(self, y: np.ndarray) -> None:
        apart = y - self.mean
        self.change(apart * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + apart / self.n

    def combine(self, other: Spectrum) -> None:
        apart, n = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.change(np.sqrt(value) * vector)
        self.change(np.sqrt(self.n * other.n / n) * apart)
        self.mean = self.mean + apart * (other.n / n)
        self.n, self.sums = n, [a + b for a, b in zip(self.sums, other.sums)]

    STATE = "dim int, slot bigint, n bigint, sums string, mean binary, values binary, vectors binary"

    def state(self, slot: int) -> tuple:
        return (len(self.mean), slot, self.n, ",".join(map(str, self.sums)), self.mean.tobytes(),
                self.values.tobytes(), self.vectors.tobytes())

    @classmethod
    def of(cls, row) -> Spectrum:
        s = cls(row.dim)
        s.n, s.sums = int(row.n), [int(x) for x in row.sums.split(",")]
        s.mean, s.values = np.frombuffer(row.mean), np.frombuffer(row.values)
        s.vectors = np.frombuffer(row.vectors).reshape(row.dim, -1)
        return s


# ---------------------------------------------------------------- passes over the fit list
def _vectors(batches, column: str = "x") -> Iterator[tuple[int, np.ndarray, object]]:
    """``(length, integers less SHIFT, rows)`` of each length in each batch."""
    for b in batches:
        dims = b.column(b.schema.get_field_index("dim")).to_numpy()
        for dim in np.unique(dims).tolist():
            part = b.filter(dims == dim) if (dims != dim).any() else b
            x = part.column(part.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False)
            yield dim, x.reshape(-1, dim) - SHIFT, part


def exact_sums(y: np.ndarray) -> list[int]:
    if len(y) and max(int(y.max()), -int(y.min())) * len(y) < 2**62:
        return y.sum(axis=0).tolist()
    return [sum(c) for c in zip(*y.tolist())]


def _spectra(batches):
    import pandas as pd
    import pyarrow as pa
    from pyspark import TaskContext

    names = [c.split()[0] for c in Spectrum.STATE.split(", ")]

    def row(s):
        return pa.RecordBatch.from_pandas(
            pd.DataFrame([s.state(TaskContext.get().partitionId())], columns=names).astype({"dim": "int32"}))

    now = None
    for dim, y, _ in _vectors(batches):
        if now is None or len(now.mean) != dim:
            if now is not None:
                yield row(now)
            now = Spectrum(dim)
        now.sums = [a + b for a, b in zip(now.sums, exact_sums(y))]
        for v in y.astype(float):
            now.add(v)
    if now is not None:
        yield row(now)


def _combine(group):
    import pandas as pd
    first, *rest = sorted(group.itertuples(index=False), key=lambda r: r.part)
    total = Spectrum.of(first)
    for r in rest:
        total.combine(Spectrum.of(r))
    return pd.DataFrame([total.state(int(first.slot))], columns=list(group.columns)[:-1])


def _add(group):
    import pandas as pd
    rows = sorted(group.itertuples(index=False), key=lambda r: r.part)
    total = sum(np.frombuffer(r.total) for r in rows)
    return pd.DataFrame([(rows[0].dim, int(rows[0].slot), total.tobytes())], columns=list(group.columns)[:-1])


def _tree(states: DataFrame, merge: Callable, schema: str, name: str) -> list:
    """One state per length: groups of at most ``FAN`` states are merged until one is left."""
    states = materialise(states, name)
    last = states.agg(F.max("slot")).first()[0]
    while last:
        last //= FAN
        states = materialise(states.withColumn("part", F.col("slot")).withColumn("slot", F.expr(f"slot div {FAN}"))
                             .groupBy("dim", "slot").applyInPandas(merge, schema), name)
    return states.collect()


def moments(fit: DataFrame, bases: dict[int, tuple[np.ndarray, np.ndarray]], name: str) -> dict[int, tuple]:
    """By length: vector count, squared distances to the mean, and the covariance in the basis given."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        totals: dict[int, np.ndarray] = {}
        for dim, y, _ in _vectors(batches):
            mean, basis = bases[dim]
            apart = y - mean
            p = apart @ basis
            part = np.concatenate([[len(y), np.einsum("ij,ij->", apart, apart)], p.sum(0), (p.T @ p).ravel()])
            totals[dim] = totals[dim] + part if dim in totals else part
        slot = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([slot] * len(totals), pa.int64()),
             pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["dim", "slot", "total"])

    schema = "dim int, slot bigint, total binary"
    out = {}
    for r in _tree(fit.mapInArrow(run, schema), _add, schema, name):
        total, k = np.frombuffer(r.total), bases[r.dim][1].shape[1]
        n, squares, sums = total[0], total[1], total[2:2 + k]
        out[r.dim] = (n, squares, total[2 + k:].reshape(k, k) / n - np.outer(sums, sums) / n**2)
    return out


class Model:
    """Whitening of vectors of one length: exact count and sums, components by falling eigenvalue."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, values: np.ndarray, explained: np.ndarray):
        self.n, self.sums, self.components, self.values, self.explained = n, sums, components, values, explained
        self.mean = np.array([s / n for s in sums])
        self.identity_error = 0.0

    @property
    def basis(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)

    def apart(self, y: np.ndarray) -> tuple[np.ndarray, list]:
        """``(x - S / n, the sum of (n x - S)^2 or None beyond 64 bits)`` of every row."""
        sums = np.array(self.sums, object)
        bound = self.n * max(abs(int(y.min())), abs(int(y.max()))) + max(map(abs, self.sums)) if len(y) else 0
        if bound * bound * y.shape[1] < 2**63:
            scaled = self.n * y - sums.astype(np.int64)
            return scaled / self.n, (scaled * scaled).sum(axis=1).tolist()
        scaled = y.astype(object) * self.n - sums
        deviation = [sum(v * v for v in row) for row in scaled.tolist()]
        return np.array([[v / self.n for v in row] for row in scaled.tolist()]), [v if v < 2**63 else None for v in deviation]


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """The whitening model of every vector length."""
    distinct = materialise(coded(rows).select("dim", "x").distinct(), "whiten-fit")
    spread = min(4 * rows.sparkSession.sparkContext.defaultParallelism, -(-distinct.count() // TASK_ROWS))
    wide = distinct.repartition(spread) if spread > distinct.rdd.getNumPartitions() else distinct
    spectra = [Spectrum.of(r) for r in _tree(wide.sortWithinPartitions("dim").mapInArrow(_spectra, Spectrum.STATE),
                                             _combine, Spectrum.STATE, "whiten-spectra")]
    bases = {}
    for s in spectra:
        bases[len(s.mean)] = (np.array([x / s.n for x in s.sums]), np.linalg.qr(s.vectors)[0])
    models = {}
    ritz = moments(distinct, bases, "whiten-ritz") if bases else {}
    for s in spectra:
        dim = len(s.mean)
        n, squares, inner = ritz[dim]
        values, turn = np.linalg.eigh(inner)
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > LEAST * values.max()] if len(values) else order
        vectors = bases[dim][1] @ turn[:, order]
        side = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]) if len(order) else np.ones(0)
        models[dim] = Model(s.n, s.sums, vectors * side, values[order], values[order] / (squares / n))
    white = {d: (m.mean, m.basis) for d, m in models.items()}
    for dim, (_, _, inner) in (moments(distinct, white, "whiten-check") if white else {}).items():
        models[dim].identity_error = float(np.abs(inner - np.eye(len(inner))).max()) if len(inner) else 0.0
    return models


def apply(rows: DataFrame, models: dict[int, Model]) -> DataFrame:
    """``OUT``: a row per vector and component."""
    def run(batches):
        import pyarrow as pa

        for dim, y, part in _vectors(batches):
            m = models.get(dim)
            if m is None:
                continue
            k = len(m.values)
            apart, deviation = m.apart(y)
            ids = part.column(part.schema.get_field_index("vec_id"))
            each = pa.array(np.repeat(np.arange(len(y)), k))
            yield pa.RecordBatch.from_arrays(
                [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                 pa.array(np.full(len(y) * k, m.n)), pa.array(deviation, pa.int64()).take(each),
                 pa.array((apart @ m.basis).ravel()), pa.array(np.tile(m.explained, len(y))),
                 pa.array(np.full(len(y) * k, m.identity_error))], names=[c.split()[0] for c in OUT.split(", ")])

    return coded(rows).mapInArrow(run, OUT)


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Fit on the distinct vectors of ``rows`` and whiten every row."""
    return apply(rows, fit(rows, components))
