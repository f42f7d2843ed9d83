import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import neighbours
from tests.conftest import SF001, SF01


def slow(rows, step, k):
    ok = {}
    for r in rows:
        v = r.embedding
        if r.vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[r.vec_id] = min(list(v), ok.get(r.vec_id, list(v)))
    out = {}
    for q in (i for i in ok if i % step == 0):
        near = [(-float(np.einsum("ij,ij->i", np.array([ok[q]], float), np.array([v], float))[0]), i)
                for i, v in ok.items() if i != q and len(v) == len(ok[q])]
        out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def got(df, step, **options):
    out = {}
    for r in neighbours.nearest(df, F.col("vec_id") % step == 0, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sf", [SF001, SF01, "/root/testdata/sf0.1"])
def test_recall(spark, sf, monkeypatch):
    """The path of the query: every vector in a bucket of each table, no table in one bucket."""
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    indexes, compare = [], neighbours._compare
    monkeypatch.setattr(neighbours, "_compare", lambda index, *a: (indexes.append(index), compare(index, *a))[1])
    want, mine = slow(df.collect(), 20, 20), got(df, 20)
    per_table = indexes[0].groupBy("t").agg(F.count_distinct("bucket").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    assert len(indexes) == 1 and len(per_table) == neighbours.TABLES
    assert all(r.b > 100 and r.n == df.count() for r in per_table)
    found = sum(len(set(want[q]) & set(mine[q])) for q in want)  # with exactly the same scores
    assert found / sum(map(len, want.values())) >= 0.9


def test_all_probes_are_exact_in_small_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(150)] + [(200 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 0.5]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df, 10, k=5, tables=1, probes=16, block=16) == slow(df.collect(), 10, 5)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.0]), (20, [0.5, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, []),
            (6, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (7, [-3.0, 0.0]), (8, [9.0, 0.0]), (9, [9.0, 0.0]), (40, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "vec_id as rank", "vec_id as t", "vec_id as dim")
    assert got(df, 20, probes=4) == {q: w for q, w in slow(df.collect(), 20, 20).items() if w}
    assert got(df.limit(0), 20) == {}


@pytest.mark.parametrize("n", [10, 15, 25, 60, 100, 200])
def test_small_tables(spark, n):
    rng = np.random.default_rng(n)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=64)]) for i in range(n)],
                               "vec_id long, embedding array<double>")
    mine, want = got(df, 5), slow(df.collect(), 5, 20)
    assert all(len(mine[q]) == len(want[q]) for q in want)
    found = sum(len(set(want[q]) & set(mine[q])) for q in want)
    assert found / sum(map(len, want.values())) >= (1 if n <= 25 else 0.9)


def test_inner_products_beyond_double_precision(spark):
    big = 1e200
    rows = [(0, [big, big, 1.0]), (1, [big, 0.0, 0.0]), (2, [-big, 0.0, 0.0]), (3, [big, -big, 0.0]), (4, [1.0, 2.0, 3.0]),
            (5, [-1.0, 0.0, 0.0]), (6, [0.0, 0.0, 1.0])]
    mine = got(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 10)[0]
    assert [i for i, _ in mine] == [1, 4, 6, 5, 2, 3]
    assert mine[0][1] == np.inf and mine[4][1] == -np.inf and np.isnan(mine[5][1]) and mine[2][1] == 1.0


def test_queries_of_too_few_hits_are_compared_with_all(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=64)]) for i in range(90)],
                               "vec_id long, embedding array<double>")
    assert got(df, 10, tables=1, probes=1, block=16) == slow(df.collect(), 10, 20)


def test_probes_follow_the_number_of_axes():
    assert [neighbours.probes_of(2 ** i, 10**6) for i in (1, 4, 5, 7)] == [2, 16, 24, 24]
    assert [neighbours.probes_of(128, n, 20) for n in (1, 25, 60, 128, 300)] == [128, 128, 86, 40, 24]
    rng = np.random.default_rng(5)
    x = rng.normal(size=(5000, 384))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = np.arange(0, 5000, 100)
    near = x[q] @ x.T
    near[np.arange(len(q)), q] = -np.inf
    want = np.argsort(-near, axis=1)[:, :20]
    met = np.zeros(want.shape, bool)
    for t in range(neighbours.TABLES):
        close = neighbours.axes(x, t)
        probed = np.argsort(-close[q], axis=1)[:, :neighbours.probes_of(close.shape[1], 5000)]
        met |= (close.argmax(axis=1)[want][:, :, None] == probed[:, None, :]).any(axis=2)
    assert met.mean() >= 0.9
