import numpy as np

from hearth.llm import embed_dedup
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<double>, label int"


def slow(rows):
    def good(r):
        v = r.embedding
        return (r.label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v))
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if good(a) and good(b) and a.label == b.label and len(a.embedding) == len(b.embedding):
                x, y = np.array(a.embedding, float), np.array(b.embedding, float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r.vec_id is not None:
            least[find(i)] = min(r.vec_id, least.get(find(i), r.vec_id))
    return sorted(((r.vec_id, links[i], least.get(find(i)), r.vec_id == least.get(find(i))) for i, r in enumerate(rows)), key=str)


def got(df, **options):
    return sorted((tuple(r) for r in embed_dedup.near_duplicates(df, **options).collect()), key=str)


def test_sf_against_brute_force(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    assert got(df) == slow(df.collect())


def test_many_cells_and_small_blocks_lose_no_link(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(6, 8))
    x = np.concatenate([c + 0.12 * rng.normal(size=(60, 8)) for c in centre])
    rows = [(i, [float(v) for v in r], i % 2) for i, r in enumerate(x)] + [(1000 + i, [float(v) for v in x[3]], 1) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = slow(df.collect())
    assert sum(w[1] for w in want) > 1000
    assert got(df, cell=20, block=16) == want


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
            (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [float("nan"), 1.0], 1), (10, [float("inf"), 1.0], 1), (11, [1.0, 0.0, 0.0], 1),
            (12, [1.0, 0.0], 2), (13, [1e-200, 0.0], 1), (14, [-1.0, -0.0], 1), (15, [1e200, 1e190], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "vec_id as cid", "label as cell", "vec_id as n", "vec_id as root", "1 as ok")
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(df).collect()}
    assert embed_dedup.near_duplicates(df).count() == len(rows)
    assert out[1] == (5, 1, True) and out[2] == (5, 1, False) and out[13] == (5, 1, False) and out[15] == (5, 1, False)
    for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 14):
        assert out[i] == (0, i, True)
    lone = spark.createDataFrame([(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)], SCHEMA)
    assert got(lone) == [(None, 1, None, True)] * 2
    assert got(df.limit(0)) == []


def test_pairs_at_the_threshold_are_judged_alike_in_every_block():
    rng = np.random.default_rng(3)
    x = embed_dedup.unit(rng.normal(size=300 * 40), 40)
    threshold = float(np.einsum("i,i->", x[7], x[211]))
    whole = embed_dedup.linked(x, x, threshold)
    for size in (1, 7, 64):
        parts = [np.hstack([embed_dedup.linked(x[i:i + size], x[j:j + size], threshold) for j in range(0, 300, size)])
                 for i in range(0, 300, size)]
        assert (np.vstack(parts) == whole).all()
    assert (whole == whole.T).all()
