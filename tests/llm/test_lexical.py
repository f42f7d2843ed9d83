"""Max-sketch search against exhaustive scoring and the stated SQL."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.llm import lexical, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    """``[(item position, item_id, rank, doc_id, score)]``: every document scored for every item."""
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    total, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for at, (item, text) in enumerate(items):
        scored = []
        for doc, c in counted:
            m = 100 - 25 + 25 * sum(c.values()) * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in words(text) if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if none else doc, -score) for r, (score, none, doc) in enumerate(sorted(scored)[:k])]
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0)


def run(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lexical.search(d, q, **settings).collect()), key=key)


def made(rng, n):
    vocabulary = [f"w{i}" for i in range(60)]
    p = 1 / np.arange(1, 61)
    return [(int(rng.integers(0, 200)), " ".join(rng.choice(vocabulary, rng.integers(1, 80), p=p / p.sum()))) for _ in range(n)]


@pytest.mark.parametrize("width, query_terms", [(8, 1 << 17), (64, 20), (4096, 1 << 17)])
def test_against_brute_force(spark, width, query_terms, monkeypatch):
    monkeypatch.setattr(lexical, "FIRST", 4)
    rng = np.random.default_rng(width)
    docs, items = made(rng, 300), [(i, t) for i, (_, t) in enumerate(made(rng, 15))]
    assert run(spark, docs, items, width=width, query_terms=query_terms) == sorted(brute(docs, items), key=key)


def test_op12_against_sql_and_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, queries.op12_lexical(spark, sf).collect()), key=key)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert got == sorted(con.execute(queries.OP12_SQL).fetchall(), key=key)
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    assert got == sorted(brute(docs, items), key=key)


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "alpha gamma"), (1, "alpha gamma"), (2, None), (3, ""), (4, "no such words at all zzzz"), (None, "word5 the MIT"),
             (5, "漢字 ünïcödé ÜNÏCÖDÉ AkIa"), (6, " ".join(["alpha"] * 500)), (7, "word1 " * 3 + "and7 spaced")]
    q = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in items], "item_id long, text string, n int, rank int, score int")
    odd = odd_docs.withColumn("n", odd_docs.doc_id).withColumn("terms", odd_docs.text).withColumn("rank", odd_docs.doc_id)
    got = sorted(map(tuple, lexical.search(odd, q).collect()), key=key)
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got == sorted(brute(docs, items), key=key) and any(r[2] is None for r in brute(docs, [(0, "nothing")]))
    assert lexical.search(no_docs, q).collect() == []
    assert lexical.search(odd, q.where("item_id = 2")).collect() == [] == lexical.search(odd, q.where("item_id < 0")).collect()


def test_ties_rank_by_document(spark):
    docs = [(i, "same words here") for i in range(50, 0, -1)] + [(None, "same words here")] + [(i, "other") for i in range(60, 90)]
    got = run(spark, docs, [(0, "words")])
    assert got == sorted(brute(docs, [(0, "words")]), key=key) and [r[2] for r in got] == list(range(1, 21))


def block(docs, q, total, length):
    counted = [(i, Counter(words(t))) for i, t in docs]
    part = pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in counted], pa.int64()), pa.array([sum(c.values()) for _, c in counted], pa.int64()),
         pa.array([list(c) for _, c in counted], pa.list_(pa.string())), pa.array([list(c.values()) for _, c in counted], pa.list_(pa.int64()))],
        names=["doc_id", "n", "terms", "tfs"])
    return lexical.Docs(part, q, total, length)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([1, 4, 32, 512]))
def test_bounds_are_never_below_scores(seed, width):
    rng = np.random.default_rng(seed)
    docs = [d for d in made(rng, 40) if d[1]]
    length = sum(len(t.split()) for _, t in docs)
    q = lexical.Queries([(i, *map(list, zip(*Counter({w: int(rng.integers(1, 9000)) for w in t.split()}).items())))
                         for i, (_, t) in enumerate(made(rng, 5))], width)
    d = block(docs, q, len(docs), length)
    bounds = lexical.upper_bounds(d, q)
    for i in range(5):
        exact = d.scores(np.arange(len(docs)), q.terms[i], q.weights[i])
        assert (bounds[:, i] >= exact).all()
        if width == 512:
            assert (bounds[:, i] <= exact * 1.3 + 1e6 * 9000).all()


def test_bounds_save_exact_scores():
    """With few matches among many documents most are never scored exactly."""
    rng = np.random.default_rng(4)
    docs = made(rng, 900)
    docs = [(i, t + (" rare unusual pair" if i % 300 < 30 else "")) for i, (_, t) in enumerate(docs)]
    q = lexical.Queries([(0, ["rare", "unusual", "w3"], [9000, 9000, 500])], 4096)
    best = lexical.Best(1, 20)
    taken = lexical.search_block(block(docs, q, 900, sum(len(t.split()) for _, t in docs)), q, best)
    assert len(best.score[0]) == 20 and taken < 300
