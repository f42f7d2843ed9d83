import re

import pytest
from pyspark.sql import functions as F

from hearth.llm import mixing
from tests.conftest import SF001

WORD = re.compile("[^\x20\x09-\x0d]+")


def slow_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > 2 * sizes[s]]
        if not over:
            out.update({s: level * w[s] for s in free})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def check(docs):
    rows = docs.collect()
    size = {}
    for r in rows:
        size[r.source] = size.get(r.source, 0) + len(WORD.findall(r.text or ""))
    want = slow_targets(size)
    got = mixing.plan(docs, ["doc_id", "source"]).select("row.*", "*").collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == size[r.source]
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(c.words for c in r.copies)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        times = [c.position for c in r.copies]
        assert times == sorted(times) and all(0 <= t <= 1 for t in times)
    for s, t in taken.items():
        assert t == int(want[s])
    return sorted(map(str, got))


def test_sf_targets_and_taken_words(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert check(docs) == check(docs.repartition(5))


def test_hot_source_is_split_and_exact(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', cast(id % 37 as int)) as text",
                                        "case when id % 3 = 0 then 'hot' else concat('s', id % 11) end as source")
    assert check(docs) == check(docs.repartition(7))


def test_inverse_of_the_schedule(spark):
    for knots in mixing.SCHEDULES:
        got = spark.range(101).select(mixing.time_of(F.col("id") / 100, knots).alias("t")).collect()
        for i, r in enumerate(got):
            area, total = 0.0, 0.0
            for (a, x), (b, y) in zip(knots, knots[1:]):
                total += (b - a) * (x + y) / 2
                end = min(max(r.t, a), b)
                area += (end - a) * (x + x + (y - x) * (end - a) / (b - a)) / 2
            assert area / total == pytest.approx(i / 100, abs=1e-9)
    with pytest.raises(ValueError):
        mixing.time_of(F.lit(0.5), ((0.0, 0.0), (1.0, 1.0)))


def slow_time(share, knots):
    """The time at which a schedule's integral reaches ``share`` of its whole, by bisection."""
    def area(t):
        total = 0.0
        for (a, x), (b, y) in zip(knots, knots[1:]):
            end = min(max(t, a), b)
            total += (end - a) * (2 * x + (y - x) * (end - a) / (b - a)) / 2
        return total
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if area(mid) < share * area(1.0) else (low, mid)
    return low


def test_op2_positions_and_copies_of_every_document(spark):
    from hashlib import md5

    from hearth.llm import queries
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in rows}
    by_source = {}
    for r in rows:
        key = md5(f"{r.doc_id}:{md5((r.text or '').encode()).hexdigest()}".encode()).hexdigest()
        by_source.setdefault(r.source, []).append((key, r.doc_id))
    target = slow_targets({s: sum(size[i] for _, i in ids) for s, ids in by_source.items()})
    want = {}
    for cycle, source in enumerate(sorted(by_source, key=lambda s: s.encode())):
        at, own = 0, sum(size[i] for _, i in by_source[source])
        for _, i in sorted(by_source[source]):
            # the words of one pass after the other, cut at the target
            copies = [p for p in range(3) if size[i] and p * own + at < int(target[source])]
            time = slow_time(min(at / max(target[source], 1.0), 1.0), mixing.SCHEDULES[cycle % 3])
            want[i] = (len(copies), time if copies else None)
            at += size[i]
    got = queries.op2_mixing(spark, SF001).collect()
    for r in got:
        copies, time = want[r.doc_id]
        assert r.copies == copies and (r.position is None) == (time is None)
        assert time is None or r.position == pytest.approx(time, abs=2e-9)
    times = [r.position for r in got if r.position is not None]
    assert times == sorted(times) and all(r.position is None for r in got[len(times):])


def test_the_rows_of_one_id_spread(spark):
    docs = spark.range(4000).selectExpr("cast(7 as bigint) as doc_id", "concat('t', id, ' w') as text", "'s' as source")
    groups = mixing.plan(docs, ["doc_id"], per_bucket=100).groupBy(F.substring("_order", 1, 1)).count().collect()
    assert len(groups) == 16 and max(r["count"] for r in groups) < 500
    check(docs)


def test_training_order_cuts_and_repeats(spark):
    docs = spark.createDataFrame([(i, f" a{i}\tb  c\nd e", "s" if i else "t", 11) for i in range(9)],
                                 "doc_id long, text string, source string, n_chars long")
    plan = {r.doc_id: r for r in mixing.plan(docs, ["doc_id"]).select("row.*", "*").collect()}
    rows = mixing.training_order(docs).collect()
    assert [f for f in docs.columns] == list(rows[0].asDict())
    words = {}
    for r in rows:
        assert r.n_chars == len(r.text) and f" a{r.doc_id}\tb  c\nd e".startswith(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.text))
    assert words == {i: p.taken for i, p in plan.items() if p.taken}


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert mixing.plan(no_docs, ["doc_id"]).count() == 0
    assert mixing.training_order(no_docs).count() == 0
    assert mixing.training_order(odd_docs).columns == odd_docs.columns


def test_rows_without_an_id_match_the_sql(spark, tmp_path):
    import duckdb

    from hearth.llm import queries
    docs = spark.range(600).selectExpr("case when id % 3 > 0 then id end as doc_id",
                                       "concat('t', id % 50, repeat(' w', cast(id % 7 as int))) as text",
                                       "concat('s', id % 4) as source")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, map(tuple, queries.op2_mixing(spark, str(tmp_path)).collect())))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == sorted(map(str, con.execute(queries.OP2_SQL).fetchall()))
