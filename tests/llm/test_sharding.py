import zlib

import numpy as np

from hearth.llm import sharding
from tests.conftest import SF01


def slow_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_and_growth():
    keys = np.concatenate((np.arange(2000), np.random.default_rng(1).integers(-2**63, 2**63 - 1, 2000))).astype(np.int64).view(np.uint64)
    before = sharding.jump_hash(keys, 8)
    assert before.tolist() == [slow_jump(int(k), 8) for k in keys]
    for n in range(1, 40):
        after = sharding.jump_hash(keys, n + 1)
        moved = after != sharding.jump_hash(keys, n)
        assert np.all(after[moved] == n) and abs(moved.mean() - 1 / (n + 1)) < 0.05


def check(docs):
    rows = docs.collect()
    got = sharding.shard(docs).collect()
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()), "key",
                    slow_jump((-1 if r.doc_id is None else r.doc_id) % (1 << 64), 8),
                    slow_jump((-1 if r.doc_id is None else r.doc_id) % (1 << 64), 9)) for r in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got), key=str) == want
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    return got


def test_sf_shards_and_gapless_slots(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    assert sorted(check(docs)) == sorted(check(docs.repartition(5)))
    many = spark.range(40_000).selectExpr("id as doc_id", "cast(id as string) as text")
    got = sharding.shard(many, per_bucket=100).groupBy("shard").agg({"slot": "max", "*": "count"}).collect()
    assert all(r["max(slot)"] + 1 == r["count(1)"] for r in got) and len(got) == 8


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert sharding.shard(no_docs).count() == 0


def test_the_rows_of_one_id_spread_over_slot_groups(spark, monkeypatch):
    made = []
    keep = sharding.materialise
    monkeypatch.setattr(sharding, "materialise", lambda df, name: (made.append((name, keep(df, name))), made[-1][1])[1])
    docs = spark.range(3000).selectExpr("cast(5 as bigint) as doc_id", "concat('t', id) as text")
    got = sharding.shard(docs, per_bucket=100).collect()
    rows = dict(made)["shard-rows"]
    assert rows.groupBy("shard", "bucket").count().agg({"count": "max"}).first()[0] < 300
    assert len({r.shard for r in got}) == 1 and sorted(r.slot for r in got) == list(range(3000))
