"""Constraints with a reject table (S4), composite grain (Q6) and hot-key lookups."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hearth.operators import constraints as C
from hearth.operators import lookup, quality

SCHEMA = "n long, id string, home string, amount int"


def rules(spark):
    homes = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "h string")
    return [C.NotNull("id"), C.MaxLength("id", 4), C.Check("amount", F.col("amount").between(0, 10)),
            C.ForeignKey("home", homes, "h"), C.Unique(("id",))]


def brute(rows):
    """Reasons of every row, uniqueness among the otherwise good, first by n."""
    out, seen = [], set()
    for n, i, home, amount in sorted(rows, key=lambda r: (r[0], str(r))):
        why = []
        if i is None:
            why.append("not_null:id")
        if i is not None and len(i) > 4:
            why.append("length:id")
        if amount is not None and not 0 <= amount <= 10:
            why.append("check:amount")
        if home is not None and home not in "ab":
            why.append("foreign_key:home")
        if not why:
            if i in seen:
                why.append("unique:id")
            seen.add(i)
        out.append((n, i, home, amount, tuple(why)))
    return Counter(out)


def judged(spark, rows):
    df = C.judge(spark.createDataFrame(rows, SCHEMA), rules(spark), ["n"])
    return Counter((*r[:4], tuple(r.reasons)) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_judge_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(n, rng.choice([None, "x", "y", "z", "toolong", f"i{n}"]), rng.choice([None, "a", "b", "c"]), rng.choice([None, 0, 10, 11, -1, 5]))
            for n in range(200)]
    assert judged(spark, rows) == brute(rows)


def test_nulls_pass_checks_and_references(spark):
    assert judged(spark, [(1, "x", None, None)]) == Counter([(1, "x", None, None, ())])


def test_a_broken_row_does_not_take_a_key(spark):
    rows = [(1, "x", "c", 5), (2, "x", "a", 5), (3, "x", "a", 5)]
    assert judged(spark, rows) == Counter([(1, "x", "c", 5, ("foreign_key:home",)), (2, "x", "a", 5, ()), (3, "x", "a", 5, ("unique:id",))])


def test_equal_rows_are_counted(spark):
    rows = [(1, "x", "a", 5)] * 50 + [(1, "x", "a", 6)] * 3 + [(2, "x", "a", 5)]
    got = judged(spark, rows)
    assert sum(n for r, n in got.items() if r[4] == ()) == 1 and sum(got.values()) == 54
    assert got[(1, "x", "a", 5, ())] == 1 and got[(1, "x", "a", 5, ("unique:id",))] == 49


def test_split_covers_the_input(spark):
    rows = spark.createDataFrame([(n, "x" if n % 3 == 0 else f"i{n}", "a", n % 14) for n in range(100)], SCHEMA)
    accepted, rejected = C.split(rows, rules(spark), ["n"])
    assert accepted.columns == rows.columns
    assert sorted(r.n for r in accepted.collect()) + sorted(r.n for r in rejected.collect()) != []
    assert sorted([r.n for r in accepted.collect()] + [r.n for r in rejected.collect()]) == list(range(100))
    assert C.judge(rows.limit(0), rules(spark), ["n"]).count() == 0


def test_a_hot_key_is_reduced_before_it_is_joined(spark):
    """The join that finds repeated keys sees one row per key, and no window gathers a key's rows."""
    rows = spark.range(1000).select(F.col("id").alias("n"), F.lit("x").alias("id"), F.lit("a").alias("home"), F.lit(1).alias("amount"))
    plan = C.judge(rows, rules(spark), ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_schema_rules():
    from pyspark.sql import types as T
    schema = T.StructType().add("id", "string").add("name", "string")
    got = C.of_schema(schema, ["id", "gone"], {"name": 20, "gone": 3})
    assert got == [C.NotNull("id"), C.MaxLength("name", 20)]


# ---------------------------------------------------------------- grain
def test_repeated_grain(spark):
    rng = random.Random(4)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), i) for i in range(30)] + [(9, "z", 0)]
    df = spark.createDataFrame(data, "h long, p string, i long")
    want = {k: n for k, n in Counter((h, p) for h, p, _ in data).items() if n > 1}
    assert {(r.h, r.p): r.rows for r in quality.repeated_grain(df, ["h", "p"]).collect()} == want
    assert quality.repeated_grain(df, ["i", "h", "p"]).where("i > 100").count() == 0
    assert quality.repeated_grain(df.limit(0), ["h"]).count() == 0


# ---------------------------------------------------------------- hot keys
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_of_a_hot_key_equals_the_join(spark, how):
    rng = random.Random(6)
    data = [("hot" if i % 3 == 0 else rng.choice([None, "gone", *[f"k{j}" for j in range(200)]]), i) for i in range(3000)]
    rows = spark.createDataFrame(data, "key string, i long").repartition(5)
    dim = spark.createDataFrame([("hot", 1), *[(f"k{j}", j) for j in range(150)]], "key string, v long")
    assert lookup.hot_keys(rows, "key") == ["hot"]
    got = sorted(map(tuple, lookup.lookup(rows, dim, "key", how).select("key", "i", "v").collect()), key=str)
    assert got == sorted(map(tuple, rows.join(dim, "key", how).select("key", "i", "v").collect()), key=str)


def test_the_hot_key_does_not_reach_the_shuffle_join(spark):
    data = [("hot" if i % 2 else f"k{i}", i) for i in range(2000)]
    rows, dim = spark.createDataFrame(data, "key string, i long"), spark.createDataFrame([("hot", 1), ("k2", 2)], "key string, v long")
    joined = lookup.lookup(rows, dim, "key")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and "NOT" in plan
    assert joined.count() == 2000


def test_lookup_without_hot_keys_and_without_rows(spark):
    rows, dim = spark.createDataFrame([], "key string, i long"), spark.createDataFrame([("a", 1)], "key string, v long")
    assert lookup.hot_keys(rows, "key") == [] and lookup.lookup(rows, dim, "key").count() == 0
    even = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.col("id").alias("i"))
    assert lookup.hot_keys(even, "key") == []
    with pytest.raises(ValueError):
        lookup.lookup(rows, dim, "key", "outer")


def test_a_hot_key_spreads_over_tasks(spark):
    """A third of the rows on one key: no task of the lookup holds them, as one of the plain join does."""
    rows = spark.range(30_000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("key"),
        F.col("id").alias("i"))
    dim = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("v")) \
        .unionByName(spark.createDataFrame([("hot", -1)], "key string, v long"))
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        largest = lambda df: df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        plain = largest(rows.join(dim, "key", "left"))
        spread = largest(lookup.lookup(rows, dim, "key"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plain >= 10_000 and spread < 4_000


def test_a_hot_duplicate_is_no_task_of_its_own(spark):
    """100,000 rows of one key, half of them equal: judged by combining aggregates."""
    rows = spark.range(150_000).select(
        F.when(F.col("id") < 50_000, 1).otherwise(F.col("id")).alias("n"),
        F.when(F.col("id") < 100_000, "hot").otherwise(F.concat(F.lit("i"), (F.col("id") % 5000).cast("string"))).alias("id"),
        F.lit("a").alias("home"), F.lit(1).alias("amount"))
    homes = spark.createDataFrame([("a",)], "h string")
    got = C.judge(rows, [C.ForeignKey("home", homes, "h"), C.Unique(("id",))], ["n"])
    counts = {r["accepted"]: r["count"] for r in got.groupBy((F.size("reasons") == 0).alias("accepted")).count().collect()}
    assert counts == {True: 5001, False: 144_999}
