"""Merging a batch into a table laid out by key range (S12), and gold tables from a stored state."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.operators import gold, gold_state
from hearth.session import scratch_path
from hearth.sources import ranges, sinks, storage
from hearth.sources.ranges import RangeTable, _position
from hearth.sources.tables import Tables
from tests.conftest import SF001

SCHEMA = "k string, county string, income decimal(12,2), updated_at timestamp_ntz"
AT = dt.datetime(2024, 2, 1)


def key(i):
    return f"H{i:05d}"


def base(spark, n=400):
    return spark.createDataFrame([(key(i), f"c{i % 5}", Decimal(i), None) for i in range(n)], SCHEMA)


def delta(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, county string, income decimal(12,2)")


def upsert(table, batch, rows):
    return table.upsert(batch, rows, ["income"], ["ts"], F.lit(AT).cast("timestamp_ntz"))


def files(table):
    return {n: (size, at) for n, size, at in storage.listing(table.spark, f"{table.root}/data")}


def rows(df):
    return sorted(map(tuple, df.select("k", "county", "income", "updated_at").collect()))


@pytest.mark.parametrize("bounds", [[], ["m"], ["b", "d", "f"], list("acegikmoqs"), [f"{i:03d}" for i in range(100)]])
def test_position_counts_the_bounds_below(spark, bounds):
    keys = ["", "a", "b", "c", "m", "z", "000", "050", "0505", "099", "1"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.p for r in df.select("k", _position(F.col("k"), bounds, T.StringType()).alias("p")).collect()}
    assert got == {k: sum(b <= k for b in bounds) for k in keys}


def test_only_touched_ranges_are_rewritten(spark):
    table = RangeTable.create(base(spark), scratch_path(spark, "ranges"), "k", 8)
    before = files(table)
    assert len({n.split("/")[0] for n in before}) >= 6
    d = delta(spark, [(key(3), AT, "x", Decimal(1)), (key(7), AT, "x", Decimal(2)), (key(7), AT - dt.timedelta(1), "x", Decimal(9))])
    touched = upsert(table, "b1", d)
    after = files(table)
    assert len(touched) == 1
    untouched = {n for n in before if not n.startswith(f"key_range={touched[0]}/")}
    assert untouched and {n: after.get(n) for n in untouched} == {n: before[n] for n in untouched}
    want = sinks.upsert(base(spark), d, "k", ["income"], ["ts"], F.lit(AT).cast("timestamp_ntz")).drop("change")
    assert rows(table.read()) == rows(want)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = table.read_ranges(touched)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "(key_range#" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_new_keys_fall_into_ranges_and_null_keys_are_refused(spark):
    table = RangeTable.create(base(spark, 50), scratch_path(spark, "ranges"), "k", 4)
    upsert(table, "b", delta(spark, [("A", AT, "north", Decimal(5)), ("Z", AT, "south", Decimal(6)), (None, AT, "x", Decimal(7))]))
    got = {r.k: (r.county, r.income) for r in table.read().collect()}
    assert len(got) == 52 and got["A"] == ("north", Decimal(5)) and got["Z"] == ("south", Decimal(6)) and None not in got


def test_a_batch_is_applied_once(spark):
    table = RangeTable.create(base(spark), scratch_path(spark, "ranges"), "k", 4)
    first = upsert(table, "b1", delta(spark, [(key(1), AT, "x", Decimal(11))]))
    seen = files(table)
    assert upsert(table, "b1", delta(spark, [(key(399), AT, "x", Decimal(12))])) == first
    assert files(table) == seen and upsert(table, "b2", delta(spark, [])) == []


def test_a_batch_that_died_while_replacing_is_finished_from_what_it_staged(spark, monkeypatch):
    table = RangeTable.create(base(spark), scratch_path(spark, "ranges"), "k", 8)
    d = delta(spark, [(key(i), AT, "x", Decimal(1000 + i)) for i in (5, 399)] + [("ZZ", AT, "new", Decimal(1))])
    write, calls = ranges._write, []

    def dies(df, key_, path):
        calls.append(path)
        if path.endswith("/data"):   # one of the two ranges is replaced, then the driver is lost
            write(df.where(F.col("key_range") == table._staged(f"{table.root}/staged/b1")[0]), key_, path)
            raise RuntimeError("lost")
        write(df, key_, path)

    monkeypatch.setattr(ranges, "_write", dies)
    with pytest.raises(RuntimeError):
        upsert(table, "b1", d)
    monkeypatch.setattr(ranges, "_write", write)
    upsert(RangeTable(spark, table.root), "b1", d)
    want = sinks.upsert(base(spark), d, "k", ["income"], ["ts"], F.lit(AT).cast("timestamp_ntz")).drop("change")
    assert rows(table.read()) == rows(want) and len(calls) == 2


def test_a_batch_that_died_while_staging_is_staged_again(spark):
    table = RangeTable.create(base(spark), scratch_path(spark, "ranges"), "k", 4)
    base(spark, 3).write.parquet(f"{table.root}/staged/b1/key_range=0")    # no marker at the top
    d = delta(spark, [(key(2), AT, "x", Decimal(77))])
    upsert(table, "b1", d)
    assert {r.k: r.income for r in table.read().collect()}[key(2)] == Decimal(77) and table.read().count() == 400


@pytest.mark.parametrize("kind", ["bigint", "date", "decimal(12,2)", "timestamp_ntz", "double"])
def test_keys_of_other_types(spark, kind):
    number = F.col("id").cast("bigint")
    k = {"date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")),
         "timestamp_ntz": (F.lit("2020-01-01 00:00:00.25").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int")))}.get(kind, number.cast(kind))
    df = spark.range(500).select(k.alias("k"), F.col("id").alias("v"))
    table = RangeTable.create(df, scratch_path(spark, "ranges"), "k", 5)
    again = RangeTable(spark, table.root)
    assert again.schema["k"].dataType.simpleString() == kind and 3 <= len(again.bounds) <= 4
    got = again.apply("b", df.where("v = 77"), lambda base_, d: base_.unionByName(d).groupBy("k").agg(F.sum("v").alias("v")))
    assert len(got) == 1 and again.read().agg(F.sum("v")).first()[0] == 499 * 250 + 77 and again.read().count() == 500


def test_empty_table_takes_a_batch(spark):
    table = RangeTable.create(base(spark, 0), scratch_path(spark, "ranges"), "k", 4)
    assert table.read().count() == 0
    upsert(table, "b", delta(spark, [("A", AT, "c", Decimal(1))]))
    assert rows(table.read()) == [("A", "c", Decimal("1.00"), AT)]


# ------------------------------------------------------------ gold from a state

def adoptions(spark, data):
    return spark.createDataFrame(
        [(h, p, dt.date(2024, 1, 1), None if u is None else Decimal(u) / 100, Decimal(s), Decimal(f)) for h, p, u, s, f in data],
        "household_key long, product_key long, adoption_date date, usage_intensity decimal(3,2), subsidy_amount decimal(10,2), "
        "baseline_weekly_fuel_cost_ksh decimal(10,2)")


def test_state_and_delta_equal_the_full_recompute(spark):
    import random
    rng = random.Random(5)
    s = Tables(spark, SF001).star
    homes = [r.household_key for r in s.programme_households.collect()]
    hot = homes[0]
    data = [(hot if rng.random() < 0.4 else rng.choice(homes), rng.choice([0, 1, 2, 3, 10**9]), rng.choice([None, 0, 49, 50, 80, 100]),
             rng.randrange(4), rng.randrange(1500)) for _ in range(300)]
    make = lambda part: gold_state.adoption_state(adoptions(spark, part), s.programme_households, s.dim_geography, s.dim_product)
    table = gold_state.create(make(data[:120]), scratch_path(spark, "gold-state"), 8)
    gold_state.add(table, "d1", make(data[120:121]))
    gold_state.add(table, "d2", make(data[121:]))
    gold_state.add(table, "d2", make(data[121:]))     # a repeated batch
    from hearth.operators import silver
    fact = adoptions(spark, data).join(s.programme_households, "household_key")
    impact = silver.silver_impact_calculations(fact, s.dim_product, s.dim_geography)
    want = {"gold_executive_summary": gold.gold_executive_summary(fact, impact),
            "gold_county_performance": gold.gold_county_performance(fact, s.dim_geography, s.dim_product, impact),
            "gold_donor_health_impact": gold.gold_donor_health_impact(fact, s.dim_household, s.dim_geography, impact),
            "gold_donor_environment_impact": gold.gold_donor_environment_impact(fact, s.dim_product, s.dim_geography, impact),
            "gold_donor_gender_impact": gold.gold_donor_gender_impact(fact, s.dim_household, s.dim_geography, impact)}
    got = gold_state.GoldTables(table.read(), s.dim_household, s.dim_geography).all()
    for name, df in want.items():
        assert sorted(map(tuple, got[name].select(*df.columns).collect()), key=str) == sorted(map(tuple, df.collect()), key=str), name


def test_gold_from_the_state_reads_no_order_and_the_delta_only_new_ones(spark):
    s = Tables(spark, SF001).star
    new = s.order_adoptions_between("2000-01-01 00:00:00", None)
    plan = gold_state.adoption_state(new, s.programme_households, s.dim_geography, s.dim_product) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    state = gold_state.adoption_state(s.order_adoptions, s.programme_households, s.dim_geography, s.dim_product)
    table = gold_state.create(state, scratch_path(spark, "gold-state"), 4)
    for df in gold_state.GoldTables(table.read(), s.dim_household, s.dim_geography).all().values():
        assert not any("orders" in f for f in df.inputFiles())
