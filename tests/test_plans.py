"""Plan invariants of every registered query (planned on sf0.001, not executed).

No Cartesian product, nested-loop join, Expand or Python UDF in any plan, and
column pruning reaches the parquet scans of the wide driver tables.
"""

import re

import pyarrow.parquet as pq
import pytest

from hearth.plans import registry
from tests.conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "BatchEvalPython",
             "ArrowEvalPython")
PRUNED_TABLES = ("orders", "part", "events")
SCAN = re.compile(r"FileScan parquet [^\[]*\[([^\]]*)\].*Location: \w+\([^)]*\)\[([^\]]*)\]")


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name in registry.load_all():
        df = registry.build(name, spark, SF001)
        out[name] = df._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_forbidden_operators(plans):
    for name, plan in plans.items():
        nodes = {line.lstrip(" :+-*()0123456789").split(" ")[0].split("(")[0]
                 for line in plan.splitlines()}
        assert not nodes & set(FORBIDDEN), (name, nodes & set(FORBIDDEN))


def test_scans_read_only_needed_columns(plans):
    widths = {t: len(pq.read_schema(f"{SF001}/{t}.parquet").names) for t in PRUNED_TABLES}
    seen = 0
    for name, plan in plans.items():
        for line in plan.splitlines():
            m = SCAN.search(line)
            if not m:
                continue
            table = m.group(2).rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet")
            if table in widths:
                seen += 1
                cols = [c for c in m.group(1).split(",") if c.strip()]
                assert len(cols) < widths[table], (name, table, cols)
    assert seen > 0


def test_files_added_in_one_session_count(spark, tmp_path):
    src = spark.read.parquet(f"{SF001}/events.parquet")
    for table in ("part", "customer", "orders", "nation", "region", "supplier"):
        spark.read.parquet(f"{SF001}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    src.write.parquet(f"{tmp_path}/events.parquet")
    one = registry.build("transaction_total", spark, str(tmp_path)).first().transactions
    src.write.mode("append").parquet(f"{tmp_path}/events.parquet")
    assert registry.build("transaction_total", spark, str(tmp_path)).first().transactions == 2 * one


def test_every_product_takes_part(spark):
    for sf in (SF001, "/root/testdata/sf0.01"):
        from hearth.sources.tables import Tables
        t = Tables(spark, sf)
        used = t.star.fact_adoptions_multi.select("product_key").distinct().count()
        assert used > 0.9 * t.part.count()


def test_orders_are_reduced_before_they_meet_their_household(spark):
    from pyspark.sql import functions as F

    from hearth.operators import facts
    from hearth.sources.tables import Tables
    s = Tables(spark, SF001).star
    df = facts.impact_monthly(s.order_adoptions, s.dim_product, s.dim_geography,
                              members=s.programme_households.hint("merge"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("Join Inner, (household_key")
    assert "Aggregate" in below.split("Relation")[0]  # the orders side of that join is an aggregate
    assert df.agg(F.sum("active_adoptions")).first()[0] == 12 * s.fact_adoptions_multi.count()


def test_incremental_filter_reaches_the_scan(spark):
    plan = registry.build("incremental_extract", spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in plan


def test_fanout_reduces_orders_before_they_meet_their_household(spark):
    from hearth.operators import gold, silver
    from hearth.sources.tables import Tables
    s = Tables(spark, SF001).star
    df = gold.gold_county_fanout(s.order_adoptions, s.programme_households.hint("merge"), s.dim_geography, s.dim_product)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    _, _, below = plan.partition("Join Inner, (household_key")
    assert "Aggregate" in below.split("Relation")[0]
    f = s.fact_adoptions_multi
    pairs = gold.gold_county_performance(f, s.dim_geography, s.dim_product, silver.silver_impact_calculations(
        f, s.dim_product, s.dim_geography))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, pairs.collect()))


def test_quotas_read_households_once(spark):
    registry.load_all()
    plan = registry.build("quota_allocation", spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[c_custkey", plan)) == 1
