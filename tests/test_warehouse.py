"""Warehouse layout: round trip equality, partition pruning on the month key."""

from pyspark.sql import functions as F

from hearth.operators import gold, silver
from hearth.session import scratch_path
from hearth.sources import sinks
from hearth.sources.tables import Tables
from hearth.sources.warehouse import WarehouseStar, write_star
from tests.conftest import SF001


def test_star_round_trip_and_pruning(spark):
    s = Tables(spark, SF001).star
    root = scratch_path(spark, "warehouse")
    write_star(s, root)
    w = WarehouseStar(spark, root)

    def county(star):
        imp = silver.silver_impact_calculations(star.fact_adoptions, star.dim_product,
                                                star.dim_geography)
        return sorted(map(tuple, gold.gold_county_performance(
            star.fact_adoptions, star.dim_geography, star.dim_product, imp).collect()))

    assert county(w) == county(s)
    assert w.fact_transactions.count() == s.fact_transactions.count()

    inc = sinks.incremental(w.fact_transactions, "2024-01-20 00:00:00") \
        .where(F.col("month_key") >= 202401)
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month_key" in plan
    assert inc.count() == sinks.incremental(s.fact_transactions, "2024-01-20 00:00:00").count()
