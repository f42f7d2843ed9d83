"""M3-M5 + S8: the allocation model's outputs written as CSV.

One recommendation table, and the per-county allocation of every scenario
partitioned by budget and objective (one folder per scenario instead of one
file per scenario written in a driver loop).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..operators import allocate as A
from ..session import scratch_path
from ..sources.files import write_csv
from ..sources.tables import Tables

ALLOCATION_COLUMNS = ("county", "investment_usd", "households_allocated", "lives_saved",
                      "co2_avoided_tons", "penetration_achieved_pct")


def run(spark: SparkSession, sf_dir: str, out: str | None = None,
        budgets: Sequence[float] = (500000.0, 1000000.0), floor: float = 0.03) -> dict:
    out = out or scratch_path(spark, "allocation-report")
    s = Tables(spark, sf_dir).star
    counties = A.county_profile(s.dim_geography)
    base = A.weighted_product_cost(A.product_economics(s.dim_product))
    alloc = A.allocate(A.county_units(counties, base), A.scenario_grid(budgets, floors=(floor,)))
    write_csv(A.recommendation_table(alloc).drop("min_allocation_pct"),
              f"{out}/recommendations")
    (alloc.select("budget_usd", "objective", *ALLOCATION_COLUMNS)
     .write.mode("overwrite").option("header", True)
     .partitionBy("budget_usd", "objective").csv(f"{out}/allocations"))
    return {"output": out, "recommendations": f"{out}/recommendations",
            "allocations": f"{out}/allocations"}
