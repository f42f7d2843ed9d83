"""Allocation: golden values, infeasible and under-capacity scenarios, properties."""

import pytest
from pyspark.sql import functions as F

from hearth.operators import allocate as A

# The programme's shipped county table (county, region, population,
# poverty rate, electrification rate), used here as a golden-test fixture.
SHIPPED_COUNTIES = [
    ("Nairobi", "Central", 4397073, 16.7, 77.6),
    ("Kiambu", "Central", 2417735, 21.8, 71.2),
    ("Nakuru", "Rift Valley", 2162202, 29.9, 51.3),
    ("Kakamega", "Western", 1867579, 36.4, 38.1),
    ("Bungoma", "Western", 1670570, 52.2, 31.5),
    ("Meru", "Eastern", 1545714, 28.3, 42.7),
    ("Kisumu", "Nyanza", 1155574, 35.0, 48.2),
    ("Machakos", "Eastern", 1421932, 32.7, 54.8),
    ("Mombasa", "Coast", 1208333, 34.8, 65.1),
    ("Kilifi", "Coast", 1453787, 48.8, 37.4),
    ("Uasin Gishu", "Rift Valley", 1163186, 30.3, 56.9),
    ("Nyeri", "Central", 759164, 20.7, 68.3),
    ("Kisii", "Nyanza", 1266860, 44.2, 29.4),
    ("Turkana", "Rift Valley", 926976, 79.4, 15.2),
]
# Product type, unit cost, sale price.
SHIPPED_PRODUCTS = [("charcoal_stove", 15.0, 5.0), ("firewood_stove", 18.0, 5.0),
                    ("pellet_stove", 45.0, 5.0), ("solar_lantern", 12.0, 5.0)]


@pytest.fixture(scope="module")
def units(spark):
    counties = spark.createDataFrame(
        SHIPPED_COUNTIES, "county string, region string, population int, "
                          "poverty_rate double, electrification_rate double")
    econ = spark.createDataFrame(SHIPPED_PRODUCTS,
                                 "product_type string, unit_cost_usd double, sale_price_usd double")
    econ = econ.withColumn("subsidy_per_unit", F.col("unit_cost_usd") - F.col("sale_price_usd"))
    base = A.weighted_product_cost(econ)
    return A.county_units(counties, base).cache()


def _summary(spark, units, budgets, floors):
    alloc = A.allocate(units, A.scenario_grid(budgets, floors=floors))
    rows = A.scenario_summary(alloc).collect()
    return alloc, {(r.budget_usd, r.objective, r.min_allocation_pct): r for r in rows}


def test_base_cost_and_market(units):
    r = units.agg(F.first("base_cost_usd"), F.sum("target_market")).first()
    assert r[0] == pytest.approx(17.91)
    assert r[1] == 2425734


def test_golden_values(spark, units):
    alloc, s = _summary(spark, units, [500000, 1000000], [0.03, 0.0])
    lives = s[(500000.0, "lives_saved", 0.03)]
    assert lives.total_households == pytest.approx(18054.34, abs=0.01)
    assert lives.total_lives_saved == pytest.approx(18.8344, abs=1e-4)
    assert lives.total_co2_avoided_tons == pytest.approx(28525.9, abs=0.1)
    no_floor = s[(500000.0, "lives_saved", 0.0)]
    assert no_floor.total_lives_saved == pytest.approx(20.5028, abs=1e-4)
    co2 = s[(500000.0, "co2_avoided", 0.03)]
    assert co2.total_households == pytest.approx(20828.59, abs=0.01)
    assert s[(1000000.0, "lives_saved", 0.03)].total_households == pytest.approx(36108.69, abs=0.01)
    assert s[(1000000.0, "co2_avoided", 0.03)].total_co2_avoided_tons == pytest.approx(65818.3, abs=0.1)
    # co2 and households objectives share one allocation (constant CO2 per household)
    assert s[(500000.0, "households_reached", 0.03)].total_households == pytest.approx(
        co2.total_households)
    turkana = alloc.where("county = 'Turkana' and budget_usd = 500000 and "
                          "objective = 'lives_saved' and min_allocation_pct = 0.03").first()
    assert turkana.allocation_pct == pytest.approx(61, abs=0.5)
    cost = (no_floor.total_lives_saved - lives.total_lives_saved) / no_floor.total_lives_saved * 100
    assert cost == pytest.approx(8.137, abs=1e-3)


def test_infeasible_and_under_capacity(spark, units):
    _, s = _summary(spark, units, [12_000_000, 20_000_000], [0.03, 0.0])
    assert s[(12e6, "lives_saved", 0.03)].status == "Infeasible"
    assert s[(12e6, "lives_saved", 0.03)].total_households is None
    under = s[(20e6, "lives_saved", 0.0)]
    assert under.status == "Optimal"
    assert under.budget_utilization_pct == pytest.approx(79, abs=0.5)


def test_properties(spark, units):
    budgets = [250000, 500000, 750000, 1000000, 2000000]
    alloc, s = _summary(spark, units, budgets, [0.03])
    for r in s.values():
        assert r.total_investment <= r.budget_usd * (1 + 1e-9)
    bad = alloc.where(
        "investment_usd < min_allocation_pct * budget_usd * (1 - 1e-9) or "
        "households_allocated > max_penetration_pct * target_market * (1 + 1e-9)").count()
    assert bad == 0
    for obj in A.OBJECTIVES:
        vals = [s[(float(b), obj, 0.03)].total_lives_saved for b in budgets]
        assert vals == sorted(vals)


def test_gain_not_positive_gets_no_fill(spark, units):
    u = units.withColumn("lives_saved_per_hh",
                         F.when(F.col("county") == "Turkana", F.lit(0.0))
                         .otherwise(F.col("lives_saved_per_hh")))
    alloc = A.allocate(u, A.scenario_grid([500000], ["lives_saved"], [0.03]))
    t = alloc.where("county = 'Turkana'").first()
    assert t.investment_usd == pytest.approx(15000.0)


def test_missing_weighted_product_fails(spark):
    econ = spark.createDataFrame([("charcoal_stove", 15.0, 5.0, 10.0)],
                                 "product_type string, unit_cost_usd double, sale_price_usd double, "
                                 "subsidy_per_unit double")
    with pytest.raises(Exception, match="weighted product type missing"):
        A.weighted_product_cost(econ).collect()
