"""Star-schema catalogue, conforming loads, donor JSON, SQL views."""

import json

from hearth.sources import files, schemas
from hearth.sources.tables import Tables
from hearth.session import scratch_path
from tests.conftest import SF001


def test_adapters_conform_to_catalogue(spark):
    s = Tables(spark, SF001).star
    for name in ("dim_household", "dim_product", "dim_geography", "fact_adoptions",
                 "fact_transactions"):
        df = getattr(s, name)
        typed = schemas.conform(df, schemas.TABLES[name])
        target = schemas.struct(schemas.TABLES[name])
        assert typed.columns == target.fieldNames()
        want = {f.name: f.dataType for f in target.fields}
        for f in df.schema.fields:
            if f.name in want and f.name not in ("transaction_date_key",):
                assert f.dataType == want[f.name], (name, f.name)


def test_conform_derives_key(spark):
    raw = spark.createDataFrame([("P1", "charcoal_stove", 10.0)],
                                "product_id string, product_type string, unit_cost_usd double")
    row = schemas.conform(raw, schemas.DIM_PRODUCT, key="product_key", natural_key="product_id").first()
    assert row.product_key is not None and str(row.unit_cost_usd) == "10.00"


def test_load_donors(spark):
    path = scratch_path(spark, "donors")
    donors = [{"donor_id": "D1", "donor_name": "Fund", "donor_type": "Foundation",
               "focus_area": "Health", "priority_metrics": ["lives_saved", "dalys"],
               "funding_available_usd": 500000, "reporting_frequency": "Quarterly",
               "preferred_counties": ["Turkana", "Kilifi"], "impact_threshold_households": 1000,
               "cost_per_impact_target": 50},
              {"donor_id": "D2", "donor_name": "Climate", "donor_type": "Corporate",
               "focus_area": "Climate", "priority_metrics": ["co2"],
               "funding_available_usd": 250000, "reporting_frequency": "Annual",
               "preferred_counties": ["All"], "impact_threshold_households": 500,
               "cost_per_impact_target": 20}]
    spark.createDataFrame([(json.dumps(donors),)], "value string").coalesce(1).write.text(path)
    d = files.load_donors(spark, path)
    assert d.columns == schemas.struct(schemas.DIM_DONOR).fieldNames()
    assert d.count() == 2
    geography = spark.createDataFrame([("Kilifi",), ("Lamu",), ("Turkana",)], "county string")
    prefs = files.donor_preferences(files.read_donors(spark, path), geography).collect()
    assert sorted((r.donor_id, r.county, r.takes_all, r.values_health) for r in prefs) == [
        ("D1", "Kilifi", False, True), ("D1", "Turkana", False, True), ("D2", "Kilifi", True, False),
        ("D2", "Lamu", True, False), ("D2", "Turkana", True, False)]


def test_sql_view_matches_dataframe(spark):
    from hearth.operators import gold
    s = Tables(spark, SF001).star
    files.register_views(spark, {"fact_adoptions": s.fact_adoptions,
                                 "dim_household": s.dim_household, "dim_product": s.dim_product})
    by_sql = spark.sql("""
      SELECT h.county, h.urban_rural, p.product_type, COUNT(*) AS adoption_count,
             SUM(f.subsidy_amount) AS total_subsidy
      FROM fact_adoptions f JOIN dim_household h ON f.household_key = h.household_key
      JOIN dim_product p ON f.product_key = p.product_key
      GROUP BY h.county, h.urban_rural, p.product_type""")
    by_df = gold.v_adoption_summary(s.fact_adoptions, s.dim_household, s.dim_product) \
        .select("county", "urban_rural", "product_type", "adoption_count", "total_subsidy")
    assert sorted(map(tuple, by_sql.collect())) == sorted(map(tuple, by_df.collect()))
