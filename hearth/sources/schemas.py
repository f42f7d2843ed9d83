"""Typed star-schema catalogue and the raw extract schemas.

Spark enforces none of the reference's keys; uniqueness and references are
checked by the data-quality jobs (``duplicate_keys``, ``orphan_keys``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DIM_HOUSEHOLD = (
    "household_key bigint, household_id string, county string, sub_county string, ward string, "
    "village string, urban_rural string, gps_latitude decimal(10,6), gps_longitude decimal(10,6), "
    "head_name string, head_gender string, head_age int, marital_status string, "
    "education_level string, household_size int, children_under_18 int, youth_18_35 int, "
    "elderly_over_60 int, primary_economic_activity string, monthly_income_ksh decimal(12,2), "
    "owns_land boolean, land_size_acres decimal(10,2), livestock_owned string, "
    "electricity_access string, mobile_phone_ownership boolean, water_source string, "
    "toilet_type string, control_group boolean, vulnerability_factors string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz")

DIM_PRODUCT = (
    "product_key bigint, product_id string, product_type string, product_model string, "
    "thermal_efficiency_pct decimal(5,2), pm25_emissions_mg_m3 decimal(8,2), "
    "co_emissions_ppm decimal(8,2), fuel_consumption_kg_hour decimal(5,3), lifespan_years int, "
    "maintenance_frequency_months int, tier_rating int, unit_cost_usd decimal(10,2), "
    "carbon_reduction_tons_year decimal(5,2), created_at timestamp_ntz")

DIM_DATE = (
    "date_key int, full_date date, year int, quarter int, month int, month_name string, week int, "
    "day_of_month int, day_of_week int, day_name string, is_weekend boolean, fiscal_year int, "
    "fiscal_quarter int")

DIM_GEOGRAPHY = (
    "geography_key bigint, county string, region string, population int, area_sq_km decimal(10,2), "
    "poverty_rate decimal(5,2), electrification_rate decimal(5,2), created_at timestamp_ntz")

DIM_DONOR = (
    "donor_key bigint, donor_id string, donor_name string, donor_type string, focus_area string, "
    "funding_available_usd decimal(12,2), reporting_frequency string, "
    "cost_per_impact_target decimal(10,2), created_at timestamp_ntz")

FACT_ADOPTIONS = (
    "adoption_key bigint, household_key bigint, product_key bigint, adoption_date_key int, "
    "geography_key bigint, payment_method string, subsidy_amount decimal(10,2), "
    "actual_price_paid decimal(10,2), usage_intensity decimal(3,2), baseline_cooking_method string, "
    "baseline_fuel_type string, baseline_weekly_fuel_cost_ksh decimal(10,2), "
    "baseline_cooking_hours_per_day decimal(5,2), created_at timestamp_ntz")

FACT_TRANSACTIONS = (
    "transaction_key bigint, transaction_id string, household_key bigint, product_key bigint, "
    "transaction_date_key int, amount_ksh decimal(12,2), transaction_type string, "
    "payment_method string, status string, created_at timestamp_ntz")

FACT_IMPACT_METRICS = (
    "impact_key bigint, household_key bigint, product_key bigint, geography_key bigint, "
    "month_key int, dalys_avoided decimal(10,4), mortality_reduction decimal(10,6), "
    "respiratory_illness_reduced decimal(10,4), co2_avoided_tons decimal(10,4), "
    "pm25_reduced_kg decimal(10,4), trees_saved_equivalent decimal(10,2), "
    "fuel_cost_savings_ksh decimal(12,2), time_saved_hours decimal(10,2), "
    "healthcare_savings_ksh decimal(12,2), usage_days_in_month int, "
    "stove_stacking_ratio decimal(3,2), created_at timestamp_ntz")

FACT_EBIKE_LOGISTICS = (
    "route_key bigint, route_id string, geography_key bigint, distribution_center string, "
    "route_name string, distance_km decimal(10,2), households_covered int, terrain_type string, "
    "avg_delivery_time_hours decimal(5,2), ebike_required boolean, "
    "traditional_cost_per_delivery_ksh decimal(10,2), ebike_cost_per_delivery_ksh decimal(10,2), "
    "deliveries_per_month int, route_efficiency_score decimal(5,2), created_at timestamp_ntz")

FACT_CARBON_CREDITS = (
    "carbon_key bigint, date_key int, price_per_ton_usd decimal(10,2), market_type string, "
    "standard string, verification_status string, volume_traded_tons int, "
    "kenya_premium_pct decimal(5,2), created_at timestamp_ntz")

TABLES = {
    "dim_household": DIM_HOUSEHOLD, "dim_product": DIM_PRODUCT, "dim_date": DIM_DATE,
    "dim_geography": DIM_GEOGRAPHY, "dim_donor": DIM_DONOR, "fact_adoptions": FACT_ADOPTIONS,
    "fact_transactions": FACT_TRANSACTIONS, "fact_impact_metrics": FACT_IMPACT_METRICS,
    "fact_ebike_logistics": FACT_EBIKE_LOGISTICS, "fact_carbon_credits": FACT_CARBON_CREDITS,
}

# Raw extract schemas (bronze files).
RAW_PRODUCTS = (
    "product_id string, product_type string, product_model string, thermal_efficiency_pct double, "
    "pm25_emissions_mg_m3 double, co_emissions_ppm double, fuel_consumption_kg_hour double, "
    "lifespan_years int, maintenance_frequency_months int, tier_rating int, unit_cost_usd double, "
    "carbon_reduction_tons_year double")

RAW_DONORS = (
    "donor_id string, donor_name string, donor_type string, focus_area string, "
    "priority_metrics array<string>, funding_available_usd long, reporting_frequency string, "
    "preferred_counties array<string>, impact_threshold_households long, "
    "cost_per_impact_target long")


def struct(schema: StructType | str) -> StructType:
    """Parse a DDL schema string (needs an active session) or pass a StructType through."""
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def conform(df: DataFrame, schema: StructType | str, key: str | None = None,
            natural_key: str | None = None) -> DataFrame:
    """Project and type a frame onto a warehouse schema.

    Columns are matched by name (F1); absent columns become typed NULLs;
    audit timestamps are left NULL rather than a per-run clock so results
    are reproducible. When the surrogate ``key`` is missing it is derived
    from ``natural_key`` as its 128-bit MD5 (32 hex digits, a STRING column):
    deterministic, shuffle-free, and wide enough that no two of 10^10 entities
    can be expected to share a key.
    """
    schema = struct(schema)
    present = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(f.name)
        elif f.name == key and natural_key:
            cols.append(F.md5(F.col(natural_key).cast("string").cast("binary")).alias(f.name))
            continue
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
