"""Silver layer (V1-V3): validated households, adoption metrics, impact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import adoption_category, age_group, family_type, \
    household_is_valid, income_bracket
from ..functions.impact import DEFAULT_IMPACT, ImpactCoefficients, impact_columns


# Household columns that analytics may hold (F23). A column that is not
# listed, personal data above all, never passes.
ANALYTIC_COLUMNS = (
    "household_key", "household_id", "county", "sub_county", "ward", "village", "urban_rural",
    "gps_latitude", "gps_longitude", "head_gender", "head_age", "marital_status",
    "education_level", "household_size", "children_under_18", "youth_18_35", "elderly_over_60",
    "primary_economic_activity", "monthly_income_ksh", "owns_land", "land_size_acres",
    "livestock_owned", "electricity_access", "mobile_phone_ownership", "water_source",
    "toilet_type", "has_disability", "control_group", "vulnerability_factors", "created_at",
    "updated_at")


def silver_households(households: DataFrame) -> DataFrame:
    """V1: F7 range filter (NULLs fail it, T5) plus F4 brackets; allow-listed columns only."""
    return (households.select(*[c for c in ANALYTIC_COLUMNS if c in households.columns]).where(household_is_valid())
            .withColumns({"income_bracket": income_bracket(),
                          "family_type": family_type(),
                          "age_group": age_group()}))


def treatment_group(adoptions: DataFrame, households: DataFrame,
                    geography: DataFrame) -> DataFrame:
    """A2: adopter metrics per (county, urban_rural).

    The fact is reduced per (household, geography) first (map-side combine),
    so the household join sees one row per pair and a hot household cannot
    skew it; averages are carried as sum and count.
    """
    u = F.col("usage_intensity")
    cost = F.col("baseline_weekly_fuel_cost_ksh")
    f = (adoptions.groupBy("household_key", "geography_key")
         .agg(F.sum(u).alias("su"), F.count(u).alias("nu"),
              F.sum(cost).alias("sc"), F.count(cost).alias("nc"),
              F.min(cost).alias("mn"), F.max(cost).alias("mx")))
    h = households.select("household_key", "urban_rural")
    g = geography.select("geography_key", "county")
    return (f.join(h, "household_key").join(g, "geography_key")
            .groupBy("county", "urban_rural")
            .agg(F.count_distinct("household_key").alias("adopted_households"),
                 (F.sum("su").cast("double") / F.sum("nu")).alias("avg_usage_intensity"),
                 (F.sum("sc").cast("double") / F.sum("nc")).alias("avg_baseline_cost"),
                 F.min("mn").alias("min_baseline_cost"),
                 F.max("mx").alias("max_baseline_cost")))


def control_counts(households: DataFrame) -> DataFrame:
    """Control households per (county, urban_rural)."""
    return (households.where(F.col("control_group"))
            .groupBy("county", "urban_rural")
            .agg(F.count(F.lit(1)).alias("control_households")))


def silver_adoption_metrics(adoptions: DataFrame, households: DataFrame,
                            geography: DataFrame,
                            coef: ImpactCoefficients = DEFAULT_IMPACT) -> DataFrame:
    """Treatment LEFT JOIN control on both keys (NULL keys never match)."""
    t = treatment_group(adoptions, households, geography)
    c = control_counts(households)
    adopted = F.col("adopted_households").cast("double")
    weekly = (F.col("avg_baseline_cost") * F.col("avg_usage_intensity")
              * F.lit(coef.weekly_savings_factor))
    return (t.join(c, ["county", "urban_rural"], "left")
            .withColumns({
                "adoption_penetration_pct": F.when(
                    F.col("control_households") > 0,
                    adopted / (F.col("adopted_households") + F.col("control_households")) * 100),
                "estimated_weekly_savings": weekly,
                "estimated_annual_savings": weekly * F.lit(52),
            }))


def silver_impact_calculations(adoptions: DataFrame, products: DataFrame,
                               geography: DataFrame,
                               coef: ImpactCoefficients = DEFAULT_IMPACT) -> DataFrame:
    """One impact row per adoption joined to its product and county."""
    f = adoptions.select("household_key", "product_key", "geography_key",
                         "usage_intensity", "baseline_weekly_fuel_cost_ksh")
    p = products.select("product_key", "product_type", "carbon_reduction_tons_year",
                        "pm25_emissions_mg_m3")
    g = geography.select("geography_key", "county")
    u = F.col("usage_intensity")
    measures = impact_columns(F.col("carbon_reduction_tons_year"),
                              F.col("pm25_emissions_mg_m3"), u,
                              F.col("baseline_weekly_fuel_cost_ksh"), coef)
    return (f.join(p, "product_key").join(g, "geography_key")
            .select("household_key", "product_key", "county", "product_type",
                    *[c.alias(n) for n, c in measures.items()],
                    adoption_category(u).alias("adoption_category")))
