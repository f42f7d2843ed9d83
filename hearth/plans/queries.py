"""Query definitions. Spark side: operators over the adapters. SQL side: the
same question stated directly in DuckDB SQL over the oracle's star CTEs."""

from __future__ import annotations

from ..operators import gold, gold_state, silver
from .registry import register

# ----------------------------------------------------------------- silver

@register("v_adoption_summary", """
, reduced AS (SELECT household_key, product_key, COUNT(*) AS n, SUM(usage_intensity) AS used, COUNT(usage_intensity) AS known,
                     SUM(subsidy_amount) AS paid FROM fact_adoptions GROUP BY ALL)
SELECT county, urban_rural, product_type, CAST(SUM(n) AS BIGINT) AS adoption_count,
       CAST(SUM(used) AS DOUBLE) / SUM(known) AS avg_usage_intensity, SUM(paid) AS total_subsidy
FROM reduced JOIN dim_product USING (product_key) JOIN dim_household USING (household_key)
GROUP BY ALL
""", measures=("avg_usage_intensity", "total_subsidy"), ops="J1 A1 G9", headline=True)
def q_v_adoption_summary(t):
    s = t.star
    return gold.v_adoption_summary(s.fact_adoptions, s.dim_household, s.dim_product)


# The documented brackets. NULL falls to the last branch.
BRACKETS_SQL = """
       CASE WHEN monthly_income_ksh < 10000 THEN 'Low' WHEN monthly_income_ksh < 30000 THEN 'Medium' ELSE 'High' END AS income_bracket,
       CASE WHEN children_under_18 > 3 THEN 'Large Family' WHEN children_under_18 > 0 THEN 'Family with Children'
            ELSE 'No Children' END AS family_type,
       CASE WHEN head_age < 30 THEN 'Youth' WHEN head_age < 60 THEN 'Adult' ELSE 'Senior' END AS age_group"""


@register("silver_households", """
SELECT *, """ + BRACKETS_SQL + """
FROM dim_household
WHERE NOT (household_size < 1 OR household_size > 20 OR head_age < 18 OR head_age > 100 OR monthly_income_ksh < 0)
""", measures=("monthly_income_ksh", "gps_latitude", "gps_longitude"), ops="V1 F4 F7 F23")
def q_silver_households(t):
    return silver.silver_households(t.star.dim_household)


@register("silver_adoption_metrics", """
, spent AS (SELECT household_key, geography_key, SUM(usage_intensity) AS used, COUNT(usage_intensity) AS used_known,
                   SUM(baseline_weekly_fuel_cost_ksh) AS cost, COUNT(baseline_weekly_fuel_cost_ksh) AS cost_known,
                   MIN(baseline_weekly_fuel_cost_ksh) AS least, MAX(baseline_weekly_fuel_cost_ksh) AS most
            FROM fact_adoptions GROUP BY ALL),
area AS (SELECT dim_geography.county, urban_rural, COUNT(DISTINCT household_key) AS adopters,
                CAST(SUM(used) AS DOUBLE) / SUM(used_known) AS usage, CAST(SUM(cost) AS DOUBLE) / SUM(cost_known) AS cost,
                MIN(least) AS least, MAX(most) AS most
         FROM spent JOIN (SELECT household_key, urban_rural FROM dim_household) USING (household_key)
              JOIN dim_geography USING (geography_key) GROUP BY ALL),
compared AS (SELECT county, urban_rural, NULLIF(COUNT(*) FILTER (WHERE control_group), 0) AS controls FROM dim_household GROUP BY ALL)
SELECT county, urban_rural, adopters AS adopted_households, usage AS avg_usage_intensity, cost AS avg_baseline_cost,
       least AS min_baseline_cost, most AS max_baseline_cost, CAST(controls AS BIGINT) AS control_households,
       CAST(adopters AS DOUBLE) / (adopters + controls) * 100 AS adoption_penetration_pct,
       cost * usage * 0.3 AS estimated_weekly_savings, cost * usage * 0.3 * 52 AS estimated_annual_savings
FROM area LEFT JOIN compared USING (county, urban_rural)
""", measures=("avg_usage_intensity", "avg_baseline_cost", "min_baseline_cost", "max_baseline_cost",
               "adoption_penetration_pct", "estimated_weekly_savings", "estimated_annual_savings"),
    ops="V2 A2 A3 J4")
def q_silver_adoption_metrics(t):
    s = t.star
    return silver.silver_adoption_metrics(s.fact_adoptions, s.dim_household, s.dim_geography)


# What one unit of usage of each product is worth a year. Deaths are 0.00082 and DALYs
# 24.5 per 1000 mg of PM2.5; a day saves 2.5 hours.
_RATES_SQL = """, rates AS (
  SELECT product_key, product_type, pm25_emissions_mg_m3 AS pm25, carbon_reduction_tons_year AS co2,
         carbon_reduction_tons_year * 12.50 AS credit, pm25_emissions_mg_m3 * (0.00082 * 0.001) AS lives,
         pm25_emissions_mg_m3 * (24.5 * 0.001) AS dalys
  FROM dim_product)
"""
_IMPACT_MEASURES = ("co2_avoided_annual", "carbon_credit_value_usd", "mortality_reduction",
                    "dalys_avoided", "annual_fuel_savings_ksh", "time_saved_hours_annual",
                    "healthcare_savings_annual_ksh", "stacking_ratio")


def _impact(t):
    """V3 over the single-adoption fact, shared by every gold query built on ``t``."""
    s = t.star
    return t.derived("silver_impact", lambda: silver.silver_impact_calculations(
        s.fact_adoptions, s.dim_product, s.dim_geography))


@register("silver_impact_calculations", _RATES_SQL + """
SELECT household_key, product_key, county, product_type,
       usage_intensity * co2 AS co2_avoided_annual, usage_intensity * credit AS carbon_credit_value_usd,
       usage_intensity * lives AS mortality_reduction, usage_intensity * dalys AS dalys_avoided,
       usage_intensity * baseline_weekly_fuel_cost_ksh * 52 AS annual_fuel_savings_ksh,
       usage_intensity * (2.5 * 365) AS time_saved_hours_annual, usage_intensity * 5000 AS healthcare_savings_annual_ksh,
       usage_intensity AS stacking_ratio,
       CASE WHEN usage_intensity IS NULL OR usage_intensity < 0.5 THEN 'Minimal Use'
            WHEN usage_intensity < 0.8 THEN 'Partial Adoption' ELSE 'Full Adoption' END AS adoption_category
FROM fact_adoptions JOIN rates USING (product_key)
     JOIN (SELECT geography_key, county FROM dim_geography) USING (geography_key)
""", measures=_IMPACT_MEASURES, scale=10, ops="V3 F17 F6")
def q_silver_impact(t):
    return _impact(t)


# ------------------------------------------------------------------- gold

def _gold(t) -> gold_state.GoldTables:
    """The gold tables over the single-adoption fact, from one row of sums per household: the orders are read once."""
    s = t.star
    return t.derived("gold", lambda: gold_state.GoldTables(
        gold_state.adoption_state(s.fact_adoptions, None, s.dim_geography, s.dim_product), s.dim_household, s.dim_geography))


# Scale of each yearly total: the products below stay exact decimals.
_GAINS = {"co2": 4, "credit": 6, "lives": 12, "dalys": 8, "fuel": 4, "hours": 3, "health": 2}


def _times(total: str, scale: int, *counts: str) -> str:
    """SUM of a household's total repeated once for every row it meets."""
    n = " * ".join(f"CAST({c} AS DECIMAL(6,0))" for c in counts)
    return f"SUM(CAST({total} AS DECIMAL({38 - 6 * len(counts) - 2},{scale})) * {n})"


def households_sql(fact: str) -> str:
    """Per household: ``gain`` (yearly totals of its adoptions) and ``reach`` (its rows in each county).

    Every adoption row meets every impact row of its household, so a total over the pairs is
    a household's total on one side times its number of rows on the other.
    """
    return _RATES_SQL + f""", gain AS (
  SELECT household_key, COUNT(*) AS gains, SUM(usage_intensity * co2) AS co2, SUM(usage_intensity * credit) AS credit,
         SUM(usage_intensity * lives) AS lives, SUM(usage_intensity * dalys) AS dalys,
         SUM(usage_intensity * baseline_weekly_fuel_cost_ksh * 52) AS fuel, SUM(usage_intensity * (2.5 * 365)) AS hours,
         SUM(usage_intensity * 5000) AS health
  FROM {fact} JOIN rates USING (product_key) SEMI JOIN dim_geography USING (geography_key) GROUP BY household_key),
reach AS (
  SELECT household_key, geography_key, COUNT(*) AS n, COUNT(pm25) AS n_product, SUM(usage_intensity) AS used,
         COUNT(usage_intensity) AS used_known, SUM(subsidy_amount) AS paid, COUNT(subsidy_amount) AS paid_known,
         MAX(usage_intensity) AS best, MIN(usage_intensity) AS worst, SUM(pm25 * usage_intensity) AS pm25,
         BOOL_OR(product_type = 'charcoal_stove') AS charcoal, BOOL_OR(product_type = 'firewood_stove') AS firewood,
         BOOL_OR(product_type = 'pellet_stove') AS pellet, BOOL_OR(product_type = 'solar_lantern') AS lantern
  FROM {fact} LEFT JOIN rates USING (product_key) GROUP BY household_key, geography_key)
"""


EXECUTIVE_SQL = f"""
SELECT COUNT(*) AS total_households_reached, {_times("co2", 4, "n")} AS total_co2_avoided_tons,
       {_times("credit", 6, "n")} AS total_carbon_credit_value, {_times("dalys", 8, "n")} AS total_dalys_avoided,
       {_times("fuel", 4, "n")} AS total_fuel_savings_ksh,
       CAST({_times("used", 2, "gains")} AS DOUBLE) / SUM(used_known * gains) AS avg_usage_intensity,
       COUNT(*) FILTER (WHERE best >= 0.8) AS full_adopters, COUNT(*) FILTER (WHERE worst < 0.5) AS low_adopters,
       {_times("paid", 2, "gains")} AS total_subsidies,
       CAST({_times("paid", 2, "gains")} AS DOUBLE) / SUM(paid_known * gains) AS avg_subsidy_per_household,
       CAST(COUNT(*) AS DOUBLE) / 975000 * 100 AS pct_of_goal_achieved
FROM (SELECT household_key, SUM(n) AS n, SUM(used) AS used, SUM(used_known) AS used_known, SUM(paid) AS paid,
             SUM(paid_known) AS paid_known, MAX(best) AS best, MIN(worst) AS worst FROM reach GROUP BY household_key)
JOIN gain USING (household_key)
"""


@register("gold_executive_summary", households_sql("fact_adoptions") + EXECUTIVE_SQL,
          measures=("total_co2_avoided_tons", "total_carbon_credit_value", "total_dalys_avoided",
                    "total_fuel_savings_ksh", "avg_usage_intensity", "total_subsidies",
                    "avg_subsidy_per_household", "pct_of_goal_achieved"), ops="G4 A4 J5")
def q_gold_exec(t):
    return _gold(t).gold_executive_summary()


COUNTY_SQL = f"""
SELECT county, poverty_rate, electrification_rate, COUNT(*) AS households_reached,
       CAST(COUNT(*) AS DOUBLE) / any_value(population) * 4.5 * 100 AS penetration_rate,
       {_times("gain.co2", 4, "n")} AS co2_avoided, {_times("gain.dalys", 8, "n")} AS dalys_avoided,
       {_times("gain.fuel", 4, "n")} AS fuel_savings,
       CAST({_times("gain.credit", 6, "n")} AS DOUBLE)
         / CAST(NULLIF({_times("paid", 2, "gains")}, 0) AS DOUBLE) AS roi_ratio,
       CAST({_times("used", 2, "gains")} AS DOUBLE) / SUM(used_known * gains) AS avg_usage_intensity,
       COUNT(*) FILTER (WHERE charcoal) AS charcoal_stoves, COUNT(*) FILTER (WHERE firewood) AS firewood_stoves, COUNT(*) FILTER (WHERE pellet) AS pellet_stoves,
       COUNT(*) FILTER (WHERE lantern) AS solar_lanterns
FROM reach JOIN gain USING (household_key) JOIN dim_geography USING (geography_key)
WHERE n_product > 0
GROUP BY county, poverty_rate, electrification_rate
"""
_COUNTY_PERF_MEASURES = ("poverty_rate", "electrification_rate", "penetration_rate", "co2_avoided",
                         "dalys_avoided", "fuel_savings", "roi_ratio", "avg_usage_intensity")


@register("gold_county_performance",
          households_sql("fact_adoptions") + COUNTY_SQL,
          measures=_COUNTY_PERF_MEASURES, ops="G5 A5 A8 J5", headline=True)
def q_gold_county(t):
    return _gold(t).gold_county_performance()


@register("gold_fanout",
          households_sql("fact_adoptions_multi") + COUNTY_SQL,
          measures=_COUNTY_PERF_MEASURES, ops="J5 T3", headline=True)
def q_gold_fanout(t):
    s = t.star
    return gold.gold_county_fanout(s.order_adoptions, s.programme_households, s.dim_geography, s.dim_product)


HEALTH_SQL = f"""
SELECT dim_geography.county, COUNT(*) AS households, {_times("lives", 12, "n")} AS lives_saved,
       {_times("dalys", 8, "n")} AS dalys_avoided, {_times("health", 2, "n")} AS healthcare_cost_avoided,
       CAST(coalesce(SUM(n * gains) FILTER (WHERE contains(vulnerability_factors, 'Elderly')), 0) AS BIGINT) AS elderly_reached,
       CAST(coalesce(SUM(n * gains * greatest(children_under_18, 0)), 0) AS BIGINT) AS children_impacted
FROM reach JOIN gain USING (household_key) JOIN dim_geography USING (geography_key)
     JOIN (SELECT household_key, vulnerability_factors, children_under_18 FROM dim_household) USING (household_key)
GROUP BY dim_geography.county
"""


@register("gold_donor_health_impact", households_sql("fact_adoptions") + HEALTH_SQL, measures=("lives_saved", "dalys_avoided", "healthcare_cost_avoided"), scale=10,
    ops="G6 A6 F10")
def q_gold_health(t):
    return _gold(t).gold_donor_health_impact()


ENVIRONMENT_SQL = f"""
SELECT county, COUNT(*) AS households, {_times("gain.co2", 4, "n")} AS co2_avoided_tons,
       {_times("gain.credit", 6, "n")} AS carbon_credit_value, {_times("gain.co2 * 0.17", 6, "n")} AS trees_equivalent,
       {_times("reach.pm25", 4, "gains")} AS pm25_reduced
FROM reach JOIN gain USING (household_key) JOIN dim_geography USING (geography_key)
WHERE n_product > 0 GROUP BY county
"""


@register("gold_donor_environment_impact", households_sql("fact_adoptions") + ENVIRONMENT_SQL, measures=("co2_avoided_tons", "carbon_credit_value", "trees_equivalent", "pm25_reduced"),
    ops="G7 A9")
def q_gold_env(t):
    return _gold(t).gold_donor_environment_impact()


GENDER_SQL = f"""
SELECT dim_geography.county, COUNT(*) FILTER (WHERE head_gender = 'Female') AS female_headed_households,
       {_times("hours", 3, "n")} AS total_time_saved_hours, {_times("hours * 0.7", 4, "n")} AS women_time_saved_hours,
       CAST(coalesce(SUM(n * gains) FILTER (WHERE contains(vulnerability_factors, 'Single Parent')), 0) AS BIGINT)
         AS single_parents_reached
FROM reach JOIN gain USING (household_key) JOIN dim_geography USING (geography_key)
     JOIN (SELECT household_key, vulnerability_factors, head_gender FROM dim_household) USING (household_key)
GROUP BY dim_geography.county
"""


@register("gold_donor_gender_impact", households_sql("fact_adoptions") + GENDER_SQL, measures=("total_time_saved_hours", "women_time_saved_hours"), ops="G8 A9")
def q_gold_gender(t):
    return _gold(t).gold_donor_gender_impact()


from . import queries_alloc, queries_ops, queries_quality, queries_incremental, queries_tables  # noqa: E402,F401
