"""Quality, profile and verification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import household_is_valid
from ..operators import gold, profile, quality, silver
from . import queries_ops
from .registry import register


# The documented ranges, stated once more for the oracle: (dataset, source, rule, column, what breaks it).
_BREAKS = (
    ("households", "dim_household", "gps_latitude_range", "gps_latitude", "abs(gps_latitude) > 4.5"),
    ("households", "dim_household", "gps_longitude_range", "gps_longitude", "gps_longitude NOT BETWEEN 33.5 AND 42.0"),
    ("households", "dim_household", "head_age_range", "head_age", "head_age NOT BETWEEN 18 AND 100"),
    ("households", "dim_household", "household_size_range", "household_size", "household_size NOT BETWEEN 1 AND 20"),
    ("households", "dim_household", "children_range", "children_under_18", "children_under_18 NOT BETWEEN 0 AND 15"),
    ("households", "dim_household", "elderly_range", "elderly_over_60", "elderly_over_60 NOT BETWEEN 0 AND 5"),
    ("households", "dim_household", "income_range", "monthly_income_ksh", "monthly_income_ksh NOT BETWEEN 0 AND 500000"),
    ("households", "dim_household", "urban_rural_values", "urban_rural", "urban_rural NOT IN ('Rural', 'Urban')"),
    ("households", "dim_household", "head_gender_values", "head_gender", "head_gender NOT IN ('Female', 'Male')"),
    ("households", "dim_household", "marital_status_values", "marital_status",
     "marital_status NOT IN ('Divorced', 'Married', 'Single', 'Widowed')"),
    ("adoptions", "fact_adoptions", "payment_method_values", "payment_method", "payment_method NOT IN ('Cash', 'Credit', 'M-Pesa')"),
    ("adoptions", "fact_adoptions", "subsidy_range", "subsidy_amount", "subsidy_amount NOT BETWEEN 0 AND 2000"),
    ("adoptions", "fact_adoptions", "price_paid_range", "actual_price_paid", "actual_price_paid NOT BETWEEN 500 AND 700"),
    ("adoptions", "fact_adoptions", "usage_range", "usage_intensity", "usage_intensity NOT BETWEEN 0 AND 1"),
    ("adoptions", "fact_adoptions", "weekly_fuel_cost_range", "baseline_weekly_fuel_cost_ksh",
     "baseline_weekly_fuel_cost_ksh NOT BETWEEN 0 AND 2000"),
    ("products", "dim_product", "thermal_efficiency_range", "thermal_efficiency_pct", "thermal_efficiency_pct NOT BETWEEN 25 AND 100"),
    ("products", "dim_product", "pm25_emissions_range", "pm25_emissions_mg_m3", "pm25_emissions_mg_m3 NOT BETWEEN 0 AND 500"),
    ("products", "dim_product", "lifespan_range", "lifespan_years", "lifespan_years NOT BETWEEN 3 AND 7"),
    ("products", "dim_product", "tier_range", "tier_rating", "tier_rating NOT BETWEEN 1 AND 5"),
    ("products", "dim_product", "unit_cost_range", "unit_cost_usd", "unit_cost_usd NOT BETWEEN 5 AND 50"),
    ("products", "dim_product", "carbon_reduction_range", "carbon_reduction_tons_year", "carbon_reduction_tons_year NOT BETWEEN 0.3 AND 2.5"),
    ("products", "dim_product", "product_type_values", "product_type",
     "product_type NOT IN ('charcoal_stove', 'firewood_stove', 'pellet_stove', 'solar_lantern')"),
    ("geography", "dim_geography", "population_range", "population", "population NOT BETWEEN 500000 AND 5000000"),
    ("geography", "dim_geography", "area_range", "area_sq_km", "area_sq_km NOT BETWEEN 200 AND 70000"),
    ("geography", "dim_geography", "poverty_rate_range", "poverty_rate", "poverty_rate NOT BETWEEN 15 AND 80"),
    ("geography", "dim_geography", "electrification_rate_range", "electrification_rate", "electrification_rate NOT BETWEEN 15 AND 80"),
    ("dates", "days", "year_range", "year", "year NOT BETWEEN 2023 AND 2035"),
    ("dates", "days", "quarter_range", "quarter", "quarter NOT BETWEEN 1 AND 4"),
    ("dates", "days", "month_range", "month", "month NOT BETWEEN 1 AND 12"),
    ("dates", "days", "week_range", "week", "week NOT BETWEEN 1 AND 53"),
    ("dates", "days", "day_of_month_range", "day_of_month", "day_of_month NOT BETWEEN 1 AND 31"),
    ("dates", "days", "day_of_week_range", "day_of_week", "day_of_week NOT BETWEEN 0 AND 6"),
    ("dates", "days", "fiscal_year_range", "fiscal_year", "fiscal_year NOT BETWEEN 2023 AND 2035"),
    ("dates", "days", "fiscal_quarter_range", "fiscal_quarter", "fiscal_quarter NOT BETWEEN 1 AND 4"),
    ("transactions", "fact_transactions", "amount_range", "amount_ksh", "abs(amount_ksh) > 10000"),
    ("transactions", "fact_transactions", "status_values", "status", "status NOT IN ('completed', 'failed', 'pending')"),
    ("impact", "monthly", "dalys_range", "dalys_avoided", "dalys_avoided NOT BETWEEN 0 AND 0.1::DOUBLE"),
    ("impact", "monthly", "mortality_range", "mortality_reduction", "mortality_reduction NOT BETWEEN 0 AND 0.001::DOUBLE"),
    ("impact", "monthly", "co2_range", "co2_avoided_tons", "co2_avoided_tons NOT BETWEEN 0 AND 0.3::DOUBLE"),
    ("impact", "monthly", "trees_range", "trees_saved_equivalent", "trees_saved_equivalent NOT BETWEEN 0 AND 5"),
    ("impact", "monthly", "fuel_savings_range", "fuel_cost_savings_ksh", "fuel_cost_savings_ksh NOT BETWEEN 0 AND 2000"),
    ("impact", "monthly", "time_saved_range", "time_saved_hours", "time_saved_hours NOT BETWEEN 0 AND 60"),
    ("impact", "monthly", "healthcare_savings_range", "healthcare_savings_ksh", "healthcare_savings_ksh NOT BETWEEN 0 AND 1000"),
    ("impact", "monthly", "stacking_ratio_range", "stove_stacking_ratio", "stove_stacking_ratio NOT BETWEEN 0 AND 1"),
)


def _breaks_sql() -> str:
    from .oracle import star
    monthly = star(queries_ops.IMPACT_MONTHLY_SQL)
    days = star(queries_ops.DIM_DATE_SQL)
    parts = [f"SELECT '{d}' AS dataset, '{rule}' AS rule, '{c}' AS column_name, "
             f"COUNT(*) FILTER (WHERE {bad}) AS violations, COUNT({c}) AS checked FROM {src}"
             for d, src, rule, c, bad in _BREAKS]
    return f", days AS ({days}), monthly AS ({monthly})\n" + "\nUNION ALL\n".join(parts)


@register("range_violations", _breaks_sql(), ops="Q1")
def q_range_violations(t):
    s = t.star
    out = None
    for name, df, rules in (
            ("households", s.dim_household, quality.HOUSEHOLD_RULES), ("adoptions", s.fact_adoptions, quality.ADOPTION_RULES),
            ("products", s.dim_product, quality.PRODUCT_RULES), ("geography", s.dim_geography, quality.GEOGRAPHY_RULES),
            ("dates", queries_ops.q_dim_date(t), quality.DATE_RULES),
            ("transactions", s.fact_transactions, quality.TRANSACTION_RULES),
            ("impact", queries_ops.q_impact_monthly(t), quality.IMPACT_RULES)):
        one = quality.range_violations(df, rules, name)
        out = one if out is None else out.unionByName(one)
    return out


@register("quality_checks", """
SELECT COUNT(*) FILTER (WHERE county IS NULL) AS missing_counties,
       COUNT(*) FILTER (WHERE head_age < 18 OR head_age > 100) AS invalid_ages,
       COUNT(*) FILTER (WHERE monthly_income_ksh < 0) AS negative_income,
       COUNT(*) FILTER (WHERE household_size < 1 OR household_size > 20) AS household_size_anomalies
FROM dim_household
""", ops="Q2")
def q_quality_checks(t):
    return quality.quality_checks(t.star.dim_household)


@register("completeness_report", """
, gaps AS (
  SELECT 1 AS place, 'Households' AS dataset, county IS NULL AS no_first, monthly_income_ksh IS NULL AS no_second FROM dim_household
  UNION ALL
  SELECT 2, 'Adoptions', usage_intensity IS NULL, subsidy_amount IS NULL FROM fact_adoptions)
SELECT dataset, COUNT(*) AS total_records, COUNT(*) - COUNT(*) FILTER (WHERE no_first) AS complete_county,
       COUNT(*) - COUNT(*) FILTER (WHERE no_second) AS complete_income
FROM gaps GROUP BY dataset, place ORDER BY place
""", ops="Q3 A7 U1")
def q_completeness(t):
    s = t.star
    return quality.completeness_report(s.dim_household, s.fact_adoptions)


@register("anomaly_report", """
, poor AS (SELECT household_key AS k FROM dim_household WHERE monthly_income_ksh < 10000),
seen AS (SELECT COUNT(*) FILTER (WHERE usage_intensity > 0.95) AS very_high,
                COUNT(*) FILTER (WHERE usage_intensity > 0.8 AND household_key IN (SELECT k FROM poor)) AS poor_high
         FROM fact_adoptions)
SELECT unnest(['High Usage Intensity', 'Low Income High Adoption']) AS anomaly_type,
       unnest([CAST(very_high AS BIGINT), CAST(poor_high AS BIGINT)]) AS count FROM seen
""", ops="Q4 U1")
def q_anomaly(t):
    s = t.star
    return quality.anomaly_report(s.fact_adoptions, s.dim_household)


@register("silver_flags", """
SELECT h.household_key,
       concat_ws(',',
         CASE WHEN h.county IS NULL OR g.county IS NULL THEN 'unknown_county' END,
         CASE WHEN NOT (h.head_age BETWEEN 18 AND 100) THEN 'invalid_age' END,
         CASE WHEN NOT (h.household_size BETWEEN 1 AND 20) THEN 'invalid_size' END,
         CASE WHEN NOT (h.gps_latitude BETWEEN -4.5 AND 4.5) OR NOT (h.gps_longitude BETWEEN 33.5 AND 42.0)
              THEN 'gps_out_of_range' END,
         CASE WHEN h.monthly_income_ksh < 0 THEN 'negative_income' END) AS flags,
       CASE WHEN h.monthly_income_ksh >= 0 THEN h.monthly_income_ksh END AS monthly_income_clean
FROM dim_household h LEFT JOIN (SELECT DISTINCT county FROM dim_geography) g ON h.county = g.county
""", measures=("monthly_income_clean",), ops="Q5 F14")
def q_silver_flags(t):
    s = t.star
    return quality.silver_flags(s.dim_household, s.dim_geography)


_DUP_CHECKS = (("dim_household", "household_key"), ("dim_household", "household_id"),
               ("dim_product", "product_key"), ("dim_geography", "county"),
               ("fact_adoptions", "household_key"), ("fact_adoptions_multi", "household_key"),
               ("fact_transactions", "transaction_id"), ("fact_transactions", "household_key"))


@register("duplicate_keys", "\nUNION ALL\n".join(
    f"SELECT '{tb}' AS table_name, '{k}' AS key_name, COUNT(*) AS duplicated_keys, "
    f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS excess_rows "
    f"FROM (SELECT {k}, COUNT(*) AS n FROM {tb} GROUP BY {k} HAVING COUNT(*) > 1)"
    for tb, k in _DUP_CHECKS), ops="Q6")
def q_duplicate_keys(t):
    s = t.star
    return quality.duplicate_keys([(tb, k, getattr(s, tb)) for tb, k in _DUP_CHECKS])


_ORPHAN_CHECKS = (("fact_adoptions", "household_key", "dim_household", "household_key"),
                  ("fact_adoptions", "product_key", "dim_product", "product_key"),
                  ("fact_adoptions", "geography_key", "dim_geography", "geography_key"),
                  ("fact_transactions", "household_key", "dim_household", "household_key"),
                  ("transactions_raw", "household_id", "dim_household", "household_id"),
                  ("routes_raw", "county", "dim_geography", "county"))


@register("orphan_keys", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS fact_table, '{fk}' AS foreign_key, COUNT(*) AS orphan_rows FROM {c} x "
    f"WHERE x.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{fk})"
    for c, fk, p, pk in _ORPHAN_CHECKS), ops="Q7")
def q_orphan_keys(t):
    s = t.star
    return quality.orphan_keys([(c, fk, getattr(s, c), getattr(s, p), pk)
                                for c, fk, p, pk in _ORPHAN_CHECKS])


@register("join_loss", """
SELECT 'transactions_to_households' AS join_name, COUNT(*) AS rows_in,
       COUNT(*) FILTER (WHERE h.household_id IS NOT NULL) AS rows_matched,
       COUNT(*) FILTER (WHERE h.household_id IS NULL) AS rows_dropped
FROM transactions_raw t LEFT JOIN (SELECT DISTINCT household_id FROM dim_household) h
  ON t.household_id = h.household_id
UNION ALL
SELECT 'routes_to_geography', COUNT(*), COUNT(*) FILTER (WHERE g.county IS NOT NULL),
       COUNT(*) FILTER (WHERE g.county IS NULL)
FROM routes_raw r LEFT JOIN (SELECT DISTINCT county FROM dim_geography) g ON r.county = g.county
""", ops="Q8 J7")
def q_join_loss(t):
    s = t.star
    return (quality.join_loss("transactions_to_households", s.transactions_raw,
                              s.dim_household, "household_id")
            .unionByName(quality.join_loss("routes_to_geography", s.routes_raw,
                                           s.dim_geography, "county")))


def _gold_checks_sql():
    from .queries import COUNTY_SQL, EXECUTIVE_SQL, households_sql
    return households_sql("fact_adoptions") + ", per_county AS (" + COUNTY_SQL + "), whole AS (" + EXECUTIVE_SQL + """)
SELECT max(w.total_households_reached) AS executive_households, CAST(sum(c.households_reached) AS BIGINT) AS county_households,
       COUNT(*) FILTER (WHERE c.penetration_rate > 100) AS counties_over_100pct,
       COUNT(*) FILTER (WHERE NOT coalesce(c.roi_ratio > 0, false)) AS counties_nonpositive_roi,
       max(w.total_households_reached) = sum(c.households_reached) AS totals_match
FROM whole w, per_county c
"""


@register("gold_checks", _gold_checks_sql(), ops="Q9")
def q_gold_checks(t):
    from .queries import _gold
    tables = _gold(t)
    return quality.gold_checks(tables.gold_executive_summary(), tables.gold_county_performance())


@register("run_thresholds", """
, m AS (
  SELECT CAST(COUNT(*) AS DOUBLE) AS n,
         COUNT(*) FILTER (WHERE NOT COALESCE(household_size BETWEEN 1 AND 20 AND head_age BETWEEN 18 AND 100
                                             AND monthly_income_ksh >= 0, false)) AS failed,
         COUNT(*) FILTER (WHERE county IS NULL) + COUNT(*) FILTER (WHERE head_age IS NULL)
           + COUNT(*) FILTER (WHERE monthly_income_ksh IS NULL) AS nulls,
         (SELECT COUNT(*) FROM dim_household WHERE household_size BETWEEN 1 AND 20
            AND head_age BETWEEN 18 AND 100 AND monthly_income_ksh >= 0) AS silver_rows
  FROM dim_household)
SELECT 'records_processed_pct' AS metric, silver_rows / n * 100 AS value, 90.0 AS threshold,
       CASE WHEN silver_rows / n * 100 < 90.0 THEN 'Error' ELSE 'OK' END AS status FROM m
UNION ALL
SELECT 'validation_failure_pct', failed / n * 100, 5.0,
       CASE WHEN failed / n * 100 > 5.0 THEN 'Warning' ELSE 'OK' END FROM m
UNION ALL
SELECT 'required_null_pct', nulls / (n * 3) * 100, 2.0,
       CASE WHEN nulls / (n * 3) * 100 > 2.0 THEN 'Warning' ELSE 'OK' END FROM m
""", measures=("value", "threshold"), ops="Q10")
def q_run_thresholds(t):
    s = t.star
    return quality.run_thresholds(s.dim_household, silver.silver_households(s.dim_household))


@register("quality_metrics", """
SELECT 'households' AS data_source,
       CAST(COUNT(county) + COUNT(head_age) + COUNT(monthly_income_ksh) + COUNT(household_size) AS DOUBLE)
         / (COUNT(*) * 4) * 100 AS completeness_pct,
       CAST(COUNT(*) FILTER (WHERE household_size BETWEEN 1 AND 20 AND head_age BETWEEN 18 AND 100
                                   AND monthly_income_ksh >= 0) AS DOUBLE) / COUNT(*) * 100 AS validation_pass_rate,
       COUNT(*) FILTER (WHERE monthly_income_ksh < 0) AS anomalies_detected,
       COUNT(*) AS records_count
FROM dim_household
UNION ALL
SELECT 'adoptions',
       CAST(COUNT(usage_intensity) + COUNT(subsidy_amount) + COUNT(payment_method) AS DOUBLE) / (COUNT(*) * 3) * 100,
       CAST(COUNT(*) FILTER (WHERE usage_intensity BETWEEN 0 AND 1 AND subsidy_amount BETWEEN 0 AND 2000) AS DOUBLE)
         / COUNT(*) * 100,
       COUNT(*) FILTER (WHERE usage_intensity > 0.95), COUNT(*)
FROM fact_adoptions
UNION ALL
SELECT 'transactions',
       CAST(COUNT(household_key) + COUNT(amount_ksh) + COUNT(transaction_type) AS DOUBLE) / (COUNT(*) * 3) * 100,
       CAST(COUNT(*) FILTER (WHERE amount_ksh >= 0) AS DOUBLE) / COUNT(*) * 100,
       COUNT(*) FILTER (WHERE status = 'failed'), COUNT(*)
FROM fact_transactions
""", measures=("completeness_pct", "validation_pass_rate"), ops="Q11")
def q_quality_metrics(t):
    s = t.star
    u, sub = F.col("usage_intensity"), F.col("subsidy_amount")
    return quality.quality_metrics([
        ("households", s.dim_household,
         ("county", "head_age", "monthly_income_ksh", "household_size"),
         household_is_valid(), F.col("monthly_income_ksh") < 0),
        ("adoptions", s.fact_adoptions, ("usage_intensity", "subsidy_amount", "payment_method"),
         u.between(0, 1) & sub.between(0, 2000), u > 0.95),
        ("transactions", s.fact_transactions, ("household_key", "amount_ksh", "transaction_type"),
         F.col("amount_ksh") >= 0, F.col("status") == "failed"),
    ])


_COUNTED = ("dim_household", "dim_product", "dim_geography", "fact_adoptions", "fact_transactions")


@register("load_verification", "\nUNION ALL\n".join(
    f"SELECT '{tb}' AS table_name, COUNT(*) AS row_count FROM {tb}" for tb in _COUNTED),
    ops="Q12 A16")
def q_load_verification(t):
    s = t.star
    return profile.row_counts([(tb, getattr(s, tb)) for tb in _COUNTED])


@register("top_adoption_counties", """
SELECT g.county, COUNT(*) AS adoptions
FROM fact_adoptions f JOIN dim_geography g ON f.geography_key = g.geography_key
GROUP BY g.county ORDER BY adoptions DESC, g.county LIMIT 5
""", ops="L1 Q12")
def q_top_adoption_counties(t):
    s = t.star
    return profile.top_adoption_counties(s.fact_adoptions, s.dim_geography)


@register("first_product_per_type", """
SELECT product_type, MIN(product_key) AS product_key FROM dim_product GROUP BY product_type
""", ops="A10 T16")
def q_first_product(t):
    return profile.first_product_per_type(t.star.dim_product)


@register("value_counts", """
SELECT 'product_type' AS dimension, product_type AS value, COUNT(*) AS count
FROM households_raw WHERE product_type IS NOT NULL GROUP BY product_type
UNION ALL
SELECT 'county', county, COUNT(*) FROM households_raw WHERE county IS NOT NULL GROUP BY county
UNION ALL
SELECT 'transaction_type', type, COUNT(*) FROM transactions_raw WHERE type IS NOT NULL GROUP BY type
""", ops="A11")
def q_value_counts(t):
    s = t.star
    return profile.value_counts([("product_type", s.households_raw, "product_type"),
                                 ("county", s.households_raw, "county"),
                                 ("transaction_type", s.transactions_raw, "type")])


@register("profile_summary", """
SELECT COUNT(*) AS total_households,
       CAST(COUNT(*) FILTER (WHERE control_group) AS DOUBLE) / COUNT(*) * 100 AS control_group_pct,
       CAST(COUNT(*) FILTER (WHERE product_type IS NOT NULL AND product_type <> 'none') AS DOUBLE)
         / COUNT(*) * 100 AS adoption_rate,
       CAST(SUM(household_size) AS DOUBLE) / COUNT(household_size) AS avg_household_size,
       CAST(SUM(monthly_income_ksh) AS DOUBLE) / COUNT(monthly_income_ksh) AS avg_monthly_income,
       CAST(COUNT(*) FILTER (WHERE urban_rural = 'Urban') AS DOUBLE) / COUNT(*) * 100 AS urban_pct
FROM households_raw
""", measures=("control_group_pct", "adoption_rate", "avg_household_size", "avg_monthly_income",
               "urban_pct"), ops="A12")
def q_profile_summary(t):
    return profile.profile_summary(t.star.households_raw)


@register("product_type_means", """
SELECT product_type,
       round_even(CAST(SUM(thermal_efficiency_pct) AS DOUBLE) / COUNT(thermal_efficiency_pct), 1) AS thermal_efficiency_pct,
       round_even(CAST(SUM(pm25_emissions_mg_m3) AS DOUBLE) / COUNT(pm25_emissions_mg_m3), 1) AS pm25_emissions_mg_m3,
       round_even(CAST(SUM(carbon_reduction_tons_year) AS DOUBLE) / COUNT(carbon_reduction_tons_year), 1) AS carbon_reduction_tons_year
FROM dim_product GROUP BY product_type
""", ops="A13 T14")
def q_product_type_means(t):
    return profile.product_type_means(t.star.dim_product)


@register("transaction_total", """
SELECT SUM(amount_ksh) AS total_amount_ksh, COUNT(*) AS transactions FROM fact_transactions
""", measures=("total_amount_ksh",), ops="A14")
def q_transaction_total(t):
    return t.star.fact_transactions.agg(F.sum("amount_ksh").alias("total_amount_ksh"),
                                        F.count(F.lit(1)).alias("transactions"))


@register("control_counts", """
SELECT county, urban_rural, COUNT(*) AS control_households
FROM dim_household WHERE control_group = true GROUP BY county, urban_rural
""", ops="A3 F9")
def q_control_counts(t):
    return silver.control_counts(t.star.dim_household)
