"""Allocation-model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.impact import impact_per_household
from ..operators import allocate as A
from .registry import register

# Parameters of the registered scenario grids.
BUDGETS = (500000.0, 1000000.0)
FLOOR = 0.03
EQUITY_BUDGET = 500000.0


def _units(t):
    def make():
        s = t.star
        counties = A.county_profile(s.dim_geography)
        base = A.weighted_product_cost(A.product_economics(s.dim_product))
        return A.county_units(counties, base)
    return t.derived("alloc_units", make)


def _alloc(t, budgets=BUDGETS, floors=(FLOOR,)):
    return t.derived(("alloc", tuple(budgets), tuple(floors)),
                     lambda: A.allocate(_units(t), A.scenario_grid(budgets, floors=floors)))


# Product mix, deaths per 1000 households and the share averted, tons of CO2 a household.
_W = """('charcoal_stove', CAST(0.55 AS DOUBLE)), ('firewood_stove', CAST(0.35 AS DOUBLE)),
        ('pellet_stove', CAST(0.02 AS DOUBLE)), ('solar_lantern', CAST(0.08 AS DOUBLE))"""
_LIVES = "(CAST(2.3 AS DOUBLE) * CAST(0.35 AS DOUBLE) / CAST(1000 AS DOUBLE))"
_MULTIPLIER = ("CASE WHEN 1.0 + (poverty_rate - 30.0) / 100.0 IS NOT NULL "
               "THEN greatest(0.8, least(1.5, 1.0 + (poverty_rate - 30.0) / 100.0)) END")

OBSERVED_SQL = """
, stats AS (
  SELECT county, COUNT(*) AS surveyed_households,
         AVG(CASE WHEN monthly_income_ksh < 10000 THEN 1 ELSE 0 END) AS poor_share
  FROM dim_household GROUP BY county),
observed AS (
  SELECT g.county, g.population, s.surveyed_households, ROUND(s.poor_share * 100, 2) AS poverty_rate
  FROM dim_geography g JOIN stats s ON g.county = s.county)
"""

UNITS_SQL = f"""
, counties AS (
  SELECT county, region, population, CAST(poverty_rate AS DOUBLE) AS poverty_rate,
         CAST(electrification_rate AS DOUBLE) AS electrification_rate
  FROM dim_geography),
econ AS (
  SELECT product_type, CAST(SUM(unit_cost_usd) AS DOUBLE) / COUNT(unit_cost_usd) AS unit_cost_usd
  FROM dim_product GROUP BY product_type),
weights AS (SELECT * FROM (VALUES {_W}) w(product_type, weight)),
wpc AS (
  SELECT SUM(w.weight * (e.unit_cost_usd - 5.0)) AS weighted_product_cost,
         SUM(w.weight * (e.unit_cost_usd - 5.0)) + 6.5 AS base_cost_usd
  FROM econ e JOIN weights w ON e.product_type = w.product_type),
m1 AS (
  SELECT c.*, CAST(trunc(CAST(population AS DOUBLE) / 4.5) AS BIGINT) AS est_households,
         100.0 - electrification_rate AS energy_poverty_rate, wpc.base_cost_usd
  FROM counties c, wpc),
units AS (
  SELECT *, CAST(trunc(CAST(est_households AS DOUBLE) * energy_poverty_rate / 100.0) AS BIGINT) AS target_market,
         1.0 + (100.0 - electrification_rate) / 200.0 AS remoteness_factor,
         base_cost_usd * (1.0 + (100.0 - electrification_rate) / 200.0) * 1.15 AS cost_per_hh_usd,
         {_MULTIPLIER} AS poverty_multiplier
  FROM m1),
units2 AS (
  SELECT *, {_LIVES} * poverty_multiplier AS lives_saved_per_hh,
         CAST(1.58 AS DOUBLE) AS co2_per_hh
  FROM units)
"""


def _scen_sql(budgets, floors):
    rows = [f"(CAST({b} AS DOUBLE), '{o}', {i}, CAST({f} AS DOUBLE), CAST(0.25 AS DOUBLE))"
            for b in budgets for i, o in enumerate(A.OBJECTIVES) for f in floors]
    return (", scen AS (SELECT * FROM (VALUES " + ", ".join(rows) + ") "
            "v(budget_usd, objective, objective_order, min_allocation_pct, max_penetration_pct))")


ALLOC_SQL = """
, j AS (
  SELECT s.*, u.county, u.cost_per_hh_usd, u.target_market, u.lives_saved_per_hh, u.co2_per_hh,
         CASE WHEN s.objective = 'lives_saved' THEN u.lives_saved_per_hh
              WHEN s.objective = 'co2_avoided' THEN u.co2_per_hh ELSE 1.0 END AS gain,
         s.min_allocation_pct * s.budget_usd AS lo,
         s.max_penetration_pct * u.target_market * u.cost_per_hh_usd - s.min_allocation_pct * s.budget_usd AS room
  FROM scen s, units2 u),
-- the water level: the highest marginal gain per dollar down to which there is room for all that is left to spend
k AS (SELECT *, gain / cost_per_hh_usd AS ratio, CASE WHEN gain > 0 THEN room ELSE 0.0 END AS cap FROM j),
tot AS (
  SELECT budget_usd, objective, min_allocation_pct, any_value(budget_usd) - SUM(lo) AS rest, BOOL_OR(room < 0) AS no_room
  FROM k GROUP BY budget_usd, objective, min_allocation_pct),
filled AS (
  SELECT budget_usd, objective, min_allocation_pct, a.ratio AS level, SUM(o.cap) AS taken
  FROM (SELECT DISTINCT budget_usd, objective, min_allocation_pct, ratio FROM k) a
  JOIN k o USING (budget_usd, objective, min_allocation_pct) WHERE o.ratio >= a.ratio GROUP BY ALL),
lev AS (
  SELECT budget_usd, objective, min_allocation_pct, MAX(level) AS level
  FROM filled JOIN tot USING (budget_usd, objective, min_allocation_pct) WHERE taken >= rest GROUP BY ALL),
spent AS (
  SELECT budget_usd, objective, min_allocation_pct, level, SUM(CASE WHEN ratio > level THEN cap ELSE 0.0 END) AS above
  FROM k JOIN lev USING (budget_usd, objective, min_allocation_pct) GROUP BY ALL),
alloc AS (
  SELECT k.budget_usd, k.objective, k.min_allocation_pct, objective_order, max_penetration_pct, county,
         CASE WHEN no_room OR rest < 0 THEN 'Infeasible' ELSE 'Optimal' END AS status,
         cost_per_hh_usd, target_market, lives_saved_per_hh, co2_per_hh,
         CASE WHEN NOT (no_room OR rest < 0) THEN (lo + CASE
              WHEN level IS NULL OR ratio > level THEN cap WHEN ratio < level THEN 0.0
              ELSE greatest(0.0, least(cap, rest - above - coalesce(
                (SELECT SUM(o.cap) FROM k o WHERE o.budget_usd = k.budget_usd AND o.objective = k.objective
                 AND o.min_allocation_pct = k.min_allocation_pct AND o.ratio = k.ratio AND o.county < k.county), 0.0))) END)
              / cost_per_hh_usd END AS households_allocated
  FROM k JOIN tot USING (budget_usd, objective, min_allocation_pct)
  LEFT JOIN spent USING (budget_usd, objective, min_allocation_pct)),
alloc2 AS (
  SELECT *, households_allocated * cost_per_hh_usd AS investment_usd,
         households_allocated * cost_per_hh_usd / budget_usd * 100 AS allocation_pct,
         households_allocated * lives_saved_per_hh AS lives_saved,
         households_allocated * co2_per_hh AS co2_avoided_tons,
         households_allocated / target_market * 100 AS penetration_achieved_pct
  FROM alloc),
summary AS (
  SELECT budget_usd, objective, min_allocation_pct, objective_order, FIRST(status) AS status,
         SUM(households_allocated) AS total_households, SUM(lives_saved) AS total_lives_saved,
         SUM(co2_avoided_tons) AS total_co2_avoided_tons, SUM(investment_usd) AS total_investment,
         SUM(investment_usd) / FIRST(budget_usd) * 100 AS budget_utilization_pct,
         SUM(investment_usd) / SUM(households_allocated) AS avg_cost_per_household,
         AVG(penetration_achieved_pct) AS avg_penetration_pct
  FROM alloc2 GROUP BY budget_usd, objective, min_allocation_pct, objective_order)
"""


def _asql(budgets=BUDGETS, floors=(FLOOR,)):
    return UNITS_SQL + _scen_sql(budgets, floors) + ALLOC_SQL


@register("target_market", UNITS_SQL + """
SELECT county, population, est_households, energy_poverty_rate, target_market FROM units2
""", measures=("energy_poverty_rate",), ops="F19 T15")
def q_target_market(t):
    return _units(t).select("county", "population", "est_households", "energy_poverty_rate",
                            "target_market")


@register("weighted_product_cost", UNITS_SQL + """
SELECT weighted_product_cost, base_cost_usd FROM wpc
""", measures=("weighted_product_cost", "base_cost_usd"), ops="F20")
def q_weighted_cost(t):
    return A.weighted_product_cost(A.product_economics(t.star.dim_product))


@register("county_cost", UNITS_SQL + """
SELECT county, electrification_rate, remoteness_factor, cost_per_hh_usd FROM units2
""", measures=("electrification_rate", "remoteness_factor", "cost_per_hh_usd"), ops="F21")
def q_county_cost(t):
    return _units(t).select("county", "electrification_rate", "remoteness_factor",
                            "cost_per_hh_usd")


@register("county_impact_coeff", UNITS_SQL + """
SELECT county, poverty_rate, poverty_multiplier, lives_saved_per_hh, co2_per_hh FROM units2
""", measures=("poverty_rate", "poverty_multiplier", "lives_saved_per_hh", "co2_per_hh"),
    scale=9, ops="F22 F14 T13")
def q_impact_coeff(t):
    return _units(t).select("county", "poverty_rate", "poverty_multiplier", "lives_saved_per_hh",
                            "co2_per_hh")


@register("observed_poverty_impact", OBSERVED_SQL + f"""
, m AS (SELECT *, {_MULTIPLIER} AS poverty_multiplier FROM observed)
SELECT county, surveyed_households, poverty_rate, poverty_multiplier,
       {_LIVES} * poverty_multiplier AS lives_saved_per_hh
FROM m
""", measures=("poverty_rate", "poverty_multiplier", "lives_saved_per_hh"), scale=9, ops="F22")
def q_observed_poverty(t):
    s = t.star
    units = A.observed_county_profile(s.dim_geography, s.dim_household)
    return (units.withColumns(impact_per_household(F.col("poverty_rate")))
            .select("county", "surveyed_households", "poverty_rate", "poverty_multiplier", "lives_saved_per_hh"))


_ALLOC_OUT = ("households_allocated", "investment_usd", "allocation_pct", "lives_saved",
              "co2_avoided_tons", "penetration_achieved_pct")


@register("budget_allocation", _asql() + """
SELECT budget_usd, objective, min_allocation_pct, county, status, households_allocated, investment_usd,
       allocation_pct, lives_saved, co2_avoided_tons, penetration_achieved_pct
FROM alloc2
""", measures=("budget_usd", "min_allocation_pct") + _ALLOC_OUT, scale=4,
    ops="M1 M2 W2 J8", headline=True)
def q_budget_allocation(t):
    return _alloc(t).select("budget_usd", "objective", "min_allocation_pct", "county", "status",
                            *_ALLOC_OUT)


_SUMMARY_OUT = ("total_households", "total_lives_saved", "total_co2_avoided_tons",
                "total_investment", "budget_utilization_pct", "avg_cost_per_household",
                "avg_penetration_pct")


@register("budget_sensitivity", _asql() + """
SELECT budget_usd, objective, min_allocation_pct, status, total_households, total_lives_saved,
       total_co2_avoided_tons, total_investment, budget_utilization_pct, avg_cost_per_household,
       avg_penetration_pct
FROM summary
""", measures=("budget_usd", "min_allocation_pct") + _SUMMARY_OUT, scale=4, ops="M3 A15 J8 U2")
def q_budget_sensitivity(t):
    return A.scenario_summary(_alloc(t)).drop("objective_order")


@register("distinct_scenarios", _asql() + """
SELECT DISTINCT objective, budget_usd FROM summary
""", measures=("budget_usd",), ops="A18")
def q_distinct_scenarios(t):
    return A.scenario_summary(_alloc(t)).select("objective", "budget_usd").distinct()


@register("equity_tradeoff", _asql((EQUITY_BUDGET,), (FLOOR, 0.0)) + """
, long AS (
  SELECT budget_usd, objective, 'total_lives_saved' AS metric,
         MAX(CASE WHEN min_allocation_pct > 0 THEN total_lives_saved END) AS with_equity,
         MAX(CASE WHEN min_allocation_pct <= 0 THEN total_lives_saved END) AS without_equity
  FROM summary GROUP BY budget_usd, objective
  UNION ALL
  SELECT budget_usd, objective, 'total_co2_avoided_tons',
         MAX(CASE WHEN min_allocation_pct > 0 THEN total_co2_avoided_tons END),
         MAX(CASE WHEN min_allocation_pct <= 0 THEN total_co2_avoided_tons END)
  FROM summary GROUP BY budget_usd, objective
  UNION ALL
  SELECT budget_usd, objective, 'total_households',
         MAX(CASE WHEN min_allocation_pct > 0 THEN total_households END),
         MAX(CASE WHEN min_allocation_pct <= 0 THEN total_households END)
  FROM summary GROUP BY budget_usd, objective)
SELECT *, CASE WHEN without_equity > 0 THEN (without_equity - with_equity) / without_equity * 100 END AS equity_cost_pct
FROM long
""", measures=("budget_usd", "with_equity", "without_equity", "equity_cost_pct"), scale=4, ops="M4")
def q_equity(t):
    return A.equity_tradeoff(A.scenario_summary(_alloc(t, (EQUITY_BUDGET,), (FLOOR, 0.0))))


@register("top_counties", _asql() + """
SELECT budget_usd, objective, min_allocation_pct, county, lives_saved, investment_usd, households_allocated, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY budget_usd, objective, min_allocation_pct
                                        ORDER BY lives_saved DESC, county) AS INTEGER) AS rank FROM alloc2)
WHERE rank <= 5
""", measures=("budget_usd", "min_allocation_pct", "lives_saved", "investment_usd",
               "households_allocated"), scale=4, ops="W1 L3")
def q_top_counties(t):
    return A.top_units(_alloc(t), "lives_saved", 5).select(
        "budget_usd", "objective", "min_allocation_pct", "county", "lives_saved",
        "investment_usd", "households_allocated", "rank")


@register("allocation_efficiency", _asql() + """
SELECT budget_usd, objective, min_allocation_pct, county, investment_usd, lives_saved,
       lives_saved / NULLIF(investment_usd, 0.0) * 1000 AS lives_per_1000_usd
FROM alloc2
""", measures=("budget_usd", "min_allocation_pct", "investment_usd", "lives_saved",
               "lives_per_1000_usd"), scale=4, ops="F24 M6")
def q_efficiency(t):
    return A.allocation_efficiency(_alloc(t))


@register("best_objective", _asql() + """
, stacked AS (
  SELECT budget_usd, min_allocation_pct, objective, objective_order, 'total_households' AS metric,
         ROUND(total_households, 6) AS value FROM summary
  UNION ALL SELECT budget_usd, min_allocation_pct, objective, objective_order, 'total_lives_saved',
         ROUND(total_lives_saved, 6) FROM summary
  UNION ALL SELECT budget_usd, min_allocation_pct, objective, objective_order, 'total_co2_avoided_tons',
         ROUND(total_co2_avoided_tons, 6) FROM summary)
SELECT budget_usd, min_allocation_pct, metric, objective AS best_objective, value AS best_value
FROM (SELECT *, row_number() OVER (PARTITION BY budget_usd, min_allocation_pct, metric
                                   ORDER BY value DESC, objective_order) AS r FROM stacked)
WHERE r = 1
""", measures=("budget_usd", "min_allocation_pct", "best_value"), scale=4, ops="M8")
def q_best_objective(t):
    return A.best_objective(A.scenario_summary(_alloc(t)))


@register("recommendation_table", _asql() + """
, top AS (
  SELECT budget_usd, objective, min_allocation_pct, string_agg(county, ', ' ORDER BY rank) AS top_3_counties
  FROM (SELECT *, row_number() OVER (PARTITION BY budget_usd, objective, min_allocation_pct
                                     ORDER BY ROUND(investment_usd, 2) DESC, county) AS rank FROM alloc2)
  WHERE rank <= 3 GROUP BY budget_usd, objective, min_allocation_pct)
SELECT s.budget_usd, s.objective, s.min_allocation_pct, s.status,
       CASE WHEN s.budget_usd >= 1e6 THEN '$' || format('{:,.0f}', s.budget_usd / 1e6) || 'M'
            ELSE '$' || format('{:,.0f}', s.budget_usd / 1e3) || 'K' END AS budget_label,
       array_to_string(list_transform(string_split(replace(s.objective, '_', ' '), ' '),
                                      lambda w: upper(w[1]) || lower(w[2:])), ' ') AS objective_label,
       format('{:,.0f}', s.total_households) AS households_text,
       format('{:,.1f}', s.total_lives_saved) AS lives_saved_text,
       format('{:,.0f}', s.total_co2_avoided_tons) AS co2_avoided_text,
       t.top_3_counties,
       '$' || format('{:,.2f}', s.avg_cost_per_household) AS avg_cost_text,
       s.total_households, s.total_lives_saved, s.total_co2_avoided_tons, s.avg_cost_per_household
FROM summary s LEFT JOIN top t ON s.budget_usd = t.budget_usd AND s.objective = t.objective
  AND s.min_allocation_pct = t.min_allocation_pct
""", measures=("budget_usd", "min_allocation_pct", "total_households", "total_lives_saved",
               "total_co2_avoided_tons", "avg_cost_per_household"), scale=4, ops="M5 L2 C2 C3")
def q_recommendation(t):
    return A.recommendation_table(_alloc(t))


@register("quota_allocation", OBSERVED_SQL + """
, tot AS (SELECT COUNT(*) AS n FROM dim_household),
ws AS (SELECT SUM(population) AS wsum FROM observed),
q AS (SELECT c.county, CAST(c.population AS DOUBLE) / ws.wsum AS share,
             CAST(trunc(tot.n * (CAST(c.population AS DOUBLE) / ws.wsum)) AS BIGINT) AS base_quota, tot.n
      FROM observed c, ws, tot)
SELECT county, share, base_quota,
       CAST(base_quota + CASE WHEN county = 'NATION_24' THEN n - (SELECT SUM(base_quota) FROM q) ELSE 0 END
            AS BIGINT) AS quota
FROM q
""", measures=("share",), scale=9, ops="F25")
def q_quota(t):
    s = t.star
    units = A.observed_county_profile(s.dim_geography, s.dim_household)
    return A.quota_allocation(units, "surveyed_households", "population", remainder_unit="NATION_24")


@register("impact_potential", """
SELECT g.county, COUNT(DISTINCT f.household_key) AS adopters,
       COUNT(DISTINCT f.household_key) * 1.7 AS co2_potential_tons,
       COUNT(DISTINCT f.household_key) * 1.7 * 12.50 AS carbon_value_usd
FROM fact_adoptions f JOIN dim_geography g ON f.geography_key = g.geography_key
GROUP BY g.county
""", measures=("co2_potential_tons", "carbon_value_usd"), ops="M7")
def q_impact_potential(t):
    from decimal import Decimal
    s = t.star
    g = s.dim_geography.select("geography_key", "county")
    n = F.count_distinct("household_key")
    return (s.fact_adoptions.join(g, "geography_key").groupBy("county")
            .agg(n.alias("adopters"))
            .withColumn("co2_potential_tons", F.col("adopters") * F.lit(Decimal("1.7")))
            .withColumn("carbon_value_usd", F.col("co2_potential_tons") * F.lit(Decimal("12.50"))))
