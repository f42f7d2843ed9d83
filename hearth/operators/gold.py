"""Gold layer.

The reference's gold views join the fact table to the impact view on
``household_key`` alone (T3): a household with n adoptions contributes n x n
joined rows. That result is reproduced *exactly* without emitting the pairs:
each side is pre-aggregated per household (row count, sums, flags) and the
joined sums are rebuilt as products,

    SUM(i.x) over pairs   = sum_h  nF(h) * SUM_I(x)(h)
    SUM(f.y) over pairs   = sum_h  nI(h) * SUM_F(y)(h)
    COUNT(DISTINCT h | p) = count of households whose F rows have p.

Both pre-aggregations shuffle on ``household_key`` with map-side combine, so a
household holding a third of all rows costs one partial row per map task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.impact import DEFAULT_IMPACT, ImpactCoefficients, impact_columns

# Product types pivoted into the county performance view.
PRODUCT_MIX = (("charcoal_stove", "charcoal_stoves"), ("firewood_stove", "firewood_stoves"),
               ("pellet_stove", "pellet_stoves"), ("solar_lantern", "solar_lanterns"))

IMPACT_MEASURES = ("co2_avoided_annual", "carbon_credit_value_usd", "mortality_reduction",
                   "dalys_avoided", "annual_fuel_savings_ksh", "time_saved_hours_annual",
                   "healthcare_savings_annual_ksh")


def _flag(cond: Column) -> Column:
    return F.max(F.when(cond, 1).otherwise(0))


def _count_product(counts: list[str]) -> Column:
    """Product of row counts as DECIMAL(38,0): no BIGINT overflow for hot households."""
    n = None
    for c in counts:
        d = F.col(c).cast("decimal(20,0)")
        n = d if n is None else (n * d).cast("decimal(38,0)")
    return n


def _pair_sum(j: DataFrame, counts: list[str], measure: str, factor: int = 1,
              factor_scale: int = 0) -> Column:
    """SUM of ``measure`` over the implied joined pairs, i.e. sum(count product x sum).

    DECIMAL measures are carried as unscaled integers (value x 10^scale in
    DECIMAL(38,0)). Spark's decimal precision rules can then never cut a digit,
    and a household with millions of rows on each side cannot overflow a
    narrow type. The total becomes DOUBLE once, at the end; ``factor`` /
    10^``factor_scale`` scales it exactly first (e.g. 17 / 10^2 for 0.17).
    Integer measures return the exact DECIMAL(38,0) total.
    """
    dt = j.schema[measure].dataType
    n = _count_product(counts)
    m = F.col(measure)
    if isinstance(dt, T.DecimalType):
        unscaled = (m * F.lit(Decimal(10) ** dt.scale)).cast("decimal(38,0)")
        total = F.sum((n * unscaled).cast("decimal(38,0)"))
        if factor != 1:
            total = (total * F.lit(Decimal(factor))).cast("decimal(38,0)")
        return total.cast("double") / F.lit(float(10 ** (dt.scale + factor_scale)))
    if isinstance(dt, T.IntegralType):
        return F.sum((n * m.cast("decimal(20,0)")).cast("decimal(38,0)"))
    return F.sum(n.cast("double") * m.cast("double"))


def _ratio_factor(x: float) -> tuple[int, int]:
    """An exact decimal coefficient as (integer, scale): 0.17 -> (17, 2)."""
    d = Decimal(str(x)).normalize()
    exp = -d.as_tuple().exponent if d.as_tuple().exponent < 0 else 0
    return int(d.scaleb(exp)), exp


def impact_per_household(impact: DataFrame) -> DataFrame:
    """nI and impact sums per household (the I side of the fan-out)."""
    return (impact.groupBy("household_key")
            .agg(F.count(F.lit(1)).alias("n_i"),
                 *[F.sum(m).alias(f"si_{m}") for m in IMPACT_MEASURES]))


def household_facts(households: DataFrame) -> DataFrame:
    """Household-side counts per key (1 row per key when the key is unique)."""
    tags = F.col("vulnerability_factors")
    return (households.groupBy("household_key")
            .agg(F.count(F.lit(1)).alias("n_h"),
                 F.sum(F.when(tags.contains("Elderly"), 1).otherwise(0)).alias("h_elderly"),
                 F.sum(F.when(tags.contains("Single Parent"), 1).otherwise(0)).alias("h_single_parent"),
                 F.sum(F.when(F.col("children_under_18") > 0, F.col("children_under_18"))
                       .otherwise(0)).alias("h_children"),
                 _flag(F.col("head_gender") == "Female").alias("h_female")))


def _fact_side(adoptions: DataFrame, keys: list[str], extra: list[Column]) -> DataFrame:
    u = F.col("usage_intensity")
    s = F.col("subsidy_amount")
    return (adoptions.groupBy("household_key", *keys)
            .agg(F.count(F.lit(1)).alias("n_f"),
                 F.sum(u).alias("sf_usage"), F.count(u).alias("nf_usage"),
                 F.sum(s).alias("sf_subsidy"), F.count(s).alias("nf_subsidy"),
                 *extra))


def gold_executive_summary(adoptions: DataFrame, impact: DataFrame,
                           coef: ImpactCoefficients = DEFAULT_IMPACT) -> DataFrame:
    """One row, even on empty input."""
    u = F.col("usage_intensity")
    f = _fact_side(adoptions, [], [_flag(u >= 0.8).alias("full"), _flag(u < 0.5).alias("low")])
    return executive_totals(f.join(impact_per_household(impact), "household_key"), coef)


def executive_totals(j: DataFrame, coef: ImpactCoefficients = DEFAULT_IMPACT) -> DataFrame:
    """The executive row from one row per household with both sides' counts and sums."""
    ps = lambda counts, m: _pair_sum(j, counts, m)
    hh = F.count(F.lit(1))
    return j.agg(
        hh.alias("total_households_reached"),
        ps(["n_f"], "si_co2_avoided_annual").alias("total_co2_avoided_tons"),
        ps(["n_f"], "si_carbon_credit_value_usd").alias("total_carbon_credit_value"),
        ps(["n_f"], "si_dalys_avoided").alias("total_dalys_avoided"),
        ps(["n_f"], "si_annual_fuel_savings_ksh").alias("total_fuel_savings_ksh"),
        (ps(["n_i"], "sf_usage") / ps(["n_i"], "nf_usage").cast("double"))
        .alias("avg_usage_intensity"),
        F.coalesce(F.sum("full"), F.lit(0)).cast("bigint").alias("full_adopters"),
        F.coalesce(F.sum("low"), F.lit(0)).cast("bigint").alias("low_adopters"),
        ps(["n_i"], "sf_subsidy").alias("total_subsidies"),
        (ps(["n_i"], "sf_subsidy") / ps(["n_i"], "nf_subsidy").cast("double"))
        .alias("avg_subsidy_per_household"),
        (hh.cast("double") / F.lit(coef.households_goal) * 100).alias("pct_of_goal_achieved"),
    )


def gold_county_performance(adoptions: DataFrame, geography: DataFrame, products: DataFrame,
                            impact: DataFrame, product_mix=PRODUCT_MIX) -> DataFrame:
    """Per-county reach, impact, ROI and product mix.

    The five conditional COUNT DISTINCTs become per-household max-flags summed
    per county (two-level plan) instead of Catalyst's k-fold Expand.
    """
    g = geography.select("geography_key", "county", "poverty_rate",
                         "electrification_rate", "population")
    p = products.select("product_key", "product_type")
    keys = ["county", "poverty_rate", "electrification_rate", "population"]
    ptype = F.col("product_type")
    f = _fact_side(adoptions.join(g, "geography_key").join(p, "product_key"), keys,
                   [_flag(ptype == t).alias(f"has_{name}") for t, name in product_mix])
    return county_totals(f.join(impact_per_household(impact), "household_key"), product_mix)


def gold_county_fanout(adoptions: DataFrame, members: DataFrame, geography: DataFrame, products: DataFrame,
                       coef: ImpactCoefficients = DEFAULT_IMPACT, product_mix=PRODUCT_MIX) -> DataFrame:
    """G5 over a fact with several adoptions per household (J5), which carries no county.

    ``members`` holds one row (household_key, geography_key) per household, so all
    adoptions of a household meet all its impact rows: one aggregate per household,
    with map-side combine, gives both sides. It comes before the household and
    county joins, so a hot household reaches no join row by row.
    """
    p = products.select("product_key", "product_type", "carbon_reduction_tons_year", "pm25_emissions_mg_m3")
    measures = impact_columns(F.col("carbon_reduction_tons_year"), F.col("pm25_emissions_mg_m3"),
                              F.col("usage_intensity"), F.col("baseline_weekly_fuel_cost_ksh"), coef)
    ptype = F.col("product_type")
    per = _fact_side(adoptions.join(p, "product_key"), [],
                     [_flag(ptype == t).alias(f"has_{name}") for t, name in product_mix]
                     + [F.sum(measures[m]).alias(f"si_{m}") for m in IMPACT_MEASURES])
    g = geography.select("geography_key", "county", "poverty_rate", "electrification_rate", "population")
    j = (per.withColumn("n_i", F.col("n_f")).join(members, "household_key").join(g, "geography_key"))
    return county_totals(j, product_mix)


def county_totals(j: DataFrame, product_mix) -> DataFrame:
    """County rows from one row per (household, county) with both sides' counts and sums."""
    keys = ["county", "poverty_rate", "electrification_rate", "population"]
    ps = lambda counts, m: _pair_sum(j, counts, m)
    hh = F.count(F.lit(1))
    return (j.groupBy(*keys).agg(
        hh.alias("households_reached"),
        (hh.cast("double") / F.col("population") * 4.5 * 100).alias("penetration_rate"),
        ps(["n_f"], "si_co2_avoided_annual").alias("co2_avoided"),
        ps(["n_f"], "si_dalys_avoided").alias("dalys_avoided"),
        ps(["n_f"], "si_annual_fuel_savings_ksh").alias("fuel_savings"),
        (ps(["n_f"], "si_carbon_credit_value_usd")
         / F.nullif(ps(["n_i"], "sf_subsidy"), F.lit(0.0))).alias("roi_ratio"),
        (ps(["n_i"], "sf_usage") / ps(["n_i"], "nf_usage").cast("double"))
        .alias("avg_usage_intensity"),
        *[F.sum(f"has_{name}").cast("bigint").alias(name) for _, name in product_mix],
    ).drop("population"))


def gold_donor_health_impact(adoptions: DataFrame, households: DataFrame,
                             geography: DataFrame, impact: DataFrame) -> DataFrame:
    """Per-county health outcomes and vulnerable reach."""
    g = geography.select("geography_key", "county")
    f = _fact_side(adoptions.join(g, "geography_key"), ["county"], [])
    return health_totals(f.join(household_facts(households), "household_key")
                         .join(impact_per_household(impact), "household_key"))


def health_totals(j: DataFrame) -> DataFrame:
    """Health rows per county from one row per (household, county) with all sides' counts and sums."""
    ps = lambda counts, m: _pair_sum(j, counts, m)
    return (j.groupBy("county").agg(
        F.count(F.lit(1)).alias("households"),
        ps(["n_f", "n_h"], "si_mortality_reduction").alias("lives_saved"),
        ps(["n_f", "n_h"], "si_dalys_avoided").alias("dalys_avoided"),
        ps(["n_f", "n_h"], "si_healthcare_savings_annual_ksh").alias("healthcare_cost_avoided"),
        ps(["n_f", "n_i"], "h_elderly").cast("bigint").alias("elderly_reached"),
        ps(["n_f", "n_i"], "h_children").cast("bigint").alias("children_impacted"),
    ))


def gold_donor_environment_impact(adoptions: DataFrame, products: DataFrame,
                                  geography: DataFrame, impact: DataFrame,
                                  coef: ImpactCoefficients = DEFAULT_IMPACT) -> DataFrame:
    """Per-county carbon, credits, tree equivalent and PM2.5."""
    g = geography.select("geography_key", "county")
    p = products.select("product_key", "pm25_emissions_mg_m3")
    pm = F.col("pm25_emissions_mg_m3") * F.col("usage_intensity")
    f = _fact_side(adoptions.join(p, "product_key").join(g, "geography_key"), ["county"],
                   [F.sum(pm).alias("sf_pm25")])
    return environment_totals(f.join(impact_per_household(impact), "household_key"), coef)


def environment_totals(j: DataFrame, coef: ImpactCoefficients = DEFAULT_IMPACT) -> DataFrame:
    """Environment rows per county from one row per (household, county) with both sides' counts and sums."""
    trees, trees_scale = _ratio_factor(coef.trees_per_ton)
    return (j.groupBy("county").agg(
        F.count(F.lit(1)).alias("households"),
        _pair_sum(j, ["n_f"], "si_co2_avoided_annual").alias("co2_avoided_tons"),
        _pair_sum(j, ["n_f"], "si_carbon_credit_value_usd").alias("carbon_credit_value"),
        _pair_sum(j, ["n_f"], "si_co2_avoided_annual", trees, trees_scale).alias("trees_equivalent"),
        _pair_sum(j, ["n_i"], "sf_pm25").alias("pm25_reduced"),
    ))


def gold_donor_gender_impact(adoptions: DataFrame, households: DataFrame,
                             geography: DataFrame, impact: DataFrame,
                             coef: ImpactCoefficients = DEFAULT_IMPACT) -> DataFrame:
    """Female-headed reach and time saved per county."""
    g = geography.select("geography_key", "county")
    f = _fact_side(adoptions.join(g, "geography_key"), ["county"], [])
    return gender_totals(f.join(household_facts(households), "household_key")
                         .join(impact_per_household(impact), "household_key"), coef)


def gender_totals(j: DataFrame, coef: ImpactCoefficients = DEFAULT_IMPACT) -> DataFrame:
    """Gender rows per county from one row per (household, county) with all sides' counts and sums."""
    share, share_scale = _ratio_factor(coef.women_time_share)
    return (j.groupBy("county").agg(
        F.sum("h_female").cast("bigint").alias("female_headed_households"),
        _pair_sum(j, ["n_f", "n_h"], "si_time_saved_hours_annual").alias("total_time_saved_hours"),
        _pair_sum(j, ["n_f", "n_h"], "si_time_saved_hours_annual", share, share_scale)
        .alias("women_time_saved_hours"),
        _pair_sum(j, ["n_f", "n_i"], "h_single_parent").cast("bigint").alias("single_parents_reached"),
    ))


def v_adoption_summary(adoptions: DataFrame, households: DataFrame,
                       products: DataFrame) -> DataFrame:
    """Star join to two dimensions, grouped three ways.

    Eager aggregation: the fact is first reduced per (household, product)
    with map-side combine, so the dimension joins see one row per pair and a
    hot household cannot skew them. COUNT, SUM and AVG (as sum / count)
    decompose exactly.
    """
    u = F.col("usage_intensity")
    f = (adoptions.groupBy("household_key", "product_key")
         .agg(F.count(F.lit(1)).alias("n"), F.sum(u).alias("su"), F.count(u).alias("nu"),
              F.sum("subsidy_amount").alias("ss")))
    h = households.select("household_key", "county", "urban_rural")
    p = products.select("product_key", "product_type")
    return (f.join(h, "household_key").join(p, "product_key")
            .groupBy("county", "urban_rural", "product_type")
            .agg(F.sum("n").alias("adoption_count"),
                 (F.sum("su").cast("double") / F.sum("nu")).alias("avg_usage_intensity"),
                 F.sum("ss").alias("total_subsidy")))
