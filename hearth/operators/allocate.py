"""Budget allocation across counties.

The reference solves one small LP per scenario: maximise sum(x * gain) subject
to sum(x * cost) <= budget and floor * budget / cost <= x <= cap * target.
With spend = x * cost this is a continuous bounded knapsack, solved exactly by
funding every floor and then filling the best gain/cost first. That is a
running sum over a window partitioned by scenario, so every scenario of a
sensitivity grid is solved in one Spark plan, in parallel across scenarios.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.impact import (DEFAULT_ALLOCATION, AllocationCoefficients,
                                cost_per_household, impact_per_household,
                                market_columns)

OBJECTIVES = ("lives_saved", "co2_avoided", "households_reached")
SCENARIO_KEYS = ["budget_usd", "objective", "min_allocation_pct"]


def county_profile(geography: DataFrame) -> DataFrame:
    """Allocation units from the geography dimension: one row per county."""
    return geography.select("county", "region", "population",
                            F.col("poverty_rate").cast("double").alias("poverty_rate"),
                            F.col("electrification_rate").cast("double").alias("electrification_rate"))


def observed_county_profile(geography: DataFrame, households: DataFrame) -> DataFrame:
    """Allocation units with an observed poverty rate, for the counties that were surveyed.

    It is the share of a county's surveyed households with a monthly income under 10,000.
    """
    stats = (households.groupBy("county")
             .agg(F.count(F.lit(1)).alias("surveyed_households"),
                  F.avg(F.when(F.col("monthly_income_ksh") < 10000, 1).otherwise(0))
                  .alias("poor_share")))
    return (geography.join(stats, "county")
            .select("county", "region", "population", "surveyed_households",
                    F.round(F.col("poor_share") * 100, 2).alias("poverty_rate"),
                    F.col("electrification_rate").cast("double").alias("electrification_rate")))


def target_market(counties: DataFrame,
                  coef: AllocationCoefficients = DEFAULT_ALLOCATION) -> DataFrame:
    """F19."""
    return counties.withColumns(market_columns(F.col("population"),
                                               F.col("electrification_rate"), coef))


def product_economics(products: DataFrame,
                      coef: AllocationCoefficients = DEFAULT_ALLOCATION) -> DataFrame:
    """Per product type: mean unit cost and the subsidy per unit sold."""
    return (products.groupBy("product_type")
            .agg((F.sum("unit_cost_usd").cast("double") / F.count("unit_cost_usd"))
                 .alias("unit_cost_usd"))
            .withColumn("sale_price_usd", F.lit(coef.sale_price_usd))
            .withColumn("subsidy_per_unit", F.col("unit_cost_usd") - F.col("sale_price_usd")))


def weighted_product_cost(economics: DataFrame,
                          coef: AllocationCoefficients = DEFAULT_ALLOCATION) -> DataFrame:
    """one row; fails (at run time) if a weighted product type is missing."""
    spark = economics.sparkSession
    weights = spark.createDataFrame(list(coef.product_weights.items()),
                                    "product_type string, weight double")
    n = len(coef.product_weights)
    j = economics.join(F.broadcast(weights), "product_type")
    agg = j.agg(F.sum(F.col("weight") * F.col("subsidy_per_unit")).alias("weighted_product_cost"),
                F.count(F.lit(1)).alias("matched"))
    checked = F.when(F.col("matched") == n, F.col("weighted_product_cost")).otherwise(
        F.raise_error(F.lit("weighted product type missing from the product table")))
    return agg.select(checked.cast("double").alias("weighted_product_cost"),
                      (checked + F.lit(coef.operational_cost)).cast("double").alias("base_cost_usd"))


def county_units(counties: DataFrame, base_cost: DataFrame,
                 coef: AllocationCoefficients = DEFAULT_ALLOCATION) -> DataFrame:
    """F19 + F21 + F22: every per-county coefficient the allocation needs.

    ``base_cost`` is the one-row output of ``weighted_product_cost``; it is
    attached as a scalar subquery, which Spark evaluates once and checks at
    run time to return at most one row.
    """
    c = target_market(counties, coef).withColumn(
        "base_cost_usd", base_cost.select("base_cost_usd").scalar())
    c = c.withColumns(cost_per_household(F.col("base_cost_usd"), F.col("electrification_rate"), coef))
    return c.withColumns(impact_per_household(F.col("poverty_rate"), coef))


def scenario_grid(budgets: Sequence[float], objectives: Sequence[str] = OBJECTIVES,
                  floors: Sequence[float] = (0.03,), cap: float = 0.25) -> list[tuple]:
    """Budgets x objectives x floors as a parameter list.

    Rows are (budget_usd, objective, objective_order, min_allocation_pct,
    max_penetration_pct); its length is the number of parameters listed.
    """
    return [(float(b), o, i, float(f), float(cap))
            for b in budgets for i, o in enumerate(objectives) for f in floors]


def _with_scenarios(units: DataFrame, scenarios: Sequence[tuple]) -> DataFrame:
    """Attach every scenario to every unit with ``inline`` over a literal array.

    No join: each unit row generates one row per listed scenario, so the
    output is units x (number of parameters), bounded by the caller's list.
    """
    structs = [F.struct(F.lit(float(b)).alias("budget_usd"), F.lit(o).alias("objective"),
                        F.lit(int(i)).alias("objective_order"),
                        F.lit(float(f)).alias("min_allocation_pct"),
                        F.lit(float(c)).alias("max_penetration_pct"))
               for b, o, i, f, c in scenarios]
    return units.select("*", F.inline(F.array(*structs)))


def _gain(objective: Column) -> Column:
    return (F.when(objective == "lives_saved", F.col("lives_saved_per_hh"))
            .when(objective == "co2_avoided", F.col("co2_per_hh"))
            .otherwise(F.lit(1.0)))


def allocate(units: DataFrame, scenarios: Sequence[tuple]) -> DataFrame:
    """M1 + M2: exact allocation per scenario and county, with metrics.

    ``scenarios`` is the parameter list of ``scenario_grid``. The window
    partitions by scenario, so one task sorts one scenario's counties (a
    bounded dimension) and scenarios are solved in parallel.
    """
    j = _with_scenarios(units, scenarios)
    scen = Window.partitionBy(*SCENARIO_KEYS)
    gain = _gain(F.col("objective"))
    cost = F.col("cost_per_hh_usd")
    lo = F.col("min_allocation_pct") * F.col("budget_usd")
    hi = F.col("max_penetration_pct") * F.col("target_market") * cost
    j = j.withColumns({"gain": gain, "lo": lo, "room": hi - lo,
                       "ratio": gain / cost})
    ordered = (scen.orderBy(F.desc("ratio"), F.asc("county"))
               .rowsBetween(Window.unboundedPreceding, -1))
    fillable = F.when(F.col("gain") > 0, F.col("room")).otherwise(F.lit(0.0))
    j = j.withColumns({
        "rest": F.col("budget_usd") - F.sum("lo").over(scen),
        "prior": F.coalesce(F.sum(fillable).over(ordered), F.lit(0.0)),
        "infeasible": F.max((F.col("room") < 0).cast("int")).over(scen) == 1,
    })
    fill = F.when(F.col("gain") > 0,
                  F.greatest(F.lit(0.0), F.least(F.col("room"), F.col("rest") - F.col("prior")))
                  ).otherwise(F.lit(0.0))
    infeasible = F.col("infeasible") | (F.col("rest") < 0)
    x = F.when(~infeasible, (F.col("lo") + fill) / cost)
    j = j.withColumn("households_allocated", x)
    hh = F.col("households_allocated")
    return j.select(
        *SCENARIO_KEYS, "objective_order", "max_penetration_pct", "county",
        F.when(infeasible, "Infeasible").otherwise("Optimal").alias("status"),
        "cost_per_hh_usd", "target_market", "lives_saved_per_hh", "co2_per_hh",
        "households_allocated",
        (hh * cost).alias("investment_usd"),
        (hh * cost / F.col("budget_usd") * 100).alias("allocation_pct"),
        (hh * F.col("lives_saved_per_hh")).alias("lives_saved"),
        (hh * F.col("co2_per_hh")).alias("co2_avoided_tons"),
        (hh / F.col("target_market") * 100).alias("penetration_achieved_pct"),
    )


def _summary_measures() -> list[Column]:
    inv = F.sum("investment_usd")
    hh = F.sum("households_allocated")
    return [F.first("status").alias("status"),
            hh.alias("total_households"),
            F.sum("lives_saved").alias("total_lives_saved"),
            F.sum("co2_avoided_tons").alias("total_co2_avoided_tons"),
            inv.alias("total_investment"),
            (inv / F.first("budget_usd") * 100).alias("budget_utilization_pct"),
            (inv / hh).alias("avg_cost_per_household"),
            F.avg("penetration_achieved_pct").alias("avg_penetration_pct")]


def scenario_summary(allocation: DataFrame) -> DataFrame:
    """One row per scenario (unweighted mean penetration)."""
    return allocation.groupBy(*SCENARIO_KEYS, "objective_order").agg(*_summary_measures())


def equity_tradeoff(summary: DataFrame) -> DataFrame:
    """M4: floor on vs off per objective; cost % guarded when 'without' is 0."""
    on = F.col("min_allocation_pct") > 0
    rows = []
    for metric in ("total_lives_saved", "total_co2_avoided_tons", "total_households"):
        rows.append(F.struct(F.lit(metric).alias("metric"),
                             F.max(F.when(on, F.col(metric))).alias("with_equity"),
                             F.max(F.when(~on, F.col(metric))).alias("without_equity")))
    wide = summary.groupBy("budget_usd", "objective").agg(F.array(*rows).alias("m"))
    long = wide.select("budget_usd", "objective", F.inline("m"))
    wo, wi = F.col("without_equity"), F.col("with_equity")
    return long.withColumn("equity_cost_pct",
                           F.when(wo > 0, (wo - wi) / wo * 100))


def _rank_window(by: str, money: bool) -> WindowSpec:
    key = F.round(F.col(by), 2) if money else F.col(by)
    return Window.partitionBy(*SCENARIO_KEYS).orderBy(key.desc(), F.col("county").asc())


def top_units(allocation: DataFrame, by: str, k: int, money: bool = False) -> DataFrame:
    """Top-k counties per scenario; ties broken by county name.

    Money is compared rounded to cents so float noise cannot reorder ties.
    """
    return (allocation.withColumn("rank", F.row_number().over(_rank_window(by, money)))
            .where(F.col("rank") <= k))


def _money(x: Column, decimals: int) -> Column:
    return F.format_number(x, decimals)


def recommendation_table(allocation: DataFrame, k: int = 3) -> DataFrame:
    """Per-scenario headline row with the top-k counties by investment.

    One pass: counties are ranked by a window partitioned by scenario, and the
    same grouped aggregate computes the scenario totals and collects the
    counties ranked 1..k (``collect_list`` skips the NULLs of the others, so
    it holds at most k entries). Its keys include the window's partition
    keys, so no further shuffle and no join are needed.
    """
    ranked = allocation.withColumn("rank", F.row_number().over(
        _rank_window("investment_usd", money=True)))
    top = F.collect_list(F.when(F.col("rank") <= k, F.struct("rank", "county")))
    per = ranked.groupBy(*SCENARIO_KEYS, "objective_order").agg(
        *_summary_measures(),
        F.array_join(F.transform(F.array_sort(top), lambda s: s["county"]), ", ")
        .alias(f"top_{k}_counties"))
    b = F.col("budget_usd")
    label = (F.when(b >= 1e6, F.concat(F.lit("$"), F.format_number(b / 1e6, 0), F.lit("M")))
             .otherwise(F.concat(F.lit("$"), F.format_number(b / 1e3, 0), F.lit("K"))))
    return per.select(
        *SCENARIO_KEYS, "status",
        label.alias("budget_label"),
        F.initcap(F.regexp_replace("objective", "_", " ")).alias("objective_label"),
        _money(F.col("total_households"), 0).alias("households_text"),
        _money(F.col("total_lives_saved"), 1).alias("lives_saved_text"),
        _money(F.col("total_co2_avoided_tons"), 0).alias("co2_avoided_text"),
        f"top_{k}_counties",
        F.concat(F.lit("$"), _money(F.col("avg_cost_per_household"), 2)).alias("avg_cost_text"),
        "total_households", "total_lives_saved", "total_co2_avoided_tons",
        "avg_cost_per_household")


def allocation_efficiency(allocation: DataFrame) -> DataFrame:
    """Lives saved per 1,000 USD invested."""
    return allocation.select(
        *SCENARIO_KEYS, "county", "investment_usd", "lives_saved",
        (F.col("lives_saved") / F.nullif(F.col("investment_usd"), F.lit(0.0)) * 1000)
        .alias("lives_per_1000_usd"))


def best_objective(summary: DataFrame) -> DataFrame:
    """M8: per budget and metric, the objective with the largest value (first wins)."""
    metrics = ("total_households", "total_lives_saved", "total_co2_avoided_tons")
    stacked = summary.select(
        "budget_usd", "min_allocation_pct", "objective", "objective_order",
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"),
                                    F.round(F.col(m), 6).alias("value")) for m in metrics])))
    w = (Window.partitionBy("budget_usd", "min_allocation_pct", "metric")
         .orderBy(F.desc("value"), F.asc("objective_order")))
    return (stacked.withColumn("r", F.row_number().over(w)).where("r = 1")
            .select("budget_usd", "min_allocation_pct", "metric",
                    F.col("objective").alias("best_objective"), F.col("value").alias("best_value")))


def quota_allocation(units: DataFrame, count: str, weight: str,
                     remainder_unit: str) -> DataFrame:
    """``int(n * w)`` per unit; the shortfall goes to one named unit.

    ``n`` is the sum of ``count`` over all units. Totals are windows over the
    units, one row per county (a bounded dimension), so their source is read once.
    """
    every = Window.partitionBy()
    u = (units.withColumn("share", F.col(weight) / F.sum(weight).over(every))
         .withColumn("n", F.sum(count).over(every))
         .withColumn("base_quota", (F.col("n") * F.col("share")).cast("bigint")))
    assigned = F.sum("base_quota").over(every)
    return u.select(
        "county", "share", "base_quota",
        (F.col("base_quota") + F.when(F.col("county") == remainder_unit,
                                      F.col("n") - assigned).otherwise(0)).alias("quota"))
