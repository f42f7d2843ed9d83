"""Data-quality jobs (Q1-Q11): single-pass aggregates, anti joins, stacks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import household_is_valid, quality_flags


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    lo: float | None = None
    hi: float | None = None
    allowed: tuple | None = None

    def violation(self) -> Column:
        c = F.col(self.column)
        if self.allowed is not None:
            return ~c.isin(*self.allowed)
        bad = F.lit(False)
        if self.lo is not None:
            bad = bad | (c < self.lo)
        if self.hi is not None:
            bad = bad | (c > self.hi)
        return bad


# Documented valid ranges.
HOUSEHOLD_RULES = (
    Rule("gps_latitude_range", "gps_latitude", -4.5, 4.5),
    Rule("gps_longitude_range", "gps_longitude", 33.5, 42.0),
    Rule("head_age_range", "head_age", 18, 100),
    Rule("household_size_range", "household_size", 1, 20),
    Rule("children_range", "children_under_18", 0, 15),
    Rule("elderly_range", "elderly_over_60", 0, 5),
    Rule("income_range", "monthly_income_ksh", 0, 500000),
    Rule("urban_rural_values", "urban_rural", allowed=("Urban", "Rural")),
    Rule("head_gender_values", "head_gender", allowed=("Male", "Female")),
    Rule("marital_status_values", "marital_status",
         allowed=("Single", "Married", "Divorced", "Widowed")),
)
ADOPTION_RULES = (
    Rule("payment_method_values", "payment_method", allowed=("Cash", "M-Pesa", "Credit")),
    Rule("subsidy_range", "subsidy_amount", 0, 2000),
    Rule("price_paid_range", "actual_price_paid", 500, 700),
    Rule("usage_range", "usage_intensity", 0, 1),
    Rule("weekly_fuel_cost_range", "baseline_weekly_fuel_cost_ksh", 0, 2000),
)
PRODUCT_RULES = (
    Rule("thermal_efficiency_range", "thermal_efficiency_pct", 25, 100),
    Rule("pm25_emissions_range", "pm25_emissions_mg_m3", 0, 500),
    Rule("lifespan_range", "lifespan_years", 3, 7),
    Rule("tier_range", "tier_rating", 1, 5),
    Rule("unit_cost_range", "unit_cost_usd", 5, 50),
    Rule("carbon_reduction_range", "carbon_reduction_tons_year", 0.3, 2.5),
    Rule("product_type_values", "product_type",
         allowed=("charcoal_stove", "firewood_stove", "pellet_stove", "solar_lantern")),
)
GEOGRAPHY_RULES = (
    Rule("population_range", "population", 500000, 5000000),
    Rule("area_range", "area_sq_km", 200, 70000),
    Rule("poverty_rate_range", "poverty_rate", 15, 80),
    Rule("electrification_rate_range", "electrification_rate", 15, 80),
)
DATE_RULES = (
    Rule("year_range", "year", 2023, 2035),
    Rule("quarter_range", "quarter", 1, 4),
    Rule("month_range", "month", 1, 12),
    Rule("week_range", "week", 1, 53),
    Rule("day_of_month_range", "day_of_month", 1, 31),
    Rule("day_of_week_range", "day_of_week", 0, 6),
    Rule("fiscal_year_range", "fiscal_year", 2023, 2035),
    Rule("fiscal_quarter_range", "fiscal_quarter", 1, 4),
)
TRANSACTION_RULES = (
    Rule("amount_range", "amount_ksh", -10000, 10000),
    Rule("status_values", "status", allowed=("completed", "pending", "failed")),
)
LOAD_RULES = (   # what the loads carry beyond the facts
    Rule("cooking_hours_range", "baseline_cooking_hours_per_day", 1, 8),
    Rule("cooking_method_values", "baseline_cooking_method", allowed=("Three-stone fire", "Charcoal stove", "Kerosene", "LPG", "Electric")),
    Rule("fuel_type_values", "baseline_fuel_type", allowed=("Firewood", "Charcoal", "LPG")),
)
LEDGER_RULES = (
    Rule("type_values", "type", allowed=("purchase", "payment", "subsidy", "maintenance", "refund")),
    Rule("channel_values", "payment_method", allowed=("Cash", "M-Pesa", "Bank")),
    Rule("ledger_status_values", "status", allowed=("completed", "pending", "failed")),
)
IMPACT_RULES = (
    Rule("dalys_range", "dalys_avoided", 0, 0.1),
    Rule("mortality_range", "mortality_reduction", 0, 0.001),
    Rule("co2_range", "co2_avoided_tons", 0, 0.3),
    Rule("trees_range", "trees_saved_equivalent", 0, 5),
    Rule("fuel_savings_range", "fuel_cost_savings_ksh", 0, 2000),
    Rule("time_saved_range", "time_saved_hours", 0, 60),
    Rule("healthcare_savings_range", "healthcare_savings_ksh", 0, 1000),
    Rule("stacking_ratio_range", "stove_stacking_ratio", 0, 1),
)


def range_violations(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """Q1: every rule counted in ONE scan, then stacked to (rule, violations, checked).

    NULL values are neither checked nor violations.
    """
    aggs = []
    for r in rules:
        aggs += [F.count_if(F.coalesce(r.violation(), F.lit(False))).alias(f"v_{r.name}"),
                 F.count(F.col(r.column)).alias(f"n_{r.name}")]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"),
                        F.col(f"v_{r.name}").alias("violations"),
                        F.col(f"n_{r.name}").alias("checked")) for r in rules]
    return wide.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*structs)))


def quality_checks(households: DataFrame) -> DataFrame:
    """Q2: the four household checks in one pass (the reference scans four times)."""
    return households.agg(
        F.count_if(F.col("county").isNull()).alias("missing_counties"),
        F.count_if((F.col("head_age") < 18) | (F.col("head_age") > 100)).alias("invalid_ages"),
        F.count_if(F.col("monthly_income_ksh") < 0).alias("negative_income"),
        F.count_if((F.col("household_size") < 1) | (F.col("household_size") > 20))
        .alias("household_size_anomalies"))


def completeness_report(households: DataFrame, adoptions: DataFrame) -> DataFrame:
    """Totals and non-null counts per dataset."""
    h = households.agg(F.lit("Households").alias("dataset"),
                       F.count(F.lit(1)).alias("total_records"),
                       F.count("county").alias("complete_county"),
                       F.count("monthly_income_ksh").alias("complete_income"))
    a = adoptions.agg(F.lit("Adoptions").alias("dataset"),
                      F.count(F.lit(1)).alias("total_records"),
                      F.count("usage_intensity").alias("complete_county"),
                      F.count("subsidy_amount").alias("complete_income"))
    return h.unionByName(a)


def anomaly_report(adoptions: DataFrame, households: DataFrame) -> DataFrame:
    """High usage; low income with high usage."""
    high = adoptions.where(F.col("usage_intensity") > 0.95).agg(
        F.lit("High Usage Intensity").alias("anomaly_type"), F.count(F.lit(1)).alias("count"))
    # reduce the fact per household before the join (hot households combine map-side)
    f = (adoptions.where(F.col("usage_intensity") > 0.8)
         .groupBy("household_key").agg(F.count(F.lit(1)).alias("n")))
    h = households.where(F.col("monthly_income_ksh") < 10000).select("household_key")
    low = (f.join(h, "household_key")
           .agg(F.lit("Low Income High Adoption").alias("anomaly_type"),
                F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("count")))
    return high.unionByName(low)


def silver_flags(households: DataFrame, geography: DataFrame) -> DataFrame:
    """Q5: flag column plus corrective actions (negative income -> NULL)."""
    known = geography.select("county", F.lit(True).alias("_known")).distinct()
    h = households.join(known, "county", "left")
    inc = F.col("monthly_income_ksh")
    return h.select(
        "household_key",
        F.array_join(quality_flags(F.col("_known").isNotNull()), ",").alias("flags"),
        F.when(inc >= 0, inc).alias("monthly_income_clean"))


def duplicate_keys(checks: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Q6: per (table, key) the number of duplicated keys and excess rows.

    Each check is a grouped count with map-side combine; a hot key costs one
    partial row per map task.
    """
    out = None
    for table, key, df in checks:
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        one = counts.agg(F.lit(table).alias("table_name"), F.lit(key).alias("key_name"),
                         F.count(F.lit(1)).alias("duplicated_keys"),
                         F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")
                         .alias("excess_rows"))
        out = one if out is None else out.unionByName(one)
    return out


def repeated_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q6 on a composite grain: the key values that several rows share, and how many do.

    Rows are first counted by a 64-bit hash of the key, so the shuffle that sees the whole
    table carries eight bytes a row and combines map-side; only rows whose hash occurs twice
    are counted exactly. NULL is a value like any other here.
    """
    code = F.xxhash64(*[F.col(k) for k in keys])
    twice = (df.select(code.alias("_code")).groupBy("_code").agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > 1).select("_code"))
    return (df.select(*keys, code.alias("_code")).join(twice, "_code", "left_semi")
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1))


def orphan_keys(checks: Sequence[tuple[str, str, DataFrame, DataFrame, str]]) -> DataFrame:
    """Q7: rows whose foreign key has no parent (left anti join), per check.

    A NULL reference satisfies a foreign key and is no orphan. A child with several foreign
    keys is reduced once to the combinations that occur; each check counts on from there, so
    the child is read once and the anti joins see one row per key.
    """
    combined: dict[str, DataFrame] = {}
    for fact, _, child, _, _ in checks:
        if fact not in combined:
            fks = list(dict.fromkeys(k for f, k, _, _, _ in checks if f == fact))
            combined[fact] = child.groupBy(*fks).agg(F.count(F.lit(1)).alias("n"))
    out = None
    for fact, fk, _, parent, pk in checks:
        keys = combined[fact].where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k")).agg(F.sum("n").alias("n"))
        orphans = keys.join(parent.select(F.col(pk).alias("_k")), "_k", "left_anti")
        one = orphans.agg(F.lit(fact).alias("fact_table"), F.lit(fk).alias("foreign_key"),
                          F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_rows"))
        out = one if out is None else out.unionByName(one)
    return out


def join_loss(name: str, left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Q8: one pass over a left join: rows in, matched, dropped by an inner join."""
    r = right.select(F.col(on), F.lit(True).alias("_hit")).dropDuplicates([on])
    keys = left.groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    j = keys.join(r, on, "left")
    hit = F.col("_hit").isNotNull()
    return j.agg(F.lit(name).alias("join_name"),
                 F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_in"),
                 F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).cast("bigint").alias("rows_matched"),
                 F.coalesce(F.sum(F.when(~hit, F.col("n"))), F.lit(0)).cast("bigint").alias("rows_dropped"))


def gold_checks(executive: DataFrame, county: DataFrame) -> DataFrame:
    """Q9: totals equal detail, penetration <= 100, ROI > 0."""
    exec_hh = executive.select("total_households_reached").scalar()
    c = county.agg(F.sum("households_reached").alias("county_households"),
                   F.count_if(F.col("penetration_rate") > 100).alias("counties_over_100pct"),
                   F.count_if(~(F.coalesce(F.col("roi_ratio"), F.lit(0.0)) > 0))
                   .alias("counties_nonpositive_roi"))
    return (c.withColumn("executive_households", exec_hh)
            .withColumn("totals_match", F.col("executive_households") == F.col("county_households")))


def run_thresholds(bronze: DataFrame, silver: DataFrame,
                   required: Sequence[str] = ("county", "head_age", "monthly_income_ksh")) -> DataFrame:
    """Q10: one-row metrics -> status per documented threshold.

    The silver row count is attached as a scalar subquery (no join).
    """
    m = bronze.agg(F.count(F.lit(1)).alias("bronze_rows"),
                   F.count_if(~F.coalesce(household_is_valid(), F.lit(False))).alias("failed_rows"),
                   sum((F.count_if(F.col(c).isNull()) for c in required), F.lit(0)).alias("nulls"))
    m = m.withColumn("silver_rows", silver.agg(F.count(F.lit(1))).scalar())
    n = F.col("bronze_rows").cast("double")
    metrics = [
        ("records_processed_pct", F.col("silver_rows") / n * 100, 90.0, "lt", "Error"),
        ("validation_failure_pct", F.col("failed_rows") / n * 100, 5.0, "gt", "Warning"),
        ("required_null_pct", F.col("nulls") / (n * len(required)) * 100, 2.0, "gt", "Warning"),
    ]
    structs = []
    for name, val, thr, op, level in metrics:
        breach = val < thr if op == "lt" else val > thr
        structs.append(F.struct(F.lit(name).alias("metric"), val.alias("value"),
                                F.lit(thr).alias("threshold"),
                                F.when(breach, level).otherwise("OK").alias("status")))
    return m.select(F.inline(F.array(*structs)))


def quality_metrics(sources: Sequence[tuple[str, DataFrame, Sequence[str], Column, Column]]) -> DataFrame:
    """Q11: completeness %, pass rate %, anomalies and record count per source.

    Each source is (name, frame, required columns, passes-all-rules predicate,
    anomaly predicate), measured in one aggregate.
    """
    out = None
    for name, df, required, passes, anomaly in sources:
        n = F.count(F.lit(1))
        filled = sum((F.count(F.col(c)) for c in required), F.lit(0))
        one = df.agg(
            F.lit(name).alias("data_source"),
            (filled / (n * len(required)) * 100).alias("completeness_pct"),
            (F.count_if(F.coalesce(passes, F.lit(False))) / n * 100).alias("validation_pass_rate"),
            F.count_if(F.coalesce(anomaly, F.lit(False))).alias("anomalies_detected"),
            n.alias("records_count"))
        out = one if out is None else out.unionByName(one)
    return out
