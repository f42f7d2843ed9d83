"""Profiles and small aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_adopted


def first_product_per_type(products: DataFrame) -> DataFrame:
    """Deterministic 'first' product of each type = smallest key."""
    return products.groupBy("product_type").agg(F.min("product_key").alias("product_key"))


def value_counts(columns: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Distribution of each listed column, NULLs dropped."""
    out = None
    for label, df, col in columns:
        one = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
               .agg(F.count(F.lit(1)).alias("count"))
               .select(F.lit(label).alias("dimension"), "value", "count"))
        out = one if out is None else out.unionByName(one)
    return out


def profile_summary(households: DataFrame) -> DataFrame:
    """Headline statistics of a household extract in one aggregate."""
    n = F.count(F.lit(1))
    return households.agg(
        n.alias("total_households"),
        (F.count_if(F.col("control_group")) / n * 100).alias("control_group_pct"),
        (F.count_if(is_adopted()) / n * 100).alias("adoption_rate"),
        (F.sum("household_size") / F.count("household_size")).alias("avg_household_size"),
        (F.sum("monthly_income_ksh").cast("double") / F.count("monthly_income_ksh"))
        .alias("avg_monthly_income"),
        (F.count_if(F.col("urban_rural") == "Urban") / n * 100).alias("urban_pct"))


def product_type_means(products: DataFrame) -> DataFrame:
    """Means per type rounded half-even to one decimal."""
    def mean(c):
        return F.bround(F.sum(c).cast("double") / F.count(c), 1)
    return products.groupBy("product_type").agg(
        mean("thermal_efficiency_pct").alias("thermal_efficiency_pct"),
        mean("pm25_emissions_mg_m3").alias("pm25_emissions_mg_m3"),
        mean("carbon_reduction_tons_year").alias("carbon_reduction_tons_year"))


def row_counts(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One count per table, unioned."""
    out = None
    for name, df in tables:
        one = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        out = one if out is None else out.unionByName(one)
    return out


def top_adoption_counties(adoptions: DataFrame, geography: DataFrame, k: int = 5) -> DataFrame:
    """L1: top-k counties by adoptions; ties by county name (TakeOrderedAndProject)."""
    g = geography.select("geography_key", "county")
    return (adoptions.select("geography_key").join(g, "geography_key")
            .groupBy("county").agg(F.count(F.lit(1)).alias("adoptions"))
            .orderBy(F.desc("adoptions"), F.asc("county")).limit(k))
