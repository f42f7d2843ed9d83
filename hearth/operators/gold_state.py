"""G4-G8 kept up to date from a delta of adoptions.

Every gold total is a sum over households of products of per-household counts and sums (see
``gold``), and those counts and sums add up over any split of the adoptions; flags add up as
maxima. So one row per (household, county) with its partial sums is a state that a delta is
merged into: ``state(old) + state(new) = state(old and new)``. Decimal sums are held at full
width, so merging is exact in any order.

The state is a ``RangeTable`` on the household: a delta replaces the ranges of its households
only, and the gold tables are taken from the state without reading an old adoption.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.impact import DEFAULT_IMPACT, ImpactCoefficients, impact_columns
from ..sources.ranges import RangeTable
from . import gold
from .gold import IMPACT_MEASURES, PRODUCT_MIX

KEYS = ("household_key", "geography_key")


def _wide(df: DataFrame) -> DataFrame:
    """Decimal sums at full width, so that sums of sums keep their type."""
    return df.select(*[F.col(f.name).cast(f"decimal(38,{f.dataType.scale})").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def adoption_state(adoptions: DataFrame, members: DataFrame | None, geography: DataFrame, products: DataFrame,
                   coef: ImpactCoefficients = DEFAULT_IMPACT, product_mix=PRODUCT_MIX) -> DataFrame:
    """Partial sums per (household, county) of some adoptions.

    ``n_f`` and ``sf_*`` are sums over all adoptions, ``p_*`` over those of a known product,
    ``n_i`` and ``si_*`` over the impact rows (known product and county). Where the adoptions
    carry no county, ``members`` (household_key, geography_key) does: they are reduced per
    household before they meet it.
    """
    p = products.select("product_key", F.lit(1).alias("_known"), "product_type", "carbon_reduction_tons_year",
                        "pm25_emissions_mg_m3")
    rows = adoptions.join(p, "product_key", "left")
    u, paid, known = F.col("usage_intensity"), F.col("subsidy_amount"), F.col("_known").isNotNull()
    pm = F.col("pm25_emissions_mg_m3")
    impact = impact_columns(F.col("carbon_reduction_tons_year"), pm, u, F.col("baseline_weekly_fuel_cost_ksh"), coef)
    per = rows.groupBy(*(KEYS if members is None else KEYS[:1])).agg(
        F.count(F.lit(1)).alias("n_f"), F.sum(u).alias("sf_usage"), F.count(u).alias("nf_usage"),
        F.sum(paid).alias("sf_subsidy"), F.count(paid).alias("nf_subsidy"),
        gold._flag(u >= 0.8).alias("full"), gold._flag(u < 0.5).alias("low"),
        F.count_if(known).alias("p_f"), F.sum(F.when(known, u)).alias("p_usage"), F.count_if(known & u.isNotNull()).alias("pn_usage"),
        F.sum(F.when(known, paid)).alias("p_subsidy"), F.count_if(known & paid.isNotNull()).alias("pn_subsidy"),
        F.sum(pm * u).alias("sf_pm25"),
        *[gold._flag(F.col("product_type") == t).alias(f"has_{name}") for t, name in product_mix],
        *[F.sum(F.when(known, impact[m])).alias(f"si_{m}") for m in IMPACT_MEASURES])
    in_county = geography.select("geography_key", F.lit(1).alias("_county"))
    per = _wide(per)
    out = per if members is None else per.join(members, "household_key")
    out = out.join(in_county, "geography_key", "left")
    counted = F.col("_county").isNotNull()
    return out.select(*KEYS, *[c for c in per.columns if c not in KEYS and not c.startswith("si_")],
                      F.when(counted, F.col("p_f")).otherwise(0).alias("n_i"),
                      *[F.when(counted, F.col(f"si_{m}")).alias(f"si_{m}") for m in IMPACT_MEASURES])


def merge_states(old: DataFrame, new: DataFrame) -> DataFrame:
    """One state of two: counts and sums are added, flags are maxima."""
    def one(f):
        flag = f.name in ("full", "low") or f.name.startswith("has_")
        return (F.max if flag else F.sum)(f.name).cast(f.dataType).alias(f.name)
    both = old.unionByName(new.select(*old.columns))
    return both.groupBy(*KEYS).agg(*[one(f) for f in old.schema.fields if f.name not in KEYS])


def create(state: DataFrame, root: str, ranges: int = 64) -> RangeTable:
    return RangeTable.create(state, root, "household_key", ranges)


def add(table: RangeTable, batch: str, delta: DataFrame) -> list[int]:
    """Merge the state of a delta into the stored one; a batch added before changes nothing."""
    return table.apply(batch, delta, merge_states)


class GoldTables:
    """G4-G8 from the state alone (and the dimensions); each table is planned when it is asked for."""

    def __init__(self, state: DataFrame, households: DataFrame, geography: DataFrame,
                 coef: ImpactCoefficients = DEFAULT_IMPACT, product_mix=PRODUCT_MIX):
        self.state, self.households, self.geography = state, households, geography
        self.coef, self.product_mix = coef, product_mix
        self.sums = [f"si_{m}" for m in IMPACT_MEASURES]

    @cached_property
    def reach(self) -> DataFrame:
        """A row per (household, county) with its adoptions there and the household's whole impact."""
        county = self.geography.select("geography_key", "county", "poverty_rate", "electrification_rate", "population")
        # a household's impact is met by its adoptions in every county; a household has a row per county
        home = Window.partitionBy("household_key")
        return (self.state.withColumns({c: F.sum(c).over(home) for c in ("n_i", *self.sums)}).where(F.col("n_i") > 0)
                .join(county, "geography_key"))

    @cached_property
    def by_product(self) -> DataFrame:
        """``reach`` counted over adoptions of a known product."""
        return (self.reach.drop("n_f", "sf_usage", "nf_usage", "sf_subsidy", "nf_subsidy").where(F.col("p_f") > 0)
                .withColumnsRenamed({"p_f": "n_f", "p_usage": "sf_usage", "pn_usage": "nf_usage",
                                     "p_subsidy": "sf_subsidy", "pn_subsidy": "nf_subsidy"}))

    @cached_property
    def homes(self) -> DataFrame:
        return self.reach.join(gold.household_facts(self.households), "household_key")

    def gold_executive_summary(self) -> DataFrame:
        whole = (self.state.groupBy("household_key").agg(
            *[F.sum(c).alias(c) for c in ("n_f", "sf_usage", "nf_usage", "sf_subsidy", "nf_subsidy", "n_i", *self.sums)],
            F.max("full").alias("full"), F.max("low").alias("low")).where(F.col("n_i") > 0))
        return gold.executive_totals(whole, self.coef)

    def gold_county_performance(self) -> DataFrame:
        return gold.county_totals(self.by_product, self.product_mix)

    def gold_donor_health_impact(self) -> DataFrame:
        return gold.health_totals(self.homes)

    def gold_donor_environment_impact(self) -> DataFrame:
        return gold.environment_totals(self.by_product, self.coef)

    def gold_donor_gender_impact(self) -> DataFrame:
        return gold.gender_totals(self.homes, self.coef)

    NAMES = ("gold_executive_summary", "gold_county_performance", "gold_donor_health_impact",
             "gold_donor_environment_impact", "gold_donor_gender_impact")

    def all(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n)() for n in self.NAMES}
