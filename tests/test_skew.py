"""Skew stress: one household holds a third of all adoptions.

The as-written fan-out join would emit 100,000^2 = 1e10 rows for that
household; the pre-aggregated plan finishes in seconds and returns the exact
closed-form totals.
"""

from decimal import Decimal

from pyspark.sql import functions as F

from hearth.operators import gold, silver
from hearth.plans import registry

HOT_ROWS = 100_000
OTHERS = 200_000


def test_hot_household_gold(spark):
    geo = spark.createDataFrame([(1, "A", 1000000, Decimal("20.00"), Decimal("70.00"))],
                                "geography_key long, county string, population int, "
                                "poverty_rate decimal(5,2), electrification_rate decimal(5,2)")
    prod = spark.createDataFrame([(10, "charcoal_stove", Decimal("100.00"), Decimal("1.00"))],
                                 "product_key long, product_type string, "
                                 "pm25_emissions_mg_m3 decimal(8,2), carbon_reduction_tons_year decimal(5,2)")
    n = HOT_ROWS + OTHERS
    ids = F.col("id")
    fact = spark.range(n).select(
        ids.alias("adoption_key"),
        F.when(ids < HOT_ROWS, F.lit(0)).otherwise(ids - HOT_ROWS + 1).alias("household_key"),
        F.lit(10).cast("long").alias("product_key"), F.lit(1).cast("long").alias("geography_key"),
        F.lit(Decimal("0.50")).cast("decimal(3,2)").alias("usage_intensity"),
        F.lit(Decimal("1.00")).cast("decimal(10,2)").alias("subsidy_amount"),
        F.lit(Decimal("10.00")).cast("decimal(10,2)").alias("baseline_weekly_fuel_cost_ksh"))
    impact = silver.silver_impact_calculations(fact, prod, geo)
    r = gold.gold_executive_summary(fact, impact).first()
    assert r.total_households_reached == OTHERS + 1
    # pairs: hot household HOT_ROWS x HOT_ROWS, each other household 1 x 1; co2 per row 0.5
    pairs = HOT_ROWS * HOT_ROWS + OTHERS
    assert r.total_co2_avoided_tons == Decimal("0.5") * pairs
    assert r.total_subsidies == Decimal(pairs)
    assert r.avg_usage_intensity == 0.5
    c = gold.gold_county_performance(fact, geo, prod, impact).first()
    assert c.households_reached == OTHERS + 1 and c.charcoal_stoves == OTHERS + 1
    assert c.co2_avoided == Decimal("0.5") * pairs


def test_pair_counts_beyond_int_ranges(spark):
    """2,000,000 adoptions on one household: 4e12 implied pairs, totals still exact."""
    hot = 2_000_000
    geo = spark.createDataFrame([(1, "A")], "geography_key long, county string")
    prod = spark.createDataFrame([(10, "charcoal_stove", Decimal("100.00"), Decimal("1.00"))],
                                 "product_key long, product_type string, "
                                 "pm25_emissions_mg_m3 decimal(8,2), carbon_reduction_tons_year decimal(5,2)")
    ids = F.col("id")
    # Keys come from the row id, not literals: with literal keys Catalyst folds
    # the dimension joins into a Cartesian product, which no real fact produces.
    fact = spark.range(hot + 1).select(
        ids.alias("adoption_key"),
        F.when(ids < hot, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("household_key"),
        (ids % 1 + 10).alias("product_key"), (ids % 1 + 1).alias("geography_key"),
        F.lit(Decimal("0.50")).cast("decimal(3,2)").alias("usage_intensity"),
        F.lit(Decimal("1.00")).cast("decimal(10,2)").alias("subsidy_amount"),
        F.lit(Decimal("10.00")).cast("decimal(10,2)").alias("baseline_weekly_fuel_cost_ksh"))
    impact = silver.silver_impact_calculations(fact, prod, geo)
    r = gold.gold_executive_summary(fact, impact).first()
    pairs = hot * hot + 1
    assert r.total_co2_avoided_tons == 0.5 * pairs
    assert r.total_dalys_avoided == float(Decimal("100.00") * Decimal("0.0245") * Decimal("0.5") * pairs)
    assert r.total_subsidies == float(pairs)


def test_impact_monthly_hot_household_matches_direct_expansion(spark):
    """A17 staged plan == expand every adoption to 12 months, then aggregate."""
    import datetime as dt

    from hearth.operators import facts

    geo = spark.createDataFrame([(1, "A")], "geography_key long, county string")
    prod = spark.createDataFrame(
        [(10, Decimal("100.00"), Decimal("1.00")), (11, Decimal("40.00"), Decimal("0.25"))],
        "product_key long, pm25_emissions_mg_m3 decimal(8,2), carbon_reduction_tons_year decimal(5,2)")
    ids = F.col("id")
    hot = 30_000
    # household 0 holds `hot` rows over two products and three start months;
    # households 1..99 one row each; geography 2 has no county and drops out
    fact = spark.range(hot + 100).select(
        F.when(ids < hot, F.lit(0)).otherwise(ids - hot + 1).alias("household_key"),
        (F.lit(10) + ids % 2).alias("product_key"),
        F.when(ids % 97 == 0, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("geography_key"),
        F.date_add(F.lit(dt.date(2024, 1, 31)), (ids % 3 * 29).cast("int")).alias("adoption_date"),
        ((ids % 101).cast("decimal(5,2)") * Decimal("0.01")).cast("decimal(3,2)").alias("usage_intensity"),
        (ids % 1500).cast("decimal(10,2)").alias("baseline_weekly_fuel_cost_ksh"))
    got = facts.impact_monthly(fact, prod, geo)

    u = F.col("usage_intensity")
    rows = (fact.where("geography_key = 1")
            .select("household_key", "product_key", u,
                    (F.col("baseline_weekly_fuel_cost_ksh") * u).alias("fu"),
                    F.explode(F.sequence(F.lit(0), F.lit(11))).alias("m"),
                    F.trunc("adoption_date", "month").alias("s")))
    mth = F.add_months("s", F.col("m"))
    direct = (rows.groupBy("household_key", "product_key",
                           (F.year(mth) * 100 + F.month(mth)).cast("int").alias("month_key"))
              .agg(F.sum(u).alias("su"), F.sum("fu").alias("sfu"),
                   F.count(F.lit(1)).alias("active_adoptions"),
                   F.max(u).cast("double").alias("stove_stacking_ratio"))
              .join(prod, "product_key")
              .select("household_key", "product_key", "month_key",
                      (F.col("carbon_reduction_tons_year") * F.col("su")).cast("double").alias("co2"),
                      (F.col("sfu") * 52).cast("double").alias("fuel"),
                      "active_adoptions", "stove_stacking_ratio"))
    g = got.select("household_key", "product_key", "month_key",
                   (F.col("co2_avoided_tons") * 12).alias("co2"),
                   (F.col("fuel_cost_savings_ksh") * 12).alias("fuel"),
                   "active_adoptions", "stove_stacking_ratio")
    a = {(r[0], r[1], r[2]): r for r in g.collect()}
    b = {(r[0], r[1], r[2]): r for r in direct.collect()}
    assert a.keys() == b.keys()
    for k, r in b.items():
        x = a[k]
        assert x.active_adoptions == r.active_adoptions
        assert x.stove_stacking_ratio == r.stove_stacking_ratio
        assert abs(x.co2 - r.co2) <= 1e-9 * max(1.0, abs(r.co2))
        assert abs(x.fuel - r.fuel) <= 1e-9 * max(1.0, abs(r.fuel))
    hot_rows = [r for k, r in b.items() if k[0] == 0]
    assert sum(r.active_adoptions for r in hot_rows) == 12 * fact.where(
        "household_key = 0 AND geography_key = 1").count()


def test_impact_monthly_of_odd_rows_matches_direct_expansion(spark):
    """Undated adoptions, gaps, overlapping years, null keys, households and products listed twice."""
    import datetime as dt

    from hearth.operators import facts

    day = dt.date.fromisoformat
    starts = ["2023-01-31", "2023-01-02", "2023-12-05", "2024-01-01", "2026-02-28", "0001-12-31", "9999-12-31", None, None]
    fact = spark.createDataFrame(
        [(h, p, s and day(s), u, w) for h in (1, 2, 3, None) for p in (10, 11, None) for i, s in enumerate(starts)
         for u, w in ((Decimal(i) / 10, Decimal(100 + i)), (None, Decimal(7)), (Decimal("0.25"), None))],
        "household_key long, product_key long, adoption_date date, usage_intensity decimal(3,2), "
        "baseline_weekly_fuel_cost_ksh decimal(10,2)")
    members = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (3, 3), (None, 1)], "household_key long, geography_key long")
    geo = spark.createDataFrame([(1, "A"), (2, "B")], "geography_key long, county string")
    prod = spark.createDataFrame(
        [(10, Decimal("100.00"), Decimal("1.00")), (11, Decimal("40.00"), Decimal("0.25")), (11, None, Decimal("0.50"))],
        "product_key long, pm25_emissions_mg_m3 decimal(8,2), carbon_reduction_tons_year decimal(5,2)")

    known = members.join(geo, "geography_key", "left_semi")
    u = F.col("usage_intensity")
    mth = F.add_months(F.trunc("adoption_date", "month"), F.col("m"))
    direct = (fact.join(known, "household_key").withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(11))))
              .groupBy("household_key", "product_key", (F.year(mth) * 100 + F.month(mth)).alias("month_key"))
              .agg(F.min("geography_key").alias("geography_key"), F.sum(u).alias("su"),
                   F.sum(F.col("baseline_weekly_fuel_cost_ksh") * u).alias("sfu"),
                   F.count(F.lit(1)).alias("active"), F.max(u).cast("double").alias("mx"))
              .join(prod, "product_key")
              .select("household_key", "product_key", "geography_key", "month_key", "active", "mx",
                      (F.col("sfu") * 52).cast("double") / 12,
                      (F.col("carbon_reduction_tons_year") * F.col("su")).cast("double") / 12,
                      (F.col("pm25_emissions_mg_m3") * F.col("su")).cast("double") / 12))
    for a, m in ((fact, members), (fact.join(members, "household_key"), None)):
        got = facts.impact_monthly(a, prod, geo, members=m).select(
            "household_key", "product_key", "geography_key", "month_key", "active_adoptions", "stove_stacking_ratio",
            "fuel_cost_savings_ksh", "co2_avoided_tons", "pm25_reduced")
        rows = sorted(map(repr, map(tuple, got.collect())))
        assert rows == sorted(map(repr, map(tuple, direct.collect())))
        assert any("None, 72, " in r for r in rows)  # two undated days of three rows, twelve months each


def test_impact_monthly_holds_no_table_of_expanded_months(spark):
    """The months are written out last; no aggregate, sort, window or shuffle sees them."""
    from hearth.operators import facts
    from hearth.sources.tables import Tables
    s = Tables(spark, "/root/testdata/sf0.001").star
    for hint in ("broadcast", "merge"):
        df = facts.impact_monthly(s.order_adoptions, s.dim_product.hint(hint), s.dim_geography,
                                  members=s.programme_households)
        plan = df._jdf.queryExecution().executedPlan().toString()
        above, sep, below = plan.split("Initial Plan")[-1].partition("Generate explode(stretch")
        assert sep and "Window" in below
        assert not any(x in above for x in ("Aggregate", "Exchange", "Sort", "Window", "Join"))


def _keyed_by_month(spark, name):
    registry.load_all()
    plan = registry.build(name, spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode(stretch") == 1
    return [x for x in plan.splitlines() if "Aggregate(keys=[" in x and "month_key" in x.split("functions=")[0]]


def test_range_violations_keeps_no_table_of_expanded_months(spark):
    assert not _keyed_by_month(spark, "range_violations")


def test_catalogue_load_keeps_no_table_of_expanded_months(spark):
    assert not _keyed_by_month(spark, "catalogue_load")
