"""Edge fixtures for column functions, dates and the date dimension."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from hearth.functions import columns as C
from hearth.functions.dates import calendar_columns, chained_add_months, chained_month_schedule
from hearth.operators import dims
from hearth.operators.silver import silver_households


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_income_bracket_edges(spark):
    vals = [(Decimal("-1"),), (Decimal("0"),), (Decimal("9999.99"),), (Decimal("10000"),),
            (Decimal("29999.99"),), (Decimal("30000"),), (None,)]
    got = _one(spark, C.income_bracket("x"), vals, "x decimal(12,2)")
    assert got == ["Low", "Low", "Low", "Medium", "Medium", "High", "High"]  # NULL -> ELSE


def test_age_and_family_edges(spark):
    ages = [(a,) for a in (17, 18, 29, 30, 59, 60, 100, 101, None)]
    assert _one(spark, C.age_group("x"), ages, "x int") == [
        "Youth", "Youth", "Youth", "Adult", "Adult", "Senior", "Senior", "Senior", "Senior"]
    kids = [(k,) for k in (0, 3, 4, None)]
    assert _one(spark, C.family_type("x"), kids, "x int") == [
        "No Children", "Family with Children", "Large Family", "No Children"]


def test_right_closed_cut(spark):
    vals = [(v,) for v in (0.0, 10000.0, 10000.01, 30000.0, 30001.0, -5.0, None)]
    got = _one(spark, C.cut("x", [0, 10000, 30000, float("inf")], ["Low", "Medium", "High"]),
               vals, "x double")
    assert got == [None, "Low", "Medium", "Medium", "High", None, None]


def test_adoption_category_edges(spark):
    vals = [(Decimal(v),) for v in ("0", "0.49", "0.50", "0.79", "0.80", "1.00")]
    assert _one(spark, C.adoption_category("x"), vals, "x decimal(3,2)") == [
        "Minimal Use", "Minimal Use", "Partial Adoption", "Partial Adoption", "Full Adoption",
        "Full Adoption"]


def test_clip_keeps_null(spark):
    vals = [(v,) for v in (-0.2, 0.5, 1.2, None)]
    assert _one(spark, C.clip("x", 0.0, 1.0), vals, "x double") == [0.0, 0.5, 1.0, None]


def test_coerce_defaults(spark):
    vals = [("42",), ("unknown",), ("",), (None,), ("7.9",)]
    assert _one(spark, C.coerce("x", 0, "int"), vals, "x string") == [42, 0, 0, 0, 7]


def test_treatment_filter_drops_null(spark):
    df = spark.createDataFrame([("charcoal_stove",), ("none",), (None,), ("None",)], "product_type string")
    assert [r[0] for r in df.where(C.is_adopted()).collect()] == ["charcoal_stove", "None"]


def test_vulnerability_tags(spark):
    rows = [(65, "Widowed", 2, Decimal("5000"), True), (40, "Married", 0, Decimal("50000"), False),
            (30, "Divorced", 0, Decimal("9999"), False)]
    df = spark.createDataFrame(rows, "head_age int, marital_status string, children_under_18 int, "
                                     "monthly_income_ksh decimal(12,2), has_disability boolean")
    got = [r[0] for r in df.select(C.vulnerability_factors()).collect()]
    assert got == ["Elderly,Single Parent,Low Income,Disability", None, "Low Income"]


def test_silver_filter_null_semantics(spark):
    rows = [(1, 5, 40, Decimal("100")), (2, 5, None, Decimal("100")), (3, 21, 40, Decimal("1")),
            (4, 1, 18, Decimal("0")), (5, 20, 100, Decimal("-1"))]
    df = spark.createDataFrame(rows, "household_key int, household_size int, head_age int, "
                                     "monthly_income_ksh decimal(12,2)").withColumn("children_under_18", F.lit(0))
    keys = sorted(r.household_key for r in silver_households(df).collect())
    assert keys == [1, 4]                      # T5: NULL age fails the filter
    invalid_ages = df.where((F.col("head_age") < 18) | (F.col("head_age") > 100)).count()
    assert invalid_ages == 0                   # ...but is not counted as invalid


def test_chained_months(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),)], "d date")
    r = df.select(chained_add_months("d", F.lit(1)).alias("a"),
                  chained_add_months("d", F.lit(2)).alias("b"),
                  chained_add_months("d", F.lit(3)).alias("c"),
                  F.add_months("d", 3).alias("plain"),
                  chained_month_schedule("d", F.lit(3)).alias("s")).first()
    assert (r.a, r.b, r.c) == (dt.date(2024, 2, 29), dt.date(2024, 3, 29), dt.date(2024, 4, 29))
    assert r.plain == dt.date(2024, 4, 30)
    assert r.s == [r.a, r.b, r.c]


def test_calendar_edges(spark):
    days = [dt.date(2024, 12, 30), dt.date(2024, 3, 15), dt.date(2024, 7, 1), dt.date(2024, 6, 30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()]).collect()
    dec30, mar, jul, jun = rows
    assert dec30.week == 1 and dec30.day_of_week == 0 and dec30.day_name == "Monday"
    assert mar.fiscal_quarter == 3 and mar.fiscal_year == 2023
    assert jul.fiscal_quarter == 1 and jul.fiscal_year == 2024
    assert jun.fiscal_quarter == 4 and jun.is_weekend and jun.date_key == 20240630


def test_dim_date_default_range(spark):
    b = spark.createDataFrame([(dt.date(2023, 1, 1), dt.date(2026, 12, 31))],
                              "start_date date, end_date date")
    d = dims.dim_date_between(b)
    assert d.count() == 1461
    assert d.agg(F.count_distinct("date_key")).first()[0] == 1461
