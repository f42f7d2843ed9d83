"""Column expressions for bucketing, validation, cleaning and flags.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- F4: left-closed CASE bucketing (NULL falls to the ELSE branch); fixed values: bounds and labels ---

def income_bracket(income: str | Column = "monthly_income_ksh") -> Column:
    c = _c(income)
    return (F.when(c < 10000, "Low").when(c < 30000, "Medium").otherwise("High"))


def family_type(children: str | Column = "children_under_18") -> Column:
    c = _c(children)
    return (F.when(c > 3, "Large Family").when(c > 0, "Family with Children")
            .otherwise("No Children"))


def age_group(age: str | Column = "head_age") -> Column:
    c = _c(age)
    return F.when(c < 30, "Youth").when(c < 60, "Adult").otherwise("Senior")


# --- F5: right-closed interval binning, outside every bin -> NULL -----------

def cut(col: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``(edges[i], edges[i+1]] -> labels[i]``; no ``otherwise`` so misses are NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("cut needs len(edges) == len(labels) + 1")
    c = _c(col)
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = c > F.lit(lo)
        if hi != float("inf"):
            cond = cond & (c <= F.lit(hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


# --- F6: adoption category from usage intensity; fixed values: bounds and labels ---

def adoption_category(usage: str | Column = "usage_intensity") -> Column:
    c = _c(usage)
    return (F.when(c >= 0.8, "Full Adoption").when(c >= 0.5, "Partial Adoption")
            .otherwise("Minimal Use"))


# --- F7: range validity used by the silver household filter -----------------

def household_is_valid() -> Column:
    return (F.col("household_size").between(1, 20)
            & F.col("head_age").between(18, 100)
            & (F.col("monthly_income_ksh") >= 0))


# --- F8: treatment filter; NULL product type is not "adopted" (T2) ----------

def is_adopted(product_type: str | Column = "product_type") -> Column:
    c = _c(product_type)
    return c.isNotNull() & (c != "none")


# --- F13: numeric coercion with a default ------------------------------------

def coerce(col: str | Column, default, to: str = "double") -> Column:
    """``to_numeric(errors='coerce').fillna(default)``: junk and NULL -> default."""
    return F.coalesce(_c(col).try_cast("double"), F.lit(default)).cast(to)


def coerce_bool(col: str | Column) -> Column:
    v = F.lower(F.trim(_c(col)))
    return F.coalesce(v.isin("true", "1", "yes", "t"), F.lit(False))


# --- F14: clip that keeps NULL (T13) -----------------------------------------

def clip(col: str | Column, lo, hi) -> Column:
    c = _c(col)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


# --- F11: packed vulnerability tags; fixed values: tags and their bounds -----

def vulnerability_factors(age: str = "head_age", marital: str = "marital_status",
                          children: str = "children_under_18",
                          income: str = "monthly_income_ksh",
                          disability: str = "has_disability") -> Column:
    """Comma-joined tags; no tag gives NULL (the text 'None' loads as NULL, T1)."""
    tags = F.concat_ws(
        ",",
        F.when(F.col(age) > 60, F.lit("Elderly")),
        F.when(F.col(marital).isin("Widowed", "Divorced") & (F.col(children) > 0),
               F.lit("Single Parent")),
        F.when(F.col(income) < 10000, F.lit("Low Income")),
        F.when(F.col(disability), F.lit("Disability")),
    )
    return F.nullif(tags, F.lit(""))


def has_tag(tags: str | Column, tag: str) -> Column:
    """``LIKE '%tag%'`` semantics: NULL tags give NULL (so SUM(CASE ...) counts 0)."""
    return _c(tags).contains(tag)


# --- F12: additive vulnerability score; fixed values: points -----------------

def vulnerability_score(gender: str = "head_gender", income: str = "monthly_income_ksh",
                        children: str = "children_under_18",
                        elderly: str = "elderly_over_60",
                        tags: str = "vulnerability_factors") -> Column:
    def pts(cond: Column, n: int) -> Column:
        return F.when(cond, F.lit(n)).otherwise(F.lit(0))

    return (pts(F.col(gender) == "Female", 1) + pts(F.col(income) < 10000, 2)
            + pts(F.col(children) > 3, 1) + pts(F.col(elderly) > 0, 1)
            + pts(F.coalesce(has_tag(tags, "Disability"), F.lit(False)), 2))


# --- Q5: corrective-action flags, one array column ---------------------------

# Documented valid GPS box for the programme area.
GPS_LAT_RANGE = (-4.5, 4.5)
GPS_LON_RANGE = (33.5, 42.0)


def quality_flags(known_county: Column) -> Column:
    """Array of flag names raised on a household row (empty when clean)."""
    lat, lon = F.col("gps_latitude"), F.col("gps_longitude")
    return F.array_compact(F.array(
        F.when(F.col("county").isNull() | ~known_county, F.lit("unknown_county")),
        F.when(~F.col("head_age").between(18, 100), F.lit("invalid_age")),
        F.when(~F.col("household_size").between(1, 20), F.lit("invalid_size")),
        F.when(~lat.between(*GPS_LAT_RANGE) | ~lon.between(*GPS_LON_RANGE),
               F.lit("gps_out_of_range")),
        F.when(F.col("monthly_income_ksh") < 0, F.lit("negative_income")),
    ))
