"""Dimensions derived in the plan (B2 date dimension)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns


def dim_date_between(bounds: DataFrame, start: str = "start_date",
                     end: str = "end_date") -> DataFrame:
    """One row per day of the inclusive range held in a one-row frame.

    The spine is generated by ``explode(sequence(...))`` from a single row, so
    its size is the number of days in the range, independent of the facts.
    """
    spine = bounds.select(F.explode(F.sequence(F.col(start), F.col(end),
                                               F.expr("INTERVAL 1 DAY"))).alias("d"))
    return spine.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()])


def date_bounds(*dated: tuple[DataFrame, Column]) -> DataFrame:
    """The smallest and largest date over several facts (one global aggregate each)."""
    out = None
    for df, col in dated:
        one = df.agg(F.min(col).alias("start_date"), F.max(col).alias("end_date"))
        out = one if out is None else out.unionByName(one)
    return out.agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))
