"""Date keys, calendar attributes and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def date_key(col: str | Column) -> Column:
    """INT ``yyyyMMdd`` key."""
    return F.date_format(_c(col), "yyyyMMdd").cast("int")


def parse_date(col: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Dirty text -> DATE or NULL (never raises under ANSI mode)."""
    return F.try_to_date(_c(col), fmt)


def calendar_columns(d: str | Column) -> dict[str, Column]:
    """Calendar attributes of a date (Monday = 0; fiscal year starts in July)."""
    d = _c(d)
    month = F.month(d)
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": month,
        "month_name": F.date_format(d, "MMMM"),
        "week": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.weekday(d) >= 5,
        # Fiscal year is named for its starting July
        "fiscal_year": F.year(d) - F.when(month < 7, 1).otherwise(0),
        # Python-style modulo, never negative
        "fiscal_quarter": (F.pmod(month - 7, F.lit(12)) / 3).cast("int") + 1,
    }


def chained_add_months(start: str | Column, n: str | Column) -> Column:
    """Add one month ``n`` times, keeping the clamped day each step.

    Jan 31 -> Feb 29 -> Mar 29, unlike ``add_months(start, n)``.
    """
    return F.aggregate(F.sequence(F.lit(1), _c(n)), _c(start),
                       lambda acc, _: F.add_months(acc, 1))


def chained_month_schedule(start: str | Column, n: str | Column) -> Column:
    """Array of the ``n`` successive chained month offsets of ``start``."""
    return F.transform(F.sequence(F.lit(1), _c(n)),
                       lambda i: chained_add_months(start, i))
