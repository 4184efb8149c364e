"""Calendar and fiscal attributes of a day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FISCAL_START_MONTH = 4  # the fiscal year runs April to March and is named by its first year


def day_of_week(day: Column) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(day) - 1


def is_weekend(day: Column) -> Column:
    return day_of_week(day).isin(0, 6)


def fiscal_year(day: Column) -> Column:
    return F.year(F.add_months(day, 1 - FISCAL_START_MONTH))


def fiscal_quarter(day: Column) -> Column:
    return F.quarter(F.add_months(day, 1 - FISCAL_START_MONTH))


def iso_year(day: Column) -> Column:
    """Year of the ISO week: the year of that week's Thursday."""
    return F.year(F.date_add(day, 3 - F.weekday(day)))


def calendar(day: str) -> dict[str, Column]:
    """Every calendar column of the date dimension, by name."""
    d = F.col(day)
    year, quarter = F.date_format(d, "yyyy"), F.concat(F.lit("Q"), F.quarter(d).cast("string"))
    return {
        "year_number": F.year(d),
        "quarter_number": F.quarter(d),
        "month_number": F.month(d),
        "week_number": F.weekofyear(d),
        "day_of_year": F.dayofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": day_of_week(d),
        "year_name": year,
        "quarter_name": quarter,
        "month_name": F.date_format(d, "MMMM"),
        "month_short_name": F.date_format(d, "MMM"),
        "day_name": F.date_format(d, "E"),
        "year_month": F.date_format(d, "yyyy-MM"),
        "year_quarter": F.concat(year, F.lit("-"), quarter),
        "fiscal_year": fiscal_year(d),
        "fiscal_quarter": fiscal_quarter(d),
        "is_weekend": is_weekend(d),
        "is_holiday": F.lit(False),
    }
