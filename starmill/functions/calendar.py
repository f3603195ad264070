"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FISCAL_YEAR_FIRST_MONTH = 7


def date_key(day: Column) -> Column:
    """yyyyMMdd as an int, by arithmetic rather than by formatting a string."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_key(day_key: Column) -> Column:
    """yyyyMM from a yyyyMMdd key."""
    return F.floor(day_key / 100).cast("int")


def fiscal_year(day: Column, first_month: int = FISCAL_YEAR_FIRST_MONTH) -> Column:
    return F.year(day) + (F.month(day) >= first_month).cast("int")


def calendar_columns(day: Column) -> dict[str, Column]:
    weekday = F.dayofweek(day)
    return {
        "date_key": date_key(day),
        "date_value": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "week_of_year": F.weekofyear(day),
        "is_weekend": weekday.isin(1, 7),
        "fiscal_year": fiscal_year(day),
    }
