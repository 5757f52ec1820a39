"""Calendar expressions over a date column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from demandkit.functions.scalars import flag, member_flag

UNPADDED = "yyyy-M-d"

# The months the season flags stand for.
SUMMER_MONTHS = (7, 8)
WINTER_MONTHS = (12, 1, 2)

FRIDAY = 4


def parse_date(col: Column) -> Column:
    """Date from ``2014-10-1`` or ``2014-10-01``."""
    return F.to_date(col, UNPADDED)


def unpadded_date(col: Column) -> Column:
    return F.date_format(col, UNPADDED)


def weekday(col: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(col)


def iso_weekday(col: Column) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(col) + 1


def iso_week(col: Column) -> Column:
    return F.weekofyear(col)


def date_parts(col: Column) -> dict[str, Column]:
    return {"year": F.year(col), "month": F.month(col), "day": F.dayofmonth(col)}


def month_third_flags(col: Column) -> dict[str, Column]:
    """Days 1-10, 11-20 and 21-31."""
    day = F.dayofmonth(col)
    return {
        "is_beginning_of_month": flag(day <= 10),
        "is_middle_of_month": flag((day > 10) & (day <= 20)),
        "is_end_of_month": flag(day > 20),
    }


def weekday_flag(col: Column, day: int = FRIDAY) -> Column:
    return flag(F.weekday(col) == day)


def season_flags(col: Column) -> dict[str, Column]:
    month = F.month(col)
    return {
        "is_summer": member_flag(month, SUMMER_MONTHS),
        "is_winter": member_flag(month, WINTER_MONTHS),
    }


def add_days(col: Column, days: int) -> Column:
    return F.date_add(col, days)
