"""Calendar features as scalar expressions: no shuffle, fully code-generated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parts(date: Column) -> dict[str, Column]:
    """Monday is day 0; the week is the ISO week while the year is the calendar year."""
    return {
        "day_of_week": F.weekday(date),
        "day_of_month": F.dayofmonth(date),
        "week_of_year": F.weekofyear(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year": F.year(date),
    }


def cycles(date: Column) -> dict[str, Column]:
    day = 2 * F.pi() * F.weekday(date) / 7
    month = 2 * F.pi() * F.month(date) / 12
    return {
        "day_sin": F.sin(day),
        "day_cos": F.cos(day),
        "month_sin": F.sin(month),
        "month_cos": F.cos(month),
    }


def flags(date: Column) -> dict[str, Column]:
    """0/1 flags; the time of day is ignored. A missing date gives 0, as a comparison with it fails."""
    first = F.dayofmonth(date) == 1
    last = F.to_date(date) == F.last_day(date)
    month = F.month(date)
    rules = {
        "is_weekend": F.weekday(date) >= 5,
        "is_month_start": first,
        "is_month_end": last,
        "is_quarter_start": first & (month % 3 == 1),
        "is_quarter_end": last & (month % 3 == 0),
    }
    return {name: F.coalesce(rule, F.lit(False)).cast("int") for name, rule in rules.items()}
