"""Calendar feature operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import calendar


def cal_parts(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(calendar.parts(F.col(date)))


def cal_cyclic(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(calendar.cycles(F.col(date)))


def cal_flags(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(calendar.flags(F.col(date)))


def calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    when = F.col(date)
    return df.withColumns(calendar.parts(when) | calendar.cycles(when) | calendar.flags(when))
