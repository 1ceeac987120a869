"""Scalar helpers shared by sources and operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_ms_to_ts(x: Column) -> Column:
    return F.timestamp_millis(x.cast("long"))


def shift_hours(ts: Column, hours: int = 1) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def round_price(x: Column, places: int = 2) -> Column:
    """Round half to even, deciding on the scaled value: 2.675 gives 2.68 and 1.005 gives 1.0."""
    scale = float(10**places)
    return F.rint(x * scale) / scale


def round_half_up(x: Column, places: int) -> Column:
    """``F.round`` of a double, which goes through text and decimals only where its scaled value is large or nearly a tie.

    Elsewhere the scaled value is off by less than the margin, so the nearest whole number is certain, and its quotient by a
    power of ten is the double next to that decimal.
    """
    scale = float(10**places)
    scaled = x * scale
    whole = F.floor(scaled + 0.5)
    certain = (F.abs(scaled) < 2.0**40) & (F.abs(scaled - whole) < 0.499)
    return F.when(certain, whole.cast("double") / scale).otherwise(F.round(x, places))


def cast_datetime(x: Column) -> Column:
    return x.cast("timestamp")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL everywhere in the library; NaN is accepted only at the door."""
    fractional = (T.DoubleType, T.FloatType)
    columns = [
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if isinstance(f.dataType, fractional) else F.col(f.name)
        for f in df.schema
    ]
    return df.select(columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
