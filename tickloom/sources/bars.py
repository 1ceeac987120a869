"""Bars from ticks: the first, highest, lowest and last price of each period, and the number of ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bars_from_ticks(ticks: DataFrame, series_key: Column, period: Column, price: Column, sequence: Column) -> DataFrame:
    """Aggregate ticks to bars. ``sequence`` orders the ticks of a period and is unique in it.

    Every aggregate combines map-side, so a series holding most ticks is reduced before the shuffle.
    """
    return ticks.groupBy(series_key.alias("series_key"), period.alias("date")).agg(
        F.min_by(price, sequence).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, sequence).alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )
