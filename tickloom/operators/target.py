"""Forward-looking targets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rolling import ratio, shift
from tickloom.plans.series import Lane, Series, over_series
from tickloom.plans.stages import Levels, add_levels
from tickloom.schema import TARGETS


def target_levels(lane: Lane, names: Iterable[str] = TARGETS) -> Levels:
    """The next close, the percent by which today's close lies above it (tomorrow is the base), and
    whether it is higher. The last row of a series has no next close; its direction is 0."""
    close, following = F.col("close"), F.col("_close_after")
    made = {
        "target_next_close": following,
        "target_pct_change": (ratio(close, following) - 1) * 100,
        "target_direction": F.coalesce(following > close, F.lit(False)).cast("int"),
        "forward_return": (ratio(following, close) - 1) * 100,
    }
    return [{"_close_after": shift(close, -1, lane)}, {name: made[name] for name in names}]


def _targets(df: DataFrame, series: Series, names: Iterable[str]) -> DataFrame:
    return over_series(df, series, lambda d, lane: add_levels(d, target_levels(lane, names)), ahead=1)


def target_next_close(df: DataFrame, series: Series = Series()) -> DataFrame:
    return _targets(df, series, ["target_next_close"])


def target_pct_change(df: DataFrame, series: Series = Series()) -> DataFrame:
    return _targets(df, series, ["target_pct_change"])


def target_direction(df: DataFrame, series: Series = Series()) -> DataFrame:
    return _targets(df, series, ["target_direction"])


def targets(df: DataFrame, series: Series = Series()) -> DataFrame:
    return _targets(df, series, TARGETS)


def forward_return(df: DataFrame, series: Series = Series()) -> DataFrame:
    """The correctly signed alternative to target_pct_change: next close over this close, in percent."""
    return _targets(df, series, ["forward_return"])


def target_stats(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """Means and up/down counts and shares over all rows, the last row of a series counting as down."""
    up, rows = F.sum("target_direction"), F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        F.avg("target_next_close").alias("mean_next_close"),
        F.avg("target_pct_change").alias("mean_pct_change"),
        up.cast("long").alias("days_up"),
        (rows - up).cast("long").alias("days_down"),
        F.try_divide(up * 100.0, rows).alias("share_up"),
        F.try_divide((rows - up) * 100.0, rows).alias("share_down"),
    )
