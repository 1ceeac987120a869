"""Scaling and walk-forward forecasting over the folds of operators.sequences.

Only positions matter, so all folds of all series come out of one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.regression import walk_forward_lr
from tickloom.operators.sequences import (
    FOLDS,
    PRICES_BY_TIME,
    SEQUENCE_ROWS,
    fold_spans,
    fold_start,
    lag_columns,
    make_sequences,
    sequence_blocks,
    sequence_windows,
    walk_forward_folds,
)
from tickloom.plans.series import Lane, Series, over_series

__all__ = [
    "FOLDS", "PRICES_BY_TIME", "SEQUENCE_ROWS", "error_summary", "fold_scalers", "fold_spans", "forecast_error", "inverse_minmax",
    "lag_columns", "make_sequences", "minmax", "quote_deviation", "scale_held_out", "sequence_blocks", "sequence_windows",
    "walk_forward_ar1", "walk_forward_folds", "walk_forward_lr",
]


def _fold_start(fold: int, folds: int, rows: int, step: int) -> Column:
    return fold_start(fold, F.col("_n") - rows, folds, step)


def _pairs(df: DataFrame, series: Series, price: str) -> DataFrame:
    """Each price with the one that follows, its time, and its position."""

    def build(d: DataFrame, lane: Lane) -> DataFrame:
        return d.withColumns(
            {
                "x": F.col(price),
                "y": F.lead(price).over(lane.window),
                "y_time": F.lead(series.order).over(lane.window),
                "rn": F.col("_rn"),
                "n": F.col("_n"),
            }
        )

    made = over_series(df.select(*series.keys, series.order, price), series, build, ahead=1, number=True)
    return made.withColumnsRenamed({"rn": "_rn", "n": "_n"})


def _scaler_of(fold: int, folds: int, rows: int, step: int, price: str) -> list[Column]:
    """Smallest and largest price among the rows the fold's training sequences cover."""
    seen = F.when(F.col("_rn") <= _fold_start(fold, folds, rows, step) + rows - 2, F.col(price))
    return [F.min(seen).alias("price_min"), F.max(seen).alias("price_max")]


def fold_scalers(
    df: DataFrame,
    series: Series = PRICES_BY_TIME,
    rows: int = SEQUENCE_ROWS,
    folds: int = FOLDS,
    price: str = "price",
    step: int = 1,
) -> DataFrame:
    """Per series and fold: where training ends and the price range it has seen."""
    numbered = _pairs(df, series, price)
    per_fold = [
        F.struct(
            F.lit(f).alias("fold"),
            F.max(_fold_start(f, folds, rows, step)).alias("start"),
            *_scaler_of(f, folds, rows, step, "x"),
        )
        for f in range(folds)
    ]
    made = numbered.groupBy(*series.keys).agg(F.array(*per_fold).alias("folds"))
    return made.select(*series.keys, F.inline("folds")).filter("start >= 1")


def minmax(x: Column, low: Column, high: Column) -> Column:
    """Map [low, high] to [0, 1]; an empty range keeps the scale 1."""
    return (x - low) / _range(low, high)


def inverse_minmax(x: Column, low: Column, high: Column) -> Column:
    return x * _range(low, high) + low


def _range(low: Column, high: Column) -> Column:
    return F.when(high == low, F.lit(1.0)).otherwise(high - low)


def scale_held_out(
    df: DataFrame,
    series: Series = PRICES_BY_TIME,
    rows: int = SEQUENCE_ROWS,
    folds: int = FOLDS,
    price: str = "price",
    step: int = 1,
) -> DataFrame:
    """Labels of the test and validation sequences of every fold on the scale of its training rows."""
    numbered = _pairs(df, series, price)
    per_fold = []
    for f in range(folds):
        start = _fold_start(f, folds, rows, step)
        for on, role in enumerate(("test", "validation")):
            here = F.col("_rn") == start + on + rows
            per_fold.append(
                F.struct(
                    F.lit(f).alias("fold"),
                    F.lit(role).alias("role"),
                    F.max(start + on).alias("seq"),
                    *_scaler_of(f, folds, rows, step, "x"),
                    F.max(F.when(here, F.col("x"))).alias("label"),
                )
            )
    made = numbered.groupBy(*series.keys).agg(F.array(*per_fold).alias("folds"))
    held = made.select(*series.keys, F.inline("folds")).filter("(role = 'test' and seq >= 1) or seq >= 2")
    return held.withColumn("scaled", minmax(F.col("label"), F.col("price_min"), F.col("price_max")))


def walk_forward_ar1(
    df: DataFrame,
    series: Series = PRICES_BY_TIME,
    rows: int = SEQUENCE_ROWS,
    folds: int = FOLDS,
    price: str = "price",
    step: int = 1,
) -> DataFrame:
    """Forecast each fold's validation row by least squares of the label on the last price of a sequence.

    Fit, scaler and held-out pair of every series and fold are conditional aggregates of one pass.
    """
    pairs = _pairs(df, series, price)
    seq = F.col("_rn") - (rows - 1)
    per_fold = []
    for f in range(folds):
        start = _fold_start(f, folds, rows, step)
        # A pair counts for the fit only if both its prices are known.
        train = (seq >= 0) & (seq < start) & F.col("x").isNotNull() & F.col("y").isNotNull()
        x, y = F.when(train, F.col("x")), F.when(train, F.col("y"))
        held = seq == start + 1
        per_fold.append(
            F.struct(
                F.lit(f).alias("fold"),
                F.max(start).alias("start"),
                *_scaler_of(f, folds, rows, step, "x"),
                F.covar_pop(x, y).alias("cov"),
                F.var_pop(x).alias("var"),
                F.avg(x).alias("mean_x"),
                F.avg(y).alias("mean_y"),
                F.max(F.when(held, F.col("x"))).alias("last"),
                F.max(F.when(held, F.col("y"))).alias("actual"),
                F.max(F.when(held, F.col("y_time"))).alias("time"),
            )
        )
    made = pairs.groupBy(*series.keys).agg(F.array(*per_fold).alias("folds"))
    fits = made.select(*series.keys, F.inline("folds")).filter("start >= 1")
    low, high = F.col("price_min"), F.col("price_max")
    slope = F.coalesce(F.try_divide(F.col("cov"), F.col("var")), F.lit(0.0))
    intercept = minmax(F.col("mean_y"), low, high) - slope * minmax(F.col("mean_x"), low, high)
    scaled = intercept + slope * minmax(F.col("last"), low, high)
    return fits.select(
        *series.keys, "fold", "time", "actual", inverse_minmax(scaled, low, high).alias("predicted")
    )


def forecast_error(forecasts: DataFrame) -> DataFrame:
    return forecasts.withColumn("error", F.col("actual") - F.col("predicted"))


def error_summary(forecasts: DataFrame, series: Series = PRICES_BY_TIME) -> DataFrame:
    error = F.col("actual") - F.col("predicted")
    return forecasts.groupBy(*series.keys).agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def quote_deviation(
    forecasts: DataFrame, quotes: DataFrame, series: Series = PRICES_BY_TIME, folds: int = FOLDS
) -> DataFrame:
    """Distance in percent of the current quote to the newest forecast.

    The newest forecast is that of the last fold, which is about the last known row, not the next one.
    ``quotes`` has one row per series: the keys and ``current``. Series with a forecast but no quote, or the
    other way round, stay with what they have.
    """
    newest = forecasts.filter(F.col("fold") == folds - 1)
    off = F.try_divide(F.abs(F.col("current") - F.col("predicted")), F.col("current")) * 100
    return newest.join(quotes, list(series.keys), "full").select(
        *series.keys, "current", "predicted", off.alias("percent_off")
    )
