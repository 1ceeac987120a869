"""The batch flows, composed from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.functions.scalars import round_price
from tickloom.operators.calendar import calendar_features
from tickloom.operators.clean import append_row, clean_bars
from tickloom.operators.dataset import prepare_dataset, write_bundle
from tickloom.operators.forecast import (
    FOLDS,
    PRICES_BY_TIME,
    SEQUENCE_ROWS,
    error_summary,
    forecast_error,
    quote_deviation,
    walk_forward_lr,
)
from tickloom.operators.profile import price_report, quote_vs_mean
from tickloom.operators.target import target_levels
from tickloom.operators.technical import TECHNICAL_BACK, add_technical
from tickloom.operators.validate import require_valid, require_valid_quotes, validate_bars
from tickloom.plans.series import Lane, Series, over_series
from tickloom.session import materialise
from tickloom.sources.readers import require_non_empty, scan_csv
from tickloom.sources.writers import sink_csv


def feature_table(bars: DataFrame, series: Series = Series()) -> DataFrame:
    """Bars widened by technical, calendar and target columns; one pass over each series."""

    def build(df: DataFrame, lane: Lane) -> DataFrame:
        return add_technical(df, lane, target_levels(lane))

    made = over_series(bars, series, build, back=TECHNICAL_BACK, ahead=1, number=True)
    return calendar_features(made, series.order).select(*bars.columns, *S.TECHNICAL, *S.CALENDAR, *S.TARGETS)


def ingest(bars: DataFrame, series: Series = Series()) -> DataFrame:
    """Refuse empty or invalid bars, then report on them."""
    require_valid(validate_bars(require_non_empty(bars, "bars"), series))
    return price_report(bars)


def compare_quotes(quotes: DataFrame, bars: DataFrame) -> DataFrame:
    """Refuse invalid quotes, then set each against the mean close of its series."""
    return quote_vs_mean(require_valid_quotes(quotes), bars)


def save_prices(history: DataFrame, newest: DataFrame, path: str) -> str:
    """Append the current price to a non-empty history, round to cents and write the price file."""
    prices = append_row(require_non_empty(history, "history"), newest)
    return sink_csv(prices.withColumn("price", round_price(F.col("price"))), path)


@dataclass(frozen=True)
class FeatureRun:
    features: DataFrame
    prepared: DataFrame
    bundle: dict[str, str]
    # What the write of the clean bars saw: rows_in, rows_out, rows_removed, first_date, last_date, mean_close.
    counts: dict[str, object]


def run_features(raw: DataFrame, path: str, series: Series = Series(), seq: str = "seq") -> FeatureRun:
    """Clean, build features, split and write the bundle. The clean and the feature table are each written once and reused.

    Counts and the summary of the clean bars are observed as they are written; no job is run for them.
    """
    read, kept = Observation(), Observation()
    raw = raw.observe(read, F.count(F.lit(1)).alias("rows_in"))
    seen = [F.min(series.order).alias("first_date"), F.max(series.order).alias("last_date"), F.avg("close").alias("mean_close")]
    clean = clean_bars(raw, series, seq).observe(kept, F.count(F.lit(1)).alias("rows_out"), *seen)
    clean = materialise(clean, "clean")
    counts = {**read.get, **kept.get}
    counts["rows_removed"] = counts["rows_in"] - counts["rows_out"]
    series = series.measured(clean)
    features = materialise(feature_table(clean, series), "features")
    prepared = prepare_dataset(features, series)
    return FeatureRun(features, prepared, write_bundle(prepared, path, series), counts)


@dataclass(frozen=True)
class ForecastRun:
    forecasts: DataFrame
    errors: DataFrame
    deviation: DataFrame


def run_forecast(
    spark: SparkSession,
    path: str,
    quotes: DataFrame,
    series: Series = PRICES_BY_TIME,
    series_key: str | None = None,
    rows: int = SEQUENCE_ROWS,
    folds: int = FOLDS,
    model=walk_forward_lr,
) -> ForecastRun:
    """Read a price file, forecast walk-forward, and set errors and current quotes against the forecasts.

    ``quotes`` has one row per series: the keys and ``current``. The forecasts are written once and read three times.
    """
    prices = require_non_empty(scan_csv(spark, path, series_key), "prices")
    forecasts = materialise(model(prices, series, rows, folds), "forecasts")
    return ForecastRun(
        forecast_error(forecasts), error_summary(forecasts, series), quote_deviation(forecasts, quotes, series, folds)
    )
