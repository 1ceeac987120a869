"""Technical indicators over bars.

``*_levels`` states an indicator's columns inside one lane; the operator of the plain name spreads the
series and builds it. ``technical_features`` builds all of them together: the bars are shuffled once,
sorted by date for looks and frames, and once more by cell for the recursive means.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.functions.rolling import known, ratio, rolling_mean_levels, rolling_std_levels, row_max, shift, where
from tickloom.operators.ema import cell_level, cell_name, cell_rows, look_back, mean_levels, start_levels
from tickloom.plans.series import Lane, Series, over_series
from tickloom.plans.stages import Levels, add_levels


def _look(lane: Lane) -> dict:
    return {"_close_before": shift(F.col("close"), 1, lane)}


def _joined(one: Levels, other: Levels) -> Levels:
    return [a | b for a, b in zip(one, other, strict=True)]


def sma_levels(lane: Lane, spans: Iterable[int] = S.SMA_SPANS) -> Levels:
    return [{}, {}, *rolling_mean_levels("close", {f"sma_{n}": n for n in spans}, lane)]


def rsi_levels(lane: Lane, n: int = S.RSI_ROWS) -> Levels:
    """Relative strength from plain means of gains and losses; the first row counts as no change."""
    delta = known(F.col("close").cast("double") - F.col("_close_before"))
    gain, loss = F.col("_mean_gain"), F.col("_mean_loss")
    only_gains = F.when(gain > 0, F.lit(100.0))
    strength = 100 - 100 / (1 + F.try_divide(gain, loss))  # NULL until the frame of gains is full
    return [
        _look(lane),
        {"_gain": where(delta, delta > 0, 0.0), "_loss": where(-delta, delta < 0, 0.0)},
        *_joined(
            rolling_mean_levels("_gain", {"_mean_gain": n}, lane), rolling_mean_levels("_loss", {"_mean_loss": n}, lane)
        ),
        {f"rsi_{n}": F.when(loss == 0, only_gains).otherwise(strength)},
    ]


def bollinger_levels(lane: Lane, n: int = S.BAND_ROWS, width: float = S.BAND_WIDTH) -> Levels:
    reach = F.col("_deviation") * width
    return [
        {},
        {},
        *_joined(
            rolling_mean_levels("close", {"bb_middle": n}, lane), rolling_std_levels("close", {"_deviation": n}, lane)
        ),
        {"bb_upper": F.col("bb_middle") + reach, "bb_lower": F.col("bb_middle") - reach},
        {"bb_width": F.col("bb_upper") - F.col("bb_lower")},
    ]


def volatility_levels(lane: Lane, spans: Iterable[int] = S.VOLATILITY_ROWS) -> Levels:
    """Rolling deviation of returns; a window holding an infinite return has none."""
    change = ratio(F.col("close"), F.col("_close_before")) - 1
    return [
        _look(lane),
        {"_return": F.when(F.abs(change) < float("inf"), change)},
        *rolling_std_levels("_return", {f"volatility_{n}": n for n in spans}, lane),
    ]


def atr_levels(lane: Lane, n: int = S.ATR_ROWS) -> Levels:
    high, low, before = F.col("high"), F.col("low"), F.col("_close_before")
    return [
        _look(lane),
        {"_range": row_max(*(known(F.abs(x).cast("double")) for x in (high - low, high - before, low - before)))},
        *rolling_mean_levels("_range", {f"atr_{n}": n}, lane),
    ]


def volume_levels(lane: Lane, n: int = S.VOLUME_ROWS) -> Levels:
    mean = f"volume_sma_{n}"
    return [
        {},
        {},
        *rolling_mean_levels("volume", {mean: n}, lane),
        {"volume_ratio": ratio(F.col("volume"), F.col(mean))},
    ]


def macd_levels(lane: Lane, cell: int) -> Levels:
    """The two close means, their difference, its mean and what is left.

    The difference starts where the close starts, so the signal needs no look of its own.
    """
    fast, slow = S.EMA_SPANS
    means = {f"ema_{n}": ("close", n) for n in S.EMA_SPANS}
    return [
        *mean_levels(lane, means, cell, "close"),
        {"macd": F.col(f"ema_{fast}") - F.col(f"ema_{slow}")},
        *mean_levels(lane, {"macd_signal": ("macd", S.SIGNAL_SPAN)}, cell, "close"),
        {"macd_histogram": F.col("macd") - F.col("macd_signal")},
    ]


FRAME_INDICATORS = (rsi_levels, atr_levels, volatility_levels, sma_levels, bollinger_levels, volume_levels)


def add_technical(df: DataFrame, lane: Lane, *more: Levels, indicators: Iterable = FRAME_INDICATORS) -> DataFrame:
    """Looks and row values first, then the recursive means on still narrow rows, then all frames.

    Frames follow the cell order of the means, so rows are sorted by date once for the looks and once
    by cell for everything after. A numbered lane knows its cells beforehand. ``more`` are levels of
    other operators that only look at neighbours.
    """
    cell = cell_rows(max(S.EMA_SPANS))
    lane = lane.in_cells(cell_name(cell))
    built = [make(lane) for make in indicators]
    starts = start_levels(lane, "close")
    df = add_levels(df, *[levels[:2] for levels in (*built, starts, *more)], [{}, cell_level(cell)])
    df = add_levels(df, macd_levels(lane, cell))
    return add_levels(df, *[levels[2:] for levels in (*built, *more)])


# Rows of history the recursive means read: the signal is a mean of means.
MACD_BACK = look_back(max(S.EMA_SPANS)) * 2
TECHNICAL_BACK = max(MACD_BACK, *S.SMA_SPANS)


def sma(df: DataFrame, spans: Iterable[int] = S.SMA_SPANS, series: Series = Series()) -> DataFrame:
    spans = tuple(spans)
    return over_series(df, series, lambda d, lane: add_levels(d, sma_levels(lane, spans)), back=max(spans) - 1)


def rsi(df: DataFrame, n: int = S.RSI_ROWS, series: Series = Series()) -> DataFrame:
    return over_series(df, series, lambda d, lane: add_levels(d, rsi_levels(lane, n)), back=n)


def macd(df: DataFrame, series: Series = Series()) -> DataFrame:
    made = over_series(df, series, lambda d, lane: add_technical(d, lane, indicators=()), back=MACD_BACK, number=True)
    return made.select(*df.columns, "macd", "macd_signal", "macd_histogram")


def bollinger(
    df: DataFrame, n: int = S.BAND_ROWS, width: float = S.BAND_WIDTH, series: Series = Series()
) -> DataFrame:
    return over_series(df, series, lambda d, lane: add_levels(d, bollinger_levels(lane, n, width)), back=n - 1)


def volatility(df: DataFrame, spans: Iterable[int] = S.VOLATILITY_ROWS, series: Series = Series()) -> DataFrame:
    spans = tuple(spans)
    return over_series(df, series, lambda d, lane: add_levels(d, volatility_levels(lane, spans)), back=max(spans))


def atr(df: DataFrame, n: int = S.ATR_ROWS, series: Series = Series()) -> DataFrame:
    return over_series(df, series, lambda d, lane: add_levels(d, atr_levels(lane, n)), back=n)


def volume_features(df: DataFrame, n: int = S.VOLUME_ROWS, series: Series = Series()) -> DataFrame:
    return over_series(df, series, lambda d, lane: add_levels(d, volume_levels(lane, n)), back=n - 1)


def technical_features(df: DataFrame, series: Series = Series()) -> DataFrame:
    made = over_series(df, series, add_technical, back=TECHNICAL_BACK, number=True)
    return made.select(*df.columns, *S.TECHNICAL)
