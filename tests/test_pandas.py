"""Indicators against pandas on random bars."""

import numpy as np
import pandas as pd
import pytest

from tests.frames import random_bars
from tickloom import schema as S
from tickloom.functions.rolling import frame_pieces
from tickloom.functions.scalars import nan_to_null
from tickloom.operators import ema, technical
from tickloom.plans.series import Series


def expected(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("date").reset_index(drop=True)
    close, change = g["close"], g["close"].diff()
    for n in S.SMA_SPANS:
        g[f"sma_{n}"] = close.rolling(n).mean()
    for n in S.EMA_SPANS:
        g[f"ema_{n}"] = close.ewm(span=n, adjust=False).mean()
    gain = change.clip(lower=0).fillna(0).rolling(14).mean()
    loss = (-change).clip(lower=0).fillna(0).rolling(14).mean()
    g["rsi_14"] = 100 - 100 / (1 + gain / loss)
    g["macd"] = g["ema_12"] - g["ema_26"]
    g["macd_signal"] = g["macd"].ewm(span=9, adjust=False).mean()
    g["macd_histogram"] = g["macd"] - g["macd_signal"]
    g["bb_middle"] = close.rolling(20).mean()
    g["bb_upper"] = g["bb_middle"] + 2 * close.rolling(20).std()
    g["bb_lower"] = g["bb_middle"] - 2 * close.rolling(20).std()
    g["bb_width"] = g["bb_upper"] - g["bb_lower"]
    for n in S.VOLATILITY_ROWS:
        g[f"volatility_{n}"] = close.pct_change().rolling(n).std()
    before = close.shift()
    spans = [g["high"] - g["low"], (g["high"] - before).abs(), (g["low"] - before).abs()]
    g["atr_14"] = pd.concat(spans, axis=1).max(axis=1).rolling(14).mean()
    g["volume_sma_20"] = g["volume"].rolling(20).mean()
    g["volume_ratio"] = g["volume"] / g["volume_sma_20"]
    return g


@pytest.mark.parametrize("seed", [1, 2])
def test_technical_features(spark, seed):
    bars = random_bars({"a": 1700, "b": 230, "c": 5}, seed)
    made = technical.technical_features(spark.createDataFrame(bars)).orderBy("series_key", "date").toPandas()
    wanted = pd.concat([expected(g) for _, g in bars.groupby("series_key")], ignore_index=True)
    columns = ["series_key", "date", *S.TECHNICAL]
    pd.testing.assert_frame_equal(
        made[columns].astype({c: float for c in S.TECHNICAL}), wanted[columns], rtol=1e-9, atol=1e-9
    )


@pytest.mark.parametrize("span", [2, 9, 60, 1000])
def test_recursive_mean(spark, span):
    bars = random_bars({"a": 4000}, 3)
    bars.loc[bars["date"] < bars["date"].sort_values().iloc[4], "close"] = None
    table = nan_to_null(spark.createDataFrame(bars))
    made = ema.ewm_mean(table, {"e": ("close", span)}, Series()).orderBy("date").toPandas()["e"].astype(float)
    wanted = bars.sort_values("date")["close"].ewm(span=span, adjust=False).mean().reset_index(drop=True)
    np.testing.assert_allclose(made, wanted, rtol=1e-11)


@pytest.mark.parametrize("n", [1, 7, 32, 33, 50, 97, 199, 200, 1000])
def test_pieces_cover_a_frame_once(n):
    rows = sorted(r for length, back in frame_pieces(n) for r in range(back, back + length))
    assert rows == list(range(n))


def test_infinities_count_as_missing(spark):
    """The first close of a series and volumes anywhere; inside, a recursive mean refuses a missing close."""
    bars = random_bars({"a": 300, "b": 60}, 5).sort_values(["series_key", "date"]).reset_index(drop=True)
    first = bars.groupby("series_key").head(1).index
    bars.loc[first, "close"] = [np.inf, -np.inf]
    bars.loc[[40, 41, 200], "volume"] = np.inf
    made = technical.technical_features(spark.createDataFrame(bars)).orderBy("series_key", "date")
    bad = [c for c in S.TECHNICAL if made.filter(f"isnan({c})").count()]
    assert not bad
    made = made.toPandas()
    wanted = pd.concat([expected(g) for _, g in bars.groupby("series_key")], ignore_index=True)
    columns = [c for c in S.TECHNICAL if c != "volume_ratio"]
    pd.testing.assert_frame_equal(made[columns].astype(float), wanted[columns], rtol=1e-9, atol=1e-9)


def test_infinite_close_inside_frames(spark):
    bars = random_bars({"a": 120}, 6).sort_values("date").reset_index(drop=True)
    bars.loc[[50, 51, 80], "close"] = np.inf
    bars.loc[90, "high"] = np.inf
    table, series = spark.createDataFrame(bars), Series()
    wanted = expected(bars)
    for make, names in (
        (lambda: technical.sma(table, (7, 50), series), ["sma_7", "sma_50"]),
        (lambda: technical.bollinger(table, series=series), ["bb_middle", "bb_upper", "bb_lower", "bb_width"]),
        (lambda: technical.rsi(table, series=series), ["rsi_14"]),
        (lambda: technical.volatility(table, series=series), [f"volatility_{n}" for n in S.VOLATILITY_ROWS]),
        (lambda: technical.atr(table, series=series), ["atr_14"]),
    ):
        made = make().orderBy("date")
        assert not any(made.filter(f"isnan({c})").count() for c in names)
        pd.testing.assert_frame_equal(made.toPandas()[names].astype(float), wanted[names], rtol=1e-9, atol=1e-9)
