"""Declared schemas and the column lists the feature pipeline agrees on."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

PRICES = ("open", "high", "low", "close")
BAR_VALUES = (*PRICES, "volume")

BAR_SCHEMA = StructType(
    [StructField("series_key", StringType()), StructField("date", TimestampType())]
    + [StructField(name, DoubleType()) for name in BAR_VALUES]
)

PRICE_SCHEMA = StructType(
    [
        StructField("series_key", StringType()),
        StructField("timestamp", TimestampType()),
        StructField("price", DoubleType()),
    ]
)

QUOTE_SCHEMA = StructType(
    [
        StructField("timestamp", TimestampType()),
        StructField("price_usd", DoubleType()),
        StructField("volume_24h", DoubleType()),
        StructField("change_24h", DoubleType()),
        StructField("last_updated", TimestampType()),
    ]
)

# Window lengths and output names of the feature set.
SMA_SPANS = (7, 14, 21, 50, 200)
EMA_SPANS = (12, 26)
SIGNAL_SPAN = 9
RSI_ROWS = 14
BAND_ROWS = 20
BAND_WIDTH = 2.0
VOLATILITY_ROWS = (7, 14, 30)
ATR_ROWS = 14
VOLUME_ROWS = 20

TECHNICAL = (
    *(f"sma_{n}" for n in SMA_SPANS),
    *(f"ema_{n}" for n in EMA_SPANS),
    f"rsi_{RSI_ROWS}",
    "macd",
    "macd_signal",
    "macd_histogram",
    "bb_middle",
    "bb_upper",
    "bb_lower",
    "bb_width",
    *(f"volatility_{n}" for n in VOLATILITY_ROWS),
    f"atr_{ATR_ROWS}",
    f"volume_sma_{VOLUME_ROWS}",
    "volume_ratio",
)

CALENDAR_PARTS = ("day_of_week", "day_of_month", "week_of_year", "month", "quarter", "year")
CALENDAR_CYCLES = ("day_sin", "day_cos", "month_sin", "month_cos")
CALENDAR_FLAGS = ("is_weekend", "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end")
CALENDAR = (*CALENDAR_PARTS, *CALENDAR_CYCLES, *CALENDAR_FLAGS)

TARGETS = ("target_next_close", "target_pct_change", "target_direction")
LABEL = "target_direction"

# Columns that never count as model inputs. The label is absent from this list: see select_features.
NOT_FEATURES = ("date", "open", "high", "low", "close", "volume", "adj close", "target_next_close", "target_pct_change")
