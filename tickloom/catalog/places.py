"""Decimal places per feature on which two engines agree when they add in a different order."""

from __future__ import annotations

from collections.abc import Iterable

from tickloom import schema as S


def all_to(columns: Iterable[str], places: int) -> dict[str, int]:
    return {c: places for c in columns}


SMA = [f"sma_{n}" for n in S.SMA_SPANS]
EMA = [f"ema_{n}" for n in S.EMA_SPANS]
MACD = ["macd", "macd_signal", "macd_histogram"]
BANDS = ["bb_middle", "bb_upper", "bb_lower", "bb_width"]
VOLATILITY = [f"volatility_{n}" for n in S.VOLATILITY_ROWS]

PLACES = {
    **all_to([*SMA, "rsi_14", "atr_14", "volume_sma_20", "volume_ratio"], 6),
    **all_to([*EMA, *MACD, *BANDS], 4),
    **all_to([*VOLATILITY, "target_pct_change"], 8),
    **all_to(S.CALENDAR_CYCLES, 12),
}
