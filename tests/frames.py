"""Small tables for tests."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd

START = dt.datetime(2024, 1, 1)


def days(n: int) -> list[dt.datetime]:
    return [START + dt.timedelta(days=i) for i in range(n)]


def closes(spark, values, key="A"):
    rows = [(key, d, None if v is None else float(v)) for d, v in zip(days(len(values)), values)]
    return spark.createDataFrame(rows, "series_key string, date timestamp, close double")


def column(df, name, order="date"):
    return [row[name] for row in df.orderBy(order).collect()]


def random_bars(lengths: dict[str, int], seed: int = 7) -> pd.DataFrame:
    """Bars at uneven times, one series per key."""
    rng = np.random.default_rng(seed)
    parts = []
    for key, n in lengths.items():
        close = np.round(100 + np.cumsum(rng.normal(0, 1, n)), 2)
        spread = np.round(rng.uniform(0, 2, n), 2)
        gaps = rng.integers(1, 4000, n).cumsum()
        parts.append(
            pd.DataFrame(
                {
                    "series_key": key,
                    "date": pd.Timestamp(START) + pd.to_timedelta(gaps, unit="min"),
                    "open": np.roll(close, 1),
                    "high": close + spread,
                    "low": close - spread,
                    "close": close,
                    "volume": rng.integers(0, 50, n).astype(float),
                }
            )
        )
    return pd.concat(parts, ignore_index=True).sample(frac=1, random_state=seed)
