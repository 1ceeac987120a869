"""Exponential means over gaps against pandas and a plain loop, whole and in blocks."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tests.frames import closes, column, days
from tests.test_split import same
from tickloom.operators import ema
from tickloom.plans.series import DAILY, Series


def plain(values, span):
    """The recursion as it is told: weights of what is missing shrink, and a value takes its share of what is left."""
    q, mean, weight, out = 1 - 2 / (span + 1), None, 1.0, []
    for x in values:
        if x is not None and math.isfinite(x):
            left = weight * q
            mean, weight = (x if mean is None else (left * mean + (1 - q) * x) / (left + 1 - q)), 1.0
        elif mean is not None:
            weight *= q
        out.append(mean)
    return out


@pytest.mark.parametrize("span", [1, 2, 5, 26, 300])
def test_equal_to_pandas(spark, span):
    rng = np.random.default_rng(span)
    values = [None if rng.random() < 0.4 else float(v) for v in np.cumsum(rng.normal(size=600))]
    values[:3], values[100:220], values[-2:] = [None] * 3, [None] * 120, [None] * 2
    got = column(ema.ewm_mean(closes(spark, values), {"e": ("close", span)}, DAILY, gaps=True), "e")
    wanted = pd.Series([np.nan if v is None else v for v in values]).ewm(span=span, adjust=False).mean()
    assert np.allclose(np.array(got, float), wanted, rtol=1e-12, atol=1e-12, equal_nan=True)
    assert np.allclose(np.array(plain(values, span), float), wanted, equal_nan=True)


def test_the_surveyed_example(spark):
    got = column(ema.ema(closes(spark, [1, 2, None, 4]), (3,), DAILY, gaps=True), "ema_3")
    assert got == pytest.approx([1, 1.5, 1.5, 2.375 / 0.75])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-100, 100), st.just(float("inf"))), min_size=1, max_size=60), st.sampled_from([1, 3, 20]), st.sampled_from([1, 2, 7]))
def test_any_gaps_in_any_blocks(spark, values, span, block_rows):
    made = ema.ewm_mean(closes(spark, values), {"e": ("close", span)}, Series(block_rows=block_rows), gaps=True)
    expected = plain(values, span)
    assert column(made, "e") == [None if v is None else pytest.approx(v, rel=1e-9, abs=1e-9) for v in expected]


def test_blocks_equal_whole_series_whatever_the_gaps(spark):
    rng = np.random.default_rng(9)
    rows = []
    for key, n in (("hot", 1500), ("cold", 40), ("one", 1), ("never", 60)):
        for i, day in enumerate(days(n)):
            gone = rng.random() < 0.3 or key == "never" or (key == "hot" and 300 < i < 900) or (key == "hot" and i < 130)
            rows.append((key, day, None if gone else float(rng.normal()), float(i % 7)))
    bars = spark.createDataFrame(rows, "series_key string, date timestamp, close double, volume double").repartition(3)
    means = {"a": ("close", 3), "b": ("close", 40), "c": ("volume", 12)}
    whole = ema.ewm_mean(bars, means, Series(), gaps=True)
    assert whole.columns == [*bars.columns, "a", "b", "c"]
    for block_rows in (50, 128):
        same(ema.ewm_mean(bars, means, Series(block_rows=block_rows), gaps=True), whole)


def test_a_gap_of_a_hundred_thousand_rows(spark):
    n = 100_000
    bars = spark.range(n + 2).selectExpr(
        "'A' as series_key", "timestamp_seconds(id * 86400) as date", f"case when id = 0 then 1.0D when id = {n + 1} then 9.0D end as close"
    )
    for series in (Series(), Series(block_rows=20_000)):
        made = ema.ewm_mean(bars, {"e": ("close", 26)}, series, gaps=True)
        assert [r.e for r in made.orderBy("date").where(f"date >= timestamp_seconds({(n - 1) * 86400})").collect()] == pytest.approx([1, 1, 9])


def test_without_gaps_nothing_changes(spark):
    values = list(np.cumsum(np.random.default_rng(2).normal(size=900)))
    bars = closes(spark, values)
    same(ema.ewm_mean(bars, {"e": ("close", 9)}, DAILY, gaps=True), ema.ewm_mean(bars, {"e": ("close", 9)}, DAILY))
    with pytest.raises(Exception, match="gap"):
        ema.ewm_mean(closes(spark, [1, None, 2]), {"e": ("close", 9)}, DAILY).collect()
