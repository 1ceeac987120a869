"""A series cut into blocks gives what the whole series gives, next to series that are not cut."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.frames import random_bars
from tickloom.operators import clean, dataset, ema, forecast, profile, target, technical, validate
from tickloom.plans.flows import feature_table
from tickloom.plans.series import Series, arrange, long_series

LENGTHS = {"hot": 3000, "cold": 260, "tiny": 3, "single": 1}
WHOLE = Series()


@pytest.fixture(scope="module")
def bars(spark):
    table = random_bars(LENGTHS)
    patchy = table["close"].where(pd.Series(range(len(table)), index=table.index) % 5 != 0)
    patchy[table["series_key"].eq("hot") & table["date"].between("2024-06-01", "2026-06-01")] = None
    late = table["close"].where(~table["series_key"].eq("hot") | (table["date"] > "2026-01-01"))
    made = spark.createDataFrame(table.assign(patchy=patchy, late=late)).withColumns(
        {c: F.when(~F.isnan(c), F.col(c)) for c in ("patchy", "late")}
    )
    return made.withColumn("broken", F.when(F.col("volume") > 10, F.col("close")).otherwise(0.0))


def same(left, right, keys=("series_key", "date"), places=9):
    a, b = (df.orderBy(*keys).toPandas() for df in (left, right))
    pd.testing.assert_frame_equal(a[sorted(a)], b[sorted(b)], rtol=10**-places, atol=10**-places)
    assert len(a) > 0


@pytest.mark.parametrize(
    "operator, block_rows",
    [
        (lambda d, s: technical.sma(d, (7, 50, 199, 200), s), 250),
        (lambda d, s: technical.rsi(d, 14, s), 20),
        (lambda d, s: technical.bollinger(d, 20, 2.0, s), 20),
        (lambda d, s: technical.volatility(d, (7, 14, 30), s), 31),
        (lambda d, s: technical.atr(d, 14, s), 100),
        (lambda d, s: technical.volume_features(d, 20, s), 100),
        (lambda d, s: ema.ewm_mean(d, {"e": ("close", 3), "f": ("close", 20)}, s), 900),
        (lambda d, s: ema.ewm_mean(d, {"e": ("late", 3), "f": ("late", 20)}, s), 900),
        (lambda d, s: target.targets(d, s), 2),
        (lambda d, s: clean.interpolate_linear(d, ["patchy"], s), 64),
        (lambda d, s: clean.zero_to_previous(d, ["broken"], s), 64),
        (lambda d, s: clean.drop_last_row(d, s), 64),
        (lambda d, s: clean.sort_by_date(d, s), 64),
        (lambda d, s: dataset.temporal_split(d, s), 64),
        (lambda d, s: feature_table(d.select("series_key", "date", "open", "high", "low", "close", "volume"), s), 2200),
    ],
)
def test_same_rows(bars, operator, block_rows):
    same(operator(bars, Series(block_rows=block_rows)), operator(bars, WHOLE))


@pytest.mark.parametrize("rule", [validate.val_date_gap, validate.val_outlier_change])
def test_same_verdict(bars, rule):
    same(rule(bars, Series(block_rows=50)), rule(bars, WHOLE), keys=("series_key",))


def test_same_sequences_and_forecasts(bars):
    prices = bars.select("series_key", F.col("date").alias("timestamp"), F.col("close").alias("price"))
    cut, whole = Series(order="timestamp", block_rows=64), Series(order="timestamp")
    same(forecast.make_sequences(prices, cut), forecast.make_sequences(prices, whole), ("series_key", "seq"))
    same(forecast.walk_forward_ar1(prices, cut), forecast.walk_forward_ar1(prices, whole), ("series_key", "fold"))
    same(forecast.scale_held_out(prices, cut), forecast.scale_held_out(prices, whole), ("series_key", "fold", "role"))


def test_same_median_with_many_copies(bars):
    skewed = bars.withColumn("x", F.when(F.col("volume") < 30, 1.0).otherwise(F.col("close")))
    for column in ("x", "close"):
        cut = profile.exact_median(skewed, column, ["series_key"], block_rows=40)
        same(cut, profile.exact_median(skewed, column, ["series_key"]), ("series_key",))


def test_positions_are_complete(bars):
    arranged = arrange(bars, Series(block_rows=64))
    assert arranged.split
    found = arranged.df.groupBy("series_key").agg(
        F.min("_rn").alias("low"), F.max("_rn").alias("high"), F.countDistinct("_rn").alias("n"), F.max("_n").alias("len")
    )
    for row in found.collect():
        n = LENGTHS[row["series_key"]]
        assert (row["low"], row["high"], row["n"], row["len"]) == (0, n - 1, n, n)


def test_series_without_a_key_is_split_too(spark, bars):
    keyless = bars.withColumn("series_key", F.when(F.col("series_key") != "hot", F.col("series_key")))
    made = technical.sma(keyless, (7,), Series(block_rows=64)).filter("series_key is null")
    expected = technical.sma(bars, (7,), WHOLE).filter("series_key = 'hot'")
    same(made.drop("series_key"), expected.drop("series_key"), ("date",))


@pytest.mark.parametrize("block_rows", [64, 1_000_000])
def test_ties_are_ordered(spark, block_rows):
    rows = spark.range(600).select(
        F.lit("A").alias("series_key"), (F.col("id") / 3).cast("long").alias("date"), (-F.col("id")).alias("tie"), F.col("id")
    )
    made = clean.sort_by_date(rows, Series(ties=("tie",), block_rows=block_rows)).orderBy("row_no").collect()
    assert [r["id"] for r in made] == [3 * (i // 3) + 2 - i % 3 for i in range(600)]


def test_measured_once(bars):
    assert Series().measured(bars).fits
    assert not Series(block_rows=64).measured(bars).fits
    assert [r["series_key"] for r in long_series(bars, Series(block_rows=300)).collect()] == ["hot"]


def test_block_shorter_than_frame_is_refused(bars):
    with pytest.raises(ValueError, match="shorter"):
        technical.sma(bars, (200,), Series(block_rows=100))


def test_a_hot_date_is_split_by_ties(spark):
    rows = [("A", f"2024-01-{1 + (i % 10 if i % 4 == 0 else 4):02d}", i) for i in range(4000)]
    table = spark.createDataFrame(rows, "series_key string, day string, place int").withColumn("date", F.to_timestamp("day"))
    series = Series(ties=("place",), block_rows=300)
    arranged = arrange(table, series)
    assert arranged.split
    numbered = arranged.df.orderBy("date", "place").select("_rn").collect()
    assert [r["_rn"] for r in numbered] == list(range(4000))
    slices = arranged.df.sparkSession.read.parquet(_newest_slices(spark)).groupBy("_slice").count()
    assert slices.agg(F.max("count")).first()[0] <= 300


def _newest_slices(spark):
    from tickloom import session

    return next(p for p in reversed(session._WRITTEN) if "/slices-" in p)
