"""Edge rules on hand-made rows."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.frames import closes, column, days
from tickloom.functions import rolling, scalars
from tickloom.operators import calendar, clean, ema, forecast, profile, target, technical
from tickloom.plans.series import DAILY, Series, over_series


def windowed(df, make):
    return over_series(df, DAILY, lambda d, lane: d.withColumn("out", make(lane)))


def test_rolling_mean_needs_a_full_frame(spark):
    out = windowed(closes(spark, [1, 2, None, 4, 5, 6]), lambda w: rolling.rolling_mean(F.col("close"), 3, w))
    assert column(out, "out") == [None, None, None, None, None, 5.0]


def test_interpolate_by_position(spark):
    bars = closes(spark, [None, 1, None, None, 4, None])
    assert column(clean.interpolate_linear(bars, ["close"], DAILY), "close") == [None, 1, 2, 3, 4, 4]


def test_interpolation_ignores_the_width_of_a_gap(spark):
    stretched = closes(spark, [0, None, 10]).withColumn(
        "date", F.when(F.col("close") == 10, F.col("date") + F.expr("interval 300 days")).otherwise(F.col("date"))
    )
    assert column(clean.interpolate_linear(stretched, ["close"], DAILY), "close") == [0, 5, 10]


def test_ewm_starts_at_first_value(spark):
    out = ema.ewm_mean(closes(spark, [None, 2, 4]), {"e": ("close", 3)}, DAILY)
    assert column(out, "e") == [None, 2.0, 3.0]


def test_ewm_refuses_a_gap(spark):
    with pytest.raises(Exception, match="interpolate it first"):
        ema.ewm_mean(closes(spark, [1, None, 4]), {"e": ("close", 3)}, DAILY).collect()


def test_ewm_of_span_one_is_the_value(spark):
    out = ema.ewm_mean(closes(spark, [1, 5, 4]), {"e": ("close", 1), "f": ("close", 1.05)}, DAILY)
    assert column(out, "e") == [1, 5, 4]
    q = 1 - 2 / 2.05
    assert column(out, "f")[1] == pytest.approx(q * 1 + (1 - q) * 5)


def test_rsi_first_row_counts_as_no_change(spark):
    out = technical.rsi(closes(spark, [10, 11, 10, 10]), 4, DAILY)
    assert column(out, "rsi_4") == [None, None, None, pytest.approx(50.0)]


def test_rsi_without_losses_and_without_changes(spark):
    assert column(technical.rsi(closes(spark, [1, 2, 3]), 3, DAILY), "rsi_3")[-1] == 100.0
    assert column(technical.rsi(closes(spark, [2, 2, 2]), 3, DAILY), "rsi_3")[-1] is None


def test_targets(spark):
    out = target.targets(closes(spark, [100, 110, 99]), DAILY)
    assert column(out, "target_next_close") == [110, 99, None]
    change = column(out, "target_pct_change")
    assert change[:2] == [pytest.approx(-100 / 11), pytest.approx(100 / 9)] and change[2] is None
    assert column(out, "target_direction") == [1, 0, 0]
    assert column(target.forward_return(closes(spark, [100, 110]), DAILY), "forward_return") == [pytest.approx(10), None]


def test_change_to_and_from_zero(spark):
    out = windowed(closes(spark, [0, 5, 0, 0]), lambda w: rolling.pct_change(F.col("close"), 1, w))
    assert column(out, "out") == [None, float("inf"), -1.0, None]


def test_volatility_has_no_value_over_an_infinite_change(spark):
    out = technical.volatility(closes(spark, [1, 0, 5, 6, 7, 8]), (2,), DAILY)
    assert [v is None for v in column(out, "volatility_2")] == [True, True, True, True, False, False]


def test_atr_first_row_uses_high_minus_low(spark):
    rows = [("A", d, h, low, c) for d, h, low, c in zip(days(2), [5.0, 9.0], [3.0, 8.0], [4.0, 8.5])]
    bars = spark.createDataFrame(rows, "series_key string, date timestamp, high double, low double, close double")
    assert column(technical.atr(bars, 1, DAILY), "atr_1") == [2.0, 5.0]


def test_row_max_skips_missing(spark):
    rows = spark.createDataFrame([(1, 1.0, None), (2, 5.0, 7.0)], "i int, a double, b double")
    assert column(rows.withColumn("m", rolling.row_max(F.col("a"), F.col("b"))), "m", "i") == [1.0, 7.0]


def test_rounding_is_half_even(spark):
    rows = spark.createDataFrame([(1, 0.125), (2, 0.375), (3, 2.675), (4, 1.005)], "i int, x double")
    assert column(rows.withColumn("r", scalars.round_price(F.col("x"))), "r", "i") == [0.12, 0.38, 2.68, 1.0]


def test_calendar(spark):
    moments = [dt.datetime(2024, 1, 1, 13), dt.datetime(2024, 12, 30), dt.datetime(2024, 3, 31, 23)]
    rows = spark.createDataFrame(list(enumerate(moments)), "i int, date timestamp")
    made = calendar.calendar_features(rows)
    assert column(made, "is_month_start", "i") == [1, 0, 0]
    assert column(made, "is_quarter_end", "i") == [0, 0, 1]
    assert column(made, "week_of_year", "i") == [1, 1, 13]
    assert column(made, "day_of_week", "i") == [0, 0, 6]
    assert column(made, "is_weekend", "i") == [0, 0, 1]


def test_dedup_keeps_the_last_ingested_row_whole(spark):
    day = days(1)[0]
    rows = [("A", day, 0, 1.0, 2.0), ("A", day, 2, 3.0, None), ("A", day, 1, 5.0, 6.0)]
    bars = spark.createDataFrame(rows, "series_key string, date timestamp, seq int, open double, close double")
    assert [tuple(r)[2:] for r in clean.dedup_keep_last(bars).collect()] == [(2, 3.0, None)]
    assert clean.count_duplicates(bars).first()["duplicates"] == 2
    assert tuple(clean.clean_metrics(bars).first()) == (3, 1, 2)


def test_only_zeros_are_repaired(spark):
    bars = closes(spark, [0, 3, 0, -2, 0])
    assert column(clean.zero_to_previous(bars, ["close"], DAILY), "close") == [None, 3, 3, -2, -2]
    assert [tuple(r) for r in clean.invalid_price_census(bars, ["close"]).collect()] == [("close", 4)]


def test_drop_last_row_and_order(spark):
    both = closes(spark, [1, 2, 3]).unionByName(closes(spark, [7], "B"))
    assert sorted(column(clean.drop_last_row(both, DAILY), "close")) == [1, 2]
    assert column(clean.sort_by_date(closes(spark, [4, 5]), DAILY), "row_no") == [0, 1]


def test_correlation_of_a_constant_is_missing(spark):
    rows = [(1.0, 5.0, 0), (2.0, 5.0, 1), (3.0, 5.0, 0), (4.0, 5.0, 1)]
    table = spark.createDataFrame(rows, "a double, c double, target_direction int")
    found = {r["feature"]: r["correlation"] for r in profile.target_correlation(table).collect()}
    assert found["a"] == pytest.approx(0.4472135955) and found["c"] is None


def test_correlation_uses_rows_where_both_are_known(spark):
    rows = [(1.0, 0), (2.0, 1), (None, 1), (9.0, None), (3.0, 0)]
    table = spark.createDataFrame(rows, "a double, target_direction int")
    found = {r["feature"]: r["correlation"] for r in profile.target_correlation(table).collect()}
    assert found["a"] == pytest.approx(0.0, abs=1e-12)


def test_infinite_and_missing_counts(spark):
    table = spark.createDataFrame([(1.0, 1), (float("inf"), None), (float("-inf"), 3), (None, 4)], "a double, b int")
    assert {r["feature"]: r["infinite"] for r in profile.inf_census(table).collect()} == {"a": 2, "b": 0}
    assert {r["feature"]: r["missing"] for r in profile.nan_census(table, ["a", "b"]).collect()} == {"a": 1, "b": 1, "total": 2}
    assert [tuple(r) for r in clean.null_census(table).orderBy("column_name").collect()] == [("a", 1), ("b", 1)]
    assert clean.null_census(table.select(F.lit(1).alias("x"))).count() == 0


@pytest.mark.parametrize("values, expected", [([3, 1, 2], 2.0), ([4, 1, 2, 3], 2.5), ([5, 5, 5, 1], 5.0), ([None, 7], 7.0)])
def test_median(spark, values, expected):
    assert profile.exact_median(closes(spark, values), "close").first()["median"] == expected


def test_class_balance(spark):
    labels = spark.createDataFrame([(0,)] * 3 + [(1,)] * 7, "target int")
    row = profile.class_balance(labels).first()
    assert (row["class_0"], row["class_1"], row["percent_0"], row["balanced"]) == (3, 7, 30.0, True)
    alone = profile.class_balance(spark.createDataFrame([(1,)], "target int")).first()
    assert alone["ratio"] == 0.0 and alone["balanced"] is False


def test_quote_against_mean(spark):
    quotes = spark.createDataFrame([("A", 12.0), ("A", 10.0), ("A", 5.0)], "series_key string, price_usd double")
    made = profile.quote_vs_mean(quotes, closes(spark, [8, 12])).orderBy("price_usd").collect()
    assert [(r["sign"], r["difference"], r["percent"]) for r in made] == [("-", 5, 50), ("-", 0, 0), ("+", 2, 20)]


def test_duplicate_rows(spark):
    table = spark.createDataFrame([(1, None), (1, None), (1, 2), (1, None)], "a int, b int")
    assert profile.duplicate_rows(table).first()["duplicates"] == 2


def test_dedup_never_mixes_or_blanks_rows(spark):
    day = days(1)[0]
    rows = [("A", day, None, 1.0, None), ("B", day, 5, 2.0, 9.0), ("B", day, 5, 3.0, None), ("C", day, None, 4.0, 1.0), ("C", day, 0, None, 7.0)]
    bars = spark.createDataFrame(rows, "series_key string, date timestamp, seq int, close double, volume double")
    for shuffled in (bars, bars.orderBy(F.desc("close"))):
        kept = {r["series_key"]: tuple(r)[2:] for r in clean.dedup_keep_last(shuffled).collect()}
        assert kept == {"A": (None, 1.0, None), "B": (5, 3.0, None), "C": (0, None, 7.0)}


def test_zero_repair_leaves_missing_values(spark):
    out = clean.zero_to_previous(closes(spark, [3, None, 0, 0, None, -1]), ["close"], DAILY)
    assert column(out, "close") == [3, None, 3, 3, None, -1]


def test_a_missing_price_keeps_its_place_in_a_sequence(spark):
    by_time = Series(order="date", one_row_per_day=True)
    made = forecast.make_sequences(closes(spark, [0, 1, 2, 3, None, 5, 6]), by_time, 3, "close").orderBy("seq").collect()
    assert [r["features"] for r in made] == [[0, 1, 2], [1, 2, 3], [2, 3, None], [3, None, 5]]
    assert [r["label"] for r in made] == [3, None, 5, 6]


def test_a_frame_longer_than_a_block_raises_whatever_the_data(spark):
    with pytest.raises(ValueError, match="block_rows"):
        technical.sma(closes(spark, [1, 2, 3]), (50,), Series(block_rows=30)).collect()


def test_models_are_of_one_series_and_look_at_the_past_only(spark):
    line = [(k, d, scale * (10 + i)) for k, scale, n in (("A", 1.0, 30), ("B", 1000.0, 20)) for i, d in enumerate(days(n))]
    # What comes after the validation row must not matter.
    bent = [(k, d, p if (k, d) != ("A", days(30)[-1]) else -5.0) for k, d, p in line]
    by_time = Series(order="date", one_row_per_day=True)
    for rows, last in ((line, 4), (bent, 3)):
        prices = spark.createDataFrame(rows, "series_key string, date timestamp, price double")
        for r in forecast.walk_forward_lr(prices, by_time, rows=4).collect():
            if r["fold"] <= last or r["series_key"] == "B":
                assert r["predicted"] == pytest.approx(r["actual"], rel=1e-6)


def test_quotes_and_series_without_a_partner_stay(spark):
    quotes = spark.createDataFrame([("A", 2.0), ("Z", 1.0)], "series_key string, price_usd double")
    made = {r["series_key"]: (r["sign"], r["mean_close"]) for r in profile.quote_vs_mean(quotes, closes(spark, [1, 1])).collect()}
    assert made == {"A": ("+", 1.0), "Z": (None, None)}


@pytest.mark.parametrize("places", [0, 4, 6, 12])
def test_cheap_rounding_is_that_of_decimals(spark, places):
    rng = random.Random(places)
    values = [None, 0.0, -0.0, float("nan"), float("inf"), -1e300, 2.0**53 + 2, 1.005, 2.675, -2.5, 0.5, -0.49999999999999994, 1e-300]
    values += [(rng.randrange(-(10**9), 10**9) + 0.5) / 10**places for _ in range(500)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-14, 15) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    made = rows.select(scalars.round_half_up(F.col("x"), places).alias("made"), F.round("x", places).alias("wanted"))
    assert all(repr(r.made) == repr(r.wanted) for r in made.collect())


def test_short_frames_are_no_sliding_aggregates(spark):
    bars = closes(spark, range(30)).selectExpr("*", "close as open", "close as high", "close as low", "close as volume")
    plan = technical.technical_features(bars, DAILY)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and not re.search(r"RowFrame, -\d+, currentrow", plan)


def test_a_spread_of_equal_values_is_zero(spark):
    bars = closes(spark, [0.1] * 25 + [None] + [0.3] * 25)
    made = column(technical.bollinger(bars), "bb_width")
    assert made[:19] == [None] * 19 and made[19:25] == [0.0] * 6 and made[25:45] == [None] * 20 and made[45:] == [0.0] * 6
