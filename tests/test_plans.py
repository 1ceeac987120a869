"""The plans are the ones meant: few shuffles, pushed filters, no single-partition step."""

from pyspark.sql import functions as F

from tickloom.catalog import tables as t
from tickloom.operators import calendar, clean, technical, validate
from tickloom.plans.flows import feature_table
from tickloom.plans.series import DAILY, Series
from tickloom.sources import payloads

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_table_shuffles_series_once(spark):
    text = plan(feature_table(t.bars_keyed(spark, FOLDER), DAILY))
    assert text.count("Exchange hashpartitioning") == 2  # ticks to bars, bars to series
    assert text.count("Sort [") == 2  # by date for looks, by cell for means and frames
    assert text.count("Window [") <= 8
    assert "SinglePartition" not in text and "PythonUDF" not in text


def test_unused_features_cost_nothing(spark):
    text = plan(feature_table(t.bars_keyed(spark, FOLDER), DAILY).select("series_key", "date", "sma_7"))
    assert "max_by" not in text.split("HashAggregate")[0]


def test_long_series_is_not_gathered(spark):
    series, ticks = Series(block_rows=250), t.ticks(spark, FOLDER)
    for made in (technical.sma(ticks, series=series), clean.interpolate_linear(ticks, ["patchy"], series)):
        text = plan(made)
        assert "SinglePartition" not in text
        shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning(series_key" in line]
        assert shuffles and any("_block" in line for line in shuffles)


def test_calendar_is_a_projection(spark):
    assert "Exchange" not in plan(calendar.calendar_features(t.given(spark, FOLDER, "events"), "ts"))


def test_filter_and_columns_reach_the_scan(spark):
    bars = t.bars_supplier(spark, FOLDER).filter(F.col("series_key") == "3").select("date", "close")
    text = plan(bars)
    assert "l_quantity" not in text and "l_tax" not in text
    one = feature_table(t.bars_keyed(spark, FOLDER), DAILY).filter(F.col("series_key") == "2-HIGH")
    assert "EqualTo(o_orderpriority,2-HIGH)" in plan(one)
    dedup = clean.dedup_keep_last(t.bars_dirty(spark, FOLDER))
    assert "partial_max(struct(seq" in plan(dedup)  # copies collapse before the shuffle
    one_pass = plan(validate.validate_bars(t.bars_supplier(spark, FOLDER), DAILY))
    assert one_pass.count("FileScan") == 1 and one_pass.count("Exchange") <= 3  # bars, cells, series
    history = plan(payloads.market_chart_history(spark.createDataFrame([("A", "{}")], "series_key string, payload string")))
    assert "Window" not in history and "Exchange" not in history
