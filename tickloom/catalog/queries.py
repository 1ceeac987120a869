"""Every operator as a query over the given tables: ``name -> (spark, folder) -> DataFrame``.

Floating results are rounded to the places both engines agree on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.catalog import tables as t
from tickloom.catalog.places import BANDS, EMA, MACD, PLACES, SMA, VOLATILITY, all_to
from tickloom.functions import rolling, scalars
from tickloom.operators import calendar, clean, dataset, ema, forecast, profile, target, technical, validate
from tickloom.plans.flows import feature_table
from tickloom.plans.series import DAILY, Lane, Series, over_series
from tickloom.session import materialise, new_path
from tickloom.sources import payloads, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Results that no closed form in SQL gives; tested against numpy.
WITHOUT_SQL: dict[str, Query] = {}

KEY = ["series_key", "date"]
# Prices by time; a daily price series has at most one row per calendar day.
DAILY_PRICES = Series(order="timestamp", one_row_per_day=True)
# Hourly bars and single ticks prove no bound on a series, so its length is measured.
MEASURED = Series()
# Blocks short enough that the long tick series of the test tables is split; a cluster keeps the default.
# Ticks are read straight from a stored table, which may be read several times.
SPLIT = Series(block_rows=3_000, materialise=False)
SPLIT_PRICES = Series(order="timestamp", block_rows=3_000, materialise=False)


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def query_without_sql(make: Query) -> Query:
    WITHOUT_SQL[make.__name__] = make
    return make


def rounded(df: DataFrame, places: dict[str, int]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: scalars.round_half_up(F.col(c), n) if kinds[c] == "double" else F.round(c, n) for c, n in places.items()})


def features(spark: SparkSession, folder: str) -> DataFrame:
    return feature_table(t.bars_keyed(spark, folder), DAILY)


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    return dataset.prepare_dataset(features(spark, folder), DAILY)


# Sources, sinks, payloads


@query
def scan_parquet(spark, folder):
    path = f"{folder}/orders.parquet"
    return readers.scan_parquet(spark, path).select("o_orderkey", "o_totalprice", "o_orderdate")


@query
def sink_parquet(spark, folder):
    path = writers.sink_parquet(t.bars_keyed(spark, folder), new_path(spark, "bars"))
    return readers.scan_bars(spark, path)


@query
def scan_latest_snapshot(spark, folder):
    place = new_path(spark, "snapshots")
    writers.sink_snapshot(t.bars_daily(spark, folder), place, "bars_historical", "20240101")
    writers.sink_snapshot(t.bars_keyed(spark, folder), place, "bars_historical", "20240102")
    return readers.scan_latest_snapshot(spark, place, "bars_historical", S.BAR_SCHEMA)


@query
def scan_latest_partition(spark, folder):
    """The newest of two days that are partitions of one table."""
    place = new_path(spark, "snapshots")
    writers.sink_snapshot_partition(t.bars_daily(spark, folder), place, "bars_historical", "20240101")
    writers.sink_snapshot_partition(t.bars_keyed(spark, folder), place, "bars_historical", "20240102")
    return readers.scan_latest_snapshot(spark, place, "bars_historical", S.BAR_SCHEMA)


@query
def sma_bucketed(spark, folder):
    """Moving means over a table bucketed by series, without a shuffle of its rows."""
    path = new_path(spark, "bucketed")
    table = writers.sink_bucketed(t.bars_keyed(spark, folder), path.rsplit("/", 1)[1].replace("-", "_"), path, DAILY, buckets=16)
    return rounded(technical.sma(spark.table(table), series=DAILY).select(*KEY, *SMA), {c: PLACES[c] for c in SMA})


@query
def sink_csv(spark, folder):
    path = writers.sink_csv(t.price_series_keyed(spark, folder), new_path(spark, "prices"))
    return readers.scan_csv(spark, path)


@query
def scan_csv(spark, folder):
    prices = t.price_series(spark, folder).select("timestamp", "price")
    path = writers.sink_csv(prices, new_path(spark, "prices"))
    return readers.scan_csv(spark, path, series_key="ALL")


@query
def sink_json_quote(spark, folder):
    path = writers.sink_json_quotes(t.quote_records(spark, folder), new_path(spark, "quotes"))
    return readers.scan_json_quotes(spark, path, lines=True).select("timestamp", "price_usd")


@query
def scan_json_quotes(spark, folder):
    path = writers.sink_json_quotes(t.quote_records(spark, folder), new_path(spark, "quotes"))
    return readers.scan_json_quotes(spark, path, lines=True)


@query
def decode_market_chart(spark, folder):
    return payloads.decode_market_chart(t.chart_payloads(spark, folder)).drop("position")


@query
def market_chart_history(spark, folder):
    return payloads.market_chart_history(t.chart_payloads(spark, folder))


@query
def decode_quote(spark, folder):
    return payloads.decode_quote(t.quote_payloads(spark, folder), "coin")


@query
def decode_ticker(spark, folder):
    return payloads.decode_ticker(t.ticker_payloads(spark, folder))


@query
def require_non_empty(spark, folder):
    return readers.require_non_empty(t.bars_keyed(spark, folder), "bars")


# Series assembly and scalars


@query
def epoch_ms_to_ts(spark, folder):
    events = t.given(spark, folder, "events").select("event_id", F.unix_millis("ts").alias("epoch_ms"))
    return events.select("event_id", scalars.epoch_ms_to_ts(F.col("epoch_ms")).alias("ts"))


@query
def shift_hours(spark, folder):
    return t.given(spark, folder, "events").select("event_id", scalars.shift_hours(F.col("ts"), 1).alias("ts"))


@query
def drop_last_row(spark, folder):
    return clean.drop_last_row(t.price_series_keyed(spark, folder), DAILY_PRICES)


@query
def append_row(spark, folder):
    prices = t.price_series(spark, folder)
    newest = t.quotes(spark, folder).select(
        F.lit("ALL").alias("series_key"), "timestamp", F.col("price_usd").alias("price")
    )
    return clean.append_row(prices, newest)


@query
def round_price(spark, folder):
    events = t.given(spark, folder, "events")
    return events.select("event_id", scalars.round_price(F.col("value") * 0.125).alias("price"))


@query
def cast_datetime(spark, folder):
    text = t.given(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("date"))
    return text.select("o_orderkey", scalars.cast_datetime(F.col("date")).alias("date"))


@query
def sort_by_date(spark, folder):
    return clean.sort_by_date(t.bars_hourly(spark, folder), MEASURED).select(*KEY, "close", "row_no")


# Cleaning


@query
def count_duplicates(spark, folder):
    return clean.count_duplicates(t.bars_dirty(spark, folder))


@query
def dedup_keep_last(spark, folder):
    return clean.dedup_keep_last(t.bars_dirty(spark, folder))


@query
def dedup_ties(spark, folder):
    """Copies that share a sequence, or have none: rows stay whole."""
    rows = t.bars_dirty(spark, folder).withColumn("seq", F.when(F.dayofyear("date") % 2 == 0, F.lit(0)))
    return clean.dedup_keep_last(rows)


@query
def null_census(spark, folder):
    return clean.null_census(t.bars_dirty(spark, folder))


def _deduplicated(spark, folder):
    return clean.dedup_keep_last(t.bars_dirty(spark, folder)).drop("seq")


@query
def interpolate_linear(spark, folder):
    filled = clean.interpolate_linear(_deduplicated(spark, folder), series=DAILY)
    return rounded(filled, {"close": 6})


@query
def invalid_price_census(spark, folder):
    return clean.invalid_price_census(t.bars_dirty(spark, folder))


@query
def zero_to_previous(spark, folder):
    return clean.zero_to_previous(_deduplicated(spark, folder), series=DAILY)


@query
def clean_metrics(spark, folder):
    return clean.clean_metrics(t.bars_dirty(spark, folder))


@query
def clean_bars(spark, folder):
    return rounded(clean.clean_bars(t.bars_dirty(spark, folder), DAILY), {"close": 6})


# Validation


@query
def val_negative(spark, folder):
    return validate.val_negative(t.bars_dirty(spark, folder))


@query
def val_high_low(spark, folder):
    return validate.val_high_low(t.bars_dirty(spark, folder))


@query
def val_date_gap(spark, folder):
    return validate.val_date_gap(_deduplicated(spark, folder), DAILY)


@query
def val_outlier_change(spark, folder):
    return validate.val_outlier_change(_deduplicated(spark, folder), DAILY)


@query
def val_zero_volume(spark, folder):
    return validate.val_zero_volume(t.bars_dirty(spark, folder))


@query
def validate_bars(spark, folder):
    return validate.validate_bars(_deduplicated(spark, folder), DAILY)


@query
def val_verdict(spark, folder):
    return validate.val_verdict(validate.validate_bars(_deduplicated(spark, folder), DAILY))


@query
def val_quote(spark, folder):
    return validate.val_quote(t.quotes(spark, folder))


# Window primitives and technical indicators


def _primitive(make: Callable[[Lane], dict], back: int = 0, ahead: int = 0) -> Query:
    def run(spark, folder):
        bars = t.bars_keyed(spark, folder)
        made = over_series(bars, DAILY, lambda d, lane: d.withColumns(make(lane)), back=back, ahead=ahead)
        return made.drop(*[c for c in bars.columns if c not in KEY])

    return run


QUERIES["rolling_mean"] = _primitive(lambda w: {"mean_5": F.round(rolling.rolling_mean(F.col("close"), 5, w), 6)}, 4)
QUERIES["rolling_std"] = _primitive(lambda w: {"std_5": F.round(rolling.rolling_std(F.col("close"), 5, w), 4)}, 4)
QUERIES["diff"] = _primitive(lambda w: {"change": F.round(rolling.diff(F.col("close"), 1, w), 6)}, 1)
QUERIES["shift"] = _primitive(
    lambda w: {"before": rolling.shift(F.col("close"), 2, w), "after": rolling.shift(F.col("close"), -2, w)}, 2, 2
)
QUERIES["pct_change"] = _primitive(lambda w: {"change": F.round(rolling.pct_change(F.col("close"), 1, w), 8)}, 1)
QUERIES["row_max"] = _primitive(
    lambda w: {"highest": rolling.row_max(rolling.shift(F.col("high"), 1, w), F.col("close"), F.col("open"))}, 1
)
QUERIES["where"] = _primitive(
    lambda w: {"gain": F.round(rolling.where(rolling.diff(F.col("close"), 1, w), rolling.diff(F.col("close"), 1, w) > 0, 0.0), 6)}, 1
)


@query
def ewm_mean(spark, folder):
    made = ema.ewm_mean(t.bars_keyed(spark, folder), {"ewm_5": ("close", 5)}, DAILY)
    return rounded(made, {"ewm_5": 4}).select(*KEY, "ewm_5")


@query
def ewm_mean_gappy(spark, folder):
    """Means over closes of which every seventh day and a whole month a year are missing."""
    bars, day = t.bars_keyed(spark, folder), F.dayofyear("date")
    bars = bars.withColumn("close", F.when((day % 7 != 0) & (F.month("date") != 5), F.col("close")))
    made = ema.ewm_mean(bars, {"ewm_5": ("close", 5), "ewm_26": ("close", 26)}, DAILY, gaps=True)
    return rounded(made, {"ewm_5": 4, "ewm_26": 4}).select(*KEY, "ewm_5", "ewm_26")


@query
def ewm_mean_gappy_long(spark, folder):
    made = ema.ewm_mean(t.ticks(spark, folder).select(*KEY, "patchy"), {"ewm_12": ("patchy", 12)}, SPLIT, gaps=True)
    return rounded(made, {"ewm_12": 6}).select("date", "ewm_12")


def _indicator(operator, columns: list[str]) -> Query:
    def run(spark, folder):
        made = operator(t.bars_keyed(spark, folder), series=DAILY).select(*KEY, *columns)
        return rounded(made, {c: PLACES[c] for c in columns})

    return run


QUERIES["sma"] = _indicator(technical.sma, SMA)
QUERIES["ema"] = _indicator(ema.ema, EMA)
QUERIES["rsi"] = _indicator(technical.rsi, ["rsi_14"])
QUERIES["macd"] = _indicator(technical.macd, MACD)
QUERIES["bollinger"] = _indicator(technical.bollinger, BANDS)
QUERIES["volatility"] = _indicator(technical.volatility, VOLATILITY)
QUERIES["atr"] = _indicator(technical.atr, ["atr_14"])
QUERIES["volume_features"] = _indicator(technical.volume_features, ["volume_sma_20", "volume_ratio"])


@query
def technical_features(spark, folder):
    made = technical.technical_features(t.bars_keyed(spark, folder), DAILY)
    return rounded(made, {c: PLACES[c] for c in S.TECHNICAL})


@query
def technical_by_supplier(spark, folder):
    made = technical.technical_features(t.bars_supplier(spark, folder), DAILY)
    return rounded(made, {c: PLACES[c] for c in S.TECHNICAL}).select(*KEY, *S.TECHNICAL)


# One long series cut into blocks


@query
def sma_long(spark, folder):
    made = technical.sma(t.ticks(spark, folder), series=SPLIT)
    return rounded(made, {c: PLACES[c] for c in SMA}).select("date", *SMA)


@query
def macd_long(spark, folder):
    return rounded(technical.macd(t.ticks(spark, folder), SPLIT), all_to(MACD, 4)).select("date", *MACD)


@query
def interpolate_long(spark, folder):
    filled = clean.interpolate_linear(t.ticks(spark, folder).select(*KEY, "patchy"), ["patchy"], SPLIT)
    return rounded(filled, {"patchy": 6}).select("date", "patchy")


@query
def split_long(spark, folder):
    return dataset.temporal_split(t.ticks(spark, folder).select(*KEY, "close"), SPLIT).select("date", "split")


@query
def targets_long(spark, folder):
    made = target.targets(t.ticks(spark, folder).select(*KEY, "close"), SPLIT)
    return rounded(made, {"target_pct_change": 6}).select("date", *S.TARGETS)


def _tick_prices(spark, folder):
    return t.ticks(spark, folder).select("series_key", F.col("date").alias("timestamp"), F.col("close").alias("price"))


@query
def sequences_long(spark, folder):
    made = forecast.make_sequences(_tick_prices(spark, folder), SPLIT_PRICES)
    return forecast.lag_columns(made).select("seq", "lag_30", "lag_2", "lag_1", "label", "label_time")


# Calendar


@query
def cal_parts(spark, folder):
    return calendar.cal_parts(t.bars_keyed(spark, folder).select(*KEY))


@query
def cal_cyclic(spark, folder):
    return rounded(calendar.cal_cyclic(t.bars_keyed(spark, folder).select(*KEY)), all_to(S.CALENDAR_CYCLES, 12))


@query
def cal_flags(spark, folder):
    return calendar.cal_flags(t.bars_keyed(spark, folder).select(*KEY))


@query
def calendar_features(spark, folder):
    made = calendar.calendar_features(t.given(spark, folder, "events").select("event_id", "ts"), "ts")
    return rounded(made, all_to(S.CALENDAR_CYCLES, 12))


# Targets


@query
def target_next_close(spark, folder):
    return target.target_next_close(t.bars_keyed(spark, folder), DAILY).select(*KEY, "target_next_close")


@query
def target_pct_change(spark, folder):
    made = target.target_pct_change(t.bars_keyed(spark, folder), DAILY)
    return rounded(made, {"target_pct_change": 8}).select(*KEY, "target_pct_change")


@query
def target_direction(spark, folder):
    return target.target_direction(t.bars_keyed(spark, folder), DAILY).select(*KEY, "target_direction")


@query
def forward_return(spark, folder):
    made = target.forward_return(t.bars_keyed(spark, folder), DAILY)
    return rounded(made, {"forward_return": 8}).select(*KEY, "forward_return")


@query
def target_stats(spark, folder):
    made = target.target_stats(target.targets(t.bars_keyed(spark, folder), DAILY))
    return rounded(made, all_to(["mean_next_close", "mean_pct_change", "share_up", "share_down"], 6))


# Data set


def _rounded_features(df: DataFrame) -> DataFrame:
    return rounded(df, {c: n for c, n in PLACES.items() if c in df.columns})


@query
def feature_rows(spark, folder):
    return _rounded_features(features(spark, folder))


@query
def drop_incomplete_rows(spark, folder):
    return _rounded_features(dataset.drop_incomplete_rows(features(spark, folder))).select(*KEY, "sma_200", "rsi_14")


@query
def drop_incomplete_hourly(spark, folder):
    made = dataset.drop_incomplete_rows(feature_table(t.bars_hourly(spark, folder), MEASURED))
    return _rounded_features(made).select(*KEY, "sma_200", "rsi_14")


@query
def select_features(spark, folder):
    return _rounded_features(dataset.select_features(features(spark, folder), DAILY))


@query
def select_features_without_label(spark, folder):
    return _rounded_features(dataset.select_features(features(spark, folder), DAILY, drop_label=True))


@query
def label_column(spark, folder):
    return dataset.label_column(features(spark, folder), DAILY)


@query
def reference_prices(spark, folder):
    return dataset.reference_prices(features(spark, folder), DAILY)


@query
def temporal_split(spark, folder):
    return prepared(spark, folder).select(*KEY, "split")


@query
def split_periods(spark, folder):
    return rounded(dataset.split_periods(prepared(spark, folder), DAILY), {"mean_close": 6})


@query
def write_bundle(spark, folder):
    """The six outputs, side by side again: two of the features, the label and the prices of every row."""
    made = dataset.write_bundle(prepared(spark, folder), new_path(spark, "bundle"), DAILY)
    whole = None
    for split in ("train", "test"):
        x, y, prices = (readers.scan_parquet(spark, made[f"{name}_{split}"]) for name in ("X", "y", "prices"))
        x = x.select(*KEY, "sma_7", "rsi_14", "month", F.lit(len(x.columns) - len(KEY)).alias("features"))
        part = x.join(y, KEY, "full").join(prices, KEY, "full").withColumn("split", F.lit(split))
        whole = part if whole is None else whole.unionByName(part)
    return rounded(whole, {"sma_7": 6, "rsi_14": 6})


# Profiles and reports


@query
def load_summary(spark, folder):
    return rounded(profile.load_summary(t.bars_keyed(spark, folder)), {"mean_close": 6})


@query
def price_report(spark, folder):
    return rounded(profile.price_report(t.bars_keyed(spark, folder)), {"mean_close": 6, "std_close": 4})


@query
def price_report_by_supplier(spark, folder):
    made = profile.price_report(t.bars_supplier(spark, folder), ["series_key"])
    return rounded(made, {"mean_close": 5, "std_close": 4})


@query
def target_profile_by_supplier(spark, folder):
    made = profile.target_profile(target.targets(t.bars_supplier(spark, folder), DAILY), keys=["series_key"])
    return rounded(made, all_to(["mean", "std", "max", "min", "median"], 6))


@query
def target_correlation_by_supplier(spark, folder):
    made = target.targets(t.bars_supplier(spark, folder), DAILY)
    found = profile.target_correlation(made, columns=["open", "close", "volume"], keys=["series_key"])
    return rounded(found, {"correlation": 6})


@query
def validate_by_supplier(spark, folder):
    return validate.validate_bars(t.bars_supplier(spark, folder), DAILY)


@query
def walk_forward_by_supplier(spark, folder):
    bars = t.bars_supplier(spark, folder)
    prices = bars.select("series_key", F.col("date").cast("timestamp").alias("timestamp"), F.col("close").alias("price"))
    return rounded(forecast.walk_forward_ar1(prices, DAILY_PRICES), {"predicted": 3})


@query
def quote_vs_mean(spark, folder):
    made = profile.quote_vs_mean(t.quotes_keyed(spark, folder), t.bars_keyed(spark, folder))
    return rounded(made, {"mean_close": 4, "difference": 4, "percent": 6}).drop("timestamp")


@query
def feature_report(spark, folder):
    made = materialise(features(spark, folder), "features")
    return rounded(profile.feature_report(made, dataset.prepare_dataset(made, DAILY)), {"value": 6})


@query
def rsi_stats(spark, folder):
    return rounded(profile.rsi_stats(technical.rsi(t.bars_keyed(spark, folder), series=DAILY)), all_to(["mean", "min", "max"], 6))


@query
def macd_stats(spark, folder):
    return rounded(profile.macd_stats(technical.macd(t.bars_keyed(spark, folder), DAILY)), {"mean": 4})


@query
def volatility_stats(spark, folder):
    made = profile.volatility_stats(technical.volatility(t.bars_keyed(spark, folder), series=DAILY))
    return rounded(made, all_to(made.columns, 8))


@query
def target_profile(spark, folder):
    made = profile.target_profile(target.targets(t.bars_keyed(spark, folder), DAILY))
    return rounded(made, all_to(["mean", "std", "max", "min", "median"], 6))


@query
def exact_median(spark, folder):
    made = profile.exact_median(t.given(spark, folder, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return rounded(made, {"median": 6})


@query
def exact_median_long(spark, folder):
    lines = t.given(spark, folder, "lineitem")
    return rounded(profile.exact_median(lines, "l_extendedprice", block_rows=SPLIT.block_rows), {"median": 6})


@query
def class_balance(spark, folder):
    labels = dataset.label_column(prepared(spark, folder), DAILY)
    return rounded(profile.class_balance(labels), all_to(["percent_0", "percent_1", "ratio"], 6))


def _train(spark, folder):
    return prepared(spark, folder).filter("split = 'train'")


@query
def describe_features(spark, folder):
    train = _train(spark, folder)
    made = profile.describe_features(train, dataset.feature_names(train, DAILY))
    return rounded(made, all_to(["mean", "std"], 4) | all_to(["min", "max"], 6))


@query
def target_correlation(spark, folder):
    return rounded(profile.target_correlation(features(spark, folder)), {"correlation": 8})


@query
def top_k_correlation(spark, folder):
    made = profile.top_k_correlation(profile.target_correlation(features(spark, folder)))
    return rounded(made, {"correlation": 8})


@query
def nan_census(spark, folder):
    made = features(spark, folder)
    return profile.nan_census(made, dataset.feature_names(made, DAILY))


@query
def inf_census(spark, folder):
    events = t.given(spark, folder, "events")
    risky = events.select("event_id", rolling.ratio(F.col("value"), F.col("event_id") % 5).alias("share"), "value")
    return profile.inf_census(risky)


@query
def duplicate_rows(spark, folder):
    return profile.duplicate_rows(t.given(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_quantity"))


@query
def feature_ranges(spark, folder):
    train = _train(spark, folder)
    made = profile.feature_ranges(train, dataset.feature_names(train, DAILY))
    return rounded(made, all_to(["min", "max"], 6) | all_to(["mean"], 4))


# Sequences and forecasts


@query
def make_sequences(spark, folder):
    made = forecast.make_sequences(t.price_series_keyed(spark, folder), DAILY_PRICES)
    return forecast.lag_columns(made).drop("sequences")


@query
def sequences_gappy(spark, folder):
    """A missing price keeps its place in the sequence."""
    prices = t.price_series_keyed(spark, folder)
    prices = prices.withColumn("price", F.when(F.dayofyear("timestamp") % 7 != 0, F.col("price")))
    return forecast.lag_columns(forecast.make_sequences(prices, DAILY_PRICES, 4), 4).drop("sequences")


@query
def rolling_infinite(spark, folder):
    """Frames over ratios that are infinite here and there: an infinity counts as missing."""
    bars = t.bars_keyed(spark, folder)
    odd = F.when(F.dayofyear("date") % 31 == 0, F.lit(0.0)).otherwise(F.col("volume"))
    bars = bars.withColumn("x", rolling.ratio(F.col("volume"), odd))

    def build(d, lane):
        return d.withColumns({"mean_5": rolling.rolling_mean(F.col("x"), 5, lane), "std_5": rolling.rolling_std(F.col("x"), 5, lane)})

    made = over_series(bars, DAILY, build, back=4).select(*KEY, "mean_5", "std_5")
    return rounded(made, {"mean_5": 8, "std_5": 6})


@query
def minmax_scale(spark, folder):
    return rounded(forecast.scale_held_out(t.price_series_keyed(spark, folder), DAILY_PRICES), {"scaled": 10})


@query
def inverse_minmax(spark, folder):
    held = forecast.scale_held_out(t.price_series_keyed(spark, folder), DAILY_PRICES)
    back = forecast.inverse_minmax(F.col("scaled"), F.col("price_min"), F.col("price_max"))
    return held.select("series_key", "fold", "role", "seq", F.round(back, 6).alias("price"))


@query
def walk_forward_folds(spark, folder):
    sequences = forecast.make_sequences(t.price_series(spark, folder), DAILY_PRICES)
    return forecast.walk_forward_folds(sequences).select("series_key", "seq", "fold", "role")


@query
def walk_forward_folds_stride(spark, folder):
    """Seven folds, twenty sequences apart."""
    sequences = forecast.make_sequences(t.price_series_keyed(spark, folder), DAILY_PRICES)
    return forecast.walk_forward_folds(sequences, 7, 20).select("series_key", "seq", "fold", "role")


@query
def fold_spans(spark, folder):
    """The same folds as intervals, a row per sequence."""
    sequences = forecast.make_sequences(t.price_series_keyed(spark, folder), DAILY_PRICES)
    spans = forecast.fold_spans(sequences, 7, 20)
    return spans.select("series_key", "seq", "train_from", "test_fold", "validation_fold")


@query
def sequence_blocks(spark, folder):
    """What the blocks of one long series hold."""
    made = forecast.sequence_blocks(_tick_prices(spark, folder), SPLIT_PRICES, block=500)
    total = F.aggregate("prices", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return made.select(
        "first", "count", "sequences", F.size("prices").alias("stored"), F.round(total, 4).alias("total"), F.array_max("times").alias("newest")
    )


@query
def walk_forward_stride(spark, folder):
    made = forecast.walk_forward_ar1(t.price_series_keyed(spark, folder), DAILY_PRICES, folds=7, step=20)
    return rounded(made, {"predicted": 4})


@query
def walk_forward_lr_stride(spark, folder):
    made = forecast.walk_forward_lr(t.price_series_keyed(spark, folder), DAILY_PRICES, rows=2, folds=12, step=25)
    return rounded(made, {"predicted": 4})


@query
def walk_forward_lr_long(spark, folder):
    """Forty folds over blocks of one long series."""
    made = forecast.walk_forward_lr(_tick_prices(spark, folder), SPLIT_PRICES, rows=2, folds=40, step=30, block=300)
    return rounded(made.drop("series_key"), {"predicted": 4})


def _forecasts(spark, folder):
    return forecast.walk_forward_ar1(t.price_series_keyed(spark, folder), DAILY_PRICES)


@query
def walk_forward_forecast(spark, folder):
    return rounded(_forecasts(spark, folder), {"predicted": 4})


@query
def walk_forward_long(spark, folder):
    made = forecast.walk_forward_ar1(_tick_prices(spark, folder), SPLIT_PRICES)
    return rounded(made, {"predicted": 6})


@query
def walk_forward_lr(spark, folder):
    """Two lags, whose least squares have a closed form; the whole sequence of 30 is ``walk_forward_lr_whole``."""
    made = forecast.walk_forward_lr(t.price_series_keyed(spark, folder), DAILY_PRICES, rows=2)
    return rounded(made, {"predicted": 4})


@query_without_sql
def walk_forward_lr_whole(spark, folder):
    """The library's default: least squares on the whole sequence of 30."""
    return rounded(forecast.walk_forward_lr(t.price_series_keyed(spark, folder), DAILY_PRICES), {"predicted": 4})


@query
def forecast_error(spark, folder):
    return rounded(forecast.forecast_error(_forecasts(spark, folder)), {"predicted": 4, "error": 4})


@query
def error_summary(spark, folder):
    return rounded(forecast.error_summary(_forecasts(spark, folder)), {"mae": 4, "rmse": 4})


@query
def quote_deviation(spark, folder):
    current = t.price_series_keyed(spark, folder).groupBy("series_key").agg(
        F.max_by("price", "timestamp").alias("current")
    )
    made = forecast.quote_deviation(_forecasts(spark, folder), current, DAILY_PRICES)
    return rounded(made, {"predicted": 4, "percent_off": 6})
