"""Validation, data set preparation and the composed flows."""

import pytest
from pyspark.sql import functions as F

from tests.frames import closes, random_bars
from tickloom import schema as S
from tickloom.operators import dataset, forecast, profile, validate
from tickloom.plans.flows import compare_quotes, feature_table, ingest, run_features, save_prices
from tickloom.plans.series import Series
from tickloom.sources.readers import scan_csv


@pytest.fixture(scope="module")
def features(spark):
    return feature_table(spark.createDataFrame(random_bars({"a": 300, "b": 450, "c": 50}))).cache()


def rules(df):
    return {(r["series_key"], r["rule"]): (r["violations"], r["passed"]) for r in df.collect()}


def test_rules(spark):
    bad = spark.createDataFrame(random_bars({"good": 30, "bad": 30})).withColumn("volume", F.lit(5.0))
    broken = F.col("series_key") == "bad"
    bad = bad.withColumns(
        {
            "low": F.when(broken & (F.col("close") > 0), -F.col("low")).otherwise(F.col("low")),
            "high": F.when(broken, F.col("low") - 1).otherwise(F.col("high")),
            "volume": F.when(broken, 0.0).otherwise(F.col("volume")),
        }
    )
    found = rules(validate.validate_bars(bad))
    assert len(found) == 10
    assert found["good", "negative"] == (0, True) and found["bad", "negative"] == (30, False)
    assert found["bad", "zero_volume"] == (30, False)
    for rule in (validate.val_negative, validate.val_high_low, validate.val_zero_volume, validate.val_date_gap, validate.val_outlier_change):
        assert rules(rule(bad)).items() <= found.items()
    verdict = {r["series_key"]: (r["errors"], r["valid"]) for r in validate.val_verdict(validate.validate_bars(bad)).collect()}
    assert verdict["good"] == (0, True) and verdict["bad"][1] is False
    with pytest.raises(ValueError, match="validation failed"):
        ingest(bad)


def test_limits_are_inclusive(spark):
    zero = closes(spark, range(1, 14)).withColumn("volume", F.when(F.col("close") <= 10, 0.0).otherwise(1.0))
    assert rules(validate.val_zero_volume(zero))["A", "zero_volume"] == (10, True)
    gap = closes(spark, [1, 2]).withColumn("date", F.when(F.col("close") == 2, F.expr("date + interval 71 hours")).otherwise(F.col("date")))
    assert rules(validate.val_date_gap(gap))["A", "date_gap"] == (3, True)
    wider = gap.withColumn("date", F.when(F.col("close") == 2, F.expr("date + interval 1 hour")).otherwise(F.col("date")))
    assert rules(validate.val_date_gap(wider))["A", "date_gap"] == (4, False)
    assert rules(validate.val_date_gap(closes(spark, [1])))["A", "date_gap"] == (0, True)


def test_outliers_skip_missing_closes(spark):
    steps = closes(spark, [100, None, 160, 0, None, 0, 5])
    assert rules(validate.val_outlier_change(steps))["A", "outlier_change"] == (3, False)
    copies = steps.unionByName(steps).unionByName(steps)
    assert rules(validate.val_outlier_change(copies))["A", "outlier_change"] == (3, False)
    assert rules(validate.val_date_gap(copies))["A", "date_gap"] == (1, True)
    assert rules(validate.val_outlier_change(closes(spark, [None])))["A", "outlier_change"] == (0, True)


def test_quote_severity(spark):
    quotes = spark.createDataFrame([(0.0,), (-1.0,), (999.0,), (1000.0,), (500000.0,), (500000.5,)], "price_usd double")
    found = [r["severity"] for r in validate.val_quote(quotes).collect()]
    assert found == ["error", "error", "warning", "ok", "ok", "warning"]


def test_feature_columns(features):
    assert len(S.TECHNICAL) == 21 and len(S.CALENDAR) == 15
    names = dataset.feature_names(features)
    assert len(names) == 37 and "target_direction" in names
    assert "target_direction" not in dataset.feature_names(features, drop_label=True)
    assert dataset.label_column(features).columns == ["series_key", "date", "target"]


def test_split_is_chronological_and_complete(features):
    prepared = dataset.prepare_dataset(features)
    kept = dataset.drop_incomplete_rows(features)
    per_key = {r["series_key"]: r["count"] for r in kept.groupBy("series_key").count().collect()}
    assert per_key.keys() == {"a", "b"}
    for key, n in per_key.items():
        parts = {
            r["split"]: r for r in prepared.filter(F.col("series_key") == key).groupBy("split").agg(
                F.count("*").alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
            ).collect()
        }
        assert parts["train"]["n"] == int(n * 0.8) and parts["train"]["n"] + parts["test"]["n"] == n
        assert parts["train"]["hi"] < parts["test"]["lo"]


def test_infinite_values_are_kept(spark):
    table = spark.createDataFrame([(float("inf"),), (None,), (1.0,)], "x double")
    assert dataset.drop_incomplete_rows(table).count() == 2


def test_price_file_and_quotes(spark, tmp_path):
    prices = closes(spark, [1.005, 2.675]).select("series_key", F.col("date").alias("timestamp"), F.col("close").alias("price"))
    newest = prices.orderBy("timestamp").limit(1).withColumn("price", F.lit(0.125))
    path = save_prices(prices, newest, str(tmp_path / "prices"))
    assert sorted(r["price"] for r in scan_csv(spark, path).collect()) == [0.12, 1.0, 2.68]
    with pytest.raises(ValueError, match="history has no rows"):
        save_prices(prices.filter("price < 0"), newest, path)
    quotes = spark.createDataFrame([("A", 2000.0), ("A", 900.0)], "series_key string, price_usd double")
    made = {r["severity"]: r["sign"] for r in compare_quotes(quotes, closes(spark, [1000.0])).collect()}
    assert made == {"ok": "+", "warning": "-"}
    with pytest.raises(ValueError, match="invalid quotes"):
        compare_quotes(quotes.withColumn("price_usd", F.lit(0.0)), closes(spark, [1000.0]))


def test_whole_flow(spark, tmp_path):
    raw = spark.createDataFrame(random_bars({"a": 400, "b": 260})).withColumn("seq", F.lit(0))
    late = raw.filter("volume > 40").withColumns({"seq": F.lit(1), "close": F.lit(None).cast("double")})
    run = run_features(raw.unionByName(late), str(tmp_path / "bundle"))
    assert set(run.bundle) == {f"{n}_{s}" for n in ("X", "y", "prices") for s in ("train", "test")}
    sizes = {name: spark.read.parquet(path).count() for name, path in run.bundle.items()}
    assert sizes["X_train"] == sizes["y_train"] == sizes["prices_train"] > sizes["X_test"] > 0
    assert run.features.count() == 660
    x = spark.read.parquet(run.bundle["X_train"]).join(spark.read.parquet(run.bundle["y_train"]), ["series_key", "date"])
    assert x.filter("target <> target_direction").count() == 0
    report = {r["metric"]: r["value"] for r in profile.feature_report(run.features, run.prepared).collect()}
    assert report["features"] == 37 and report["train_rows"] == sizes["X_train"]


def test_folds_and_short_series(spark):
    prices = closes(spark, range(1, 21)).select("series_key", F.col("date").alias("timestamp"), F.col("close").alias("price"))
    by_time = Series(order="timestamp")
    sequences = forecast.make_sequences(prices, by_time, rows=4)
    assert sequences.count() == 16
    first = sequences.orderBy("seq").first()
    assert (first["features"], first["label"]) == ([1.0, 2.0, 3.0, 4.0], 5.0)
    folds = forecast.walk_forward_folds(sequences)
    roles = {(r["fold"], r["role"]): r["count"] for r in folds.groupBy("fold", "role").count().collect()}
    assert [roles[f, "train"] for f in range(5)] == [10, 11, 12, 13, 14]
    assert all(roles[f, role] == 1 for f in range(5) for role in ("test", "validation"))
    line = forecast.walk_forward_ar1(prices, by_time, rows=4).orderBy("fold").collect()
    assert [r["actual"] for r in line] == [16.0, 17.0, 18.0, 19.0, 20.0]
    assert [r["predicted"] for r in line] == [pytest.approx(v) for v in (16, 17, 18, 19, 20)]
    wide = forecast.walk_forward_lr(prices, by_time, rows=4).orderBy("fold").collect()
    assert [r["predicted"] for r in wide] == [pytest.approx(v, rel=1e-4) for v in (16, 17, 18, 19, 20)]
    short = prices.filter("price <= 6")
    assert forecast.walk_forward_ar1(short, by_time, rows=4).count() == 0
    assert forecast.scale_held_out(short, by_time, rows=4).count() == 0
    errors = forecast.error_summary(forecast.walk_forward_ar1(prices, by_time, rows=4), by_time).first()
    assert errors["folds"] == 5 and errors["mae"] == pytest.approx(0, abs=1e-9)


def test_constant_prices_forecast_the_constant(spark):
    prices = closes(spark, [5] * 20).select("series_key", F.col("date").alias("timestamp"), F.col("close").alias("price"))
    made = forecast.walk_forward_ar1(prices, Series(order="timestamp"), rows=4).collect()
    assert [r["predicted"] for r in made] == [5.0] * 5
