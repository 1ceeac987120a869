"""Sources, sinks and payload decoders."""

import datetime as dt
import json

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.frames import closes, random_bars
from tickloom import schema as S
from tickloom.operators import clean
from tickloom.plans import flows
from tickloom.schema import BAR_SCHEMA
from tickloom.sources import payloads, readers, writers
from tickloom.streaming.quotes import sink_quotes, stream_quotes


def test_nanosecond_parquet_and_nan(spark, tmp_path):
    stamps = pd.to_datetime(["2024-01-01 00:00:00.123456789", "1969-12-31 23:59:59.999999999"]).astype("datetime64[ns]")
    frame = pd.DataFrame({"Date": stamps, "Close": [1.5, np.nan], "VOLUME": [3, 4]})
    path = str(tmp_path / "bars.parquet")
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=False), path, coerce_timestamps=None, version="2.6")
    with pytest.raises(ValueError, match="open"):
        readers.scan_bars(spark, path, series_key="A")
    bars = readers.scan_parquet(spark, path, BAR_SCHEMA, optional=["series_key", "open", "high", "low"]).orderBy("date").collect()
    assert bars[1]["date"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    assert bars[0]["date"] == dt.datetime(1969, 12, 31, 23, 59, 59, 999999)
    assert bars[0]["close"] is None and bars[0]["open"] is None and bars[0]["volume"] == 4.0


def test_parquet_round_trip(spark, tmp_path):
    bars = spark.createDataFrame(random_bars({"a": 20, "b": 5}))
    path = writers.sink_parquet(bars, str(tmp_path / "out"), ("series_key",))
    back = readers.scan_bars(spark, path)
    assert back.exceptAll(bars.select(back.columns)).count() == 0 and back.count() == 25
    plan = back.filter("series_key = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(series_key" in plan


def test_conditions_on_doubles_reach_the_files(spark):
    made = readers.scan_parquet(spark, "/root/testdata/sf0.001/orders.parquet", where="o_totalprice > 1000")
    plan = made.select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,1000" in plan and "o_comment" not in plan


def test_ingest_order_is_file_then_place(spark, tmp_path):
    for day, closes_of_file in (("a", [1.0, 2.0]), ("b", [3.0])):
        bars = random_bars({"s": 1}).head(1)
        pd.concat([bars.assign(close=c) for c in closes_of_file]).to_parquet(tmp_path / f"{day}.parquet")
    bars = readers.scan_bars(spark, str(tmp_path), ingest_order="seq")
    assert [r["close"] for r in clean.dedup_keep_last(bars).collect()] == [3.0]
    first = bars.filter("close < 3")
    assert [r["close"] for r in clean.dedup_keep_last(first).collect()] == [2.0]


def test_broken_quote_files_raise_and_are_listed(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"price_usd": 1.5}')
    (tmp_path / "bad.json").write_text('{"price_usd": 1.')
    with pytest.raises(Exception):
        readers.scan_json_quotes(spark, str(tmp_path)).collect()
    assert [r["file"] for r in readers.rejected_json_quotes(spark, str(tmp_path)).collect()] == ["bad.json"]


def test_a_snapshot_being_written_is_not_taken(spark, tmp_path):
    writers.sink_snapshot(closes(spark, [1]), str(tmp_path), "bars", "20240105")
    half = tmp_path / "bars_20240106.parquet"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"")
    assert readers.latest_snapshot(spark, str(tmp_path), "bars").endswith("bars_20240105.parquet")


def test_from_price_file_to_deviation(spark, tmp_path):
    days = pd.date_range("2024-01-01", periods=20)
    prices = pd.DataFrame({"series_key": "A", "timestamp": days, "price": [100.0 + 2 * i for i in range(20)]})
    path = writers.sink_csv(spark.createDataFrame(prices), str(tmp_path / "prices"))
    quotes = spark.createDataFrame([("A", 140.0), ("B", 1.0)], "series_key string, current double")
    run = flows.run_forecast(spark, path, quotes, rows=3, folds=2)
    made = run.forecasts.orderBy("fold").collect()
    assert [round(r["predicted"], 6) for r in made] == [136.0, 138.0] and all(abs(r["error"]) < 1e-6 for r in made)
    assert run.errors.first()["folds"] == 2
    off = {r["series_key"]: r["percent_off"] for r in run.deviation.collect()}
    assert abs(off["A"] - 2 / 140 * 100) < 1e-6 and off["B"] is None


def test_latest_snapshot(spark, tmp_path):
    for day, value in (("20240105", 1), ("20241201", 2), ("20240930", 3)):
        writers.sink_snapshot(closes(spark, [value]), str(tmp_path), "bars_historical", day)
    writers.sink_snapshot(closes(spark, [9]), str(tmp_path), "other", "20990101")
    newest = readers.scan_latest_snapshot(spark, str(tmp_path), "bars_historical")
    assert [r["close"] for r in newest.collect()] == [2.0]


def test_latest_snapshot_of_single_files(spark, tmp_path):
    for day in ("20240105", "20240106"):
        pd.DataFrame({"close": [float(day)]}).to_parquet(tmp_path / f"bars_{day}.parquet")
    assert readers.latest_snapshot(spark, str(tmp_path), "bars").endswith("bars_20240106.parquet")


def test_no_snapshot_raises(spark, tmp_path):
    (tmp_path / "readme.txt").write_text("nothing here")
    with pytest.raises(FileNotFoundError):
        readers.latest_snapshot(spark, str(tmp_path), "bars")


def test_csv_round_trip_keeps_microseconds(spark, tmp_path):
    rows = [("A", dt.datetime(2024, 1, 1, 12, 46, 10, 310782), 90947.98), ("A", dt.datetime(2024, 1, 2), 0.1)]
    prices = spark.createDataFrame(rows, S.PRICE_SCHEMA)
    path = writers.sink_csv(prices, str(tmp_path / "csv"))
    assert sorted(map(tuple, readers.scan_csv(spark, path).collect())) == rows


def test_csv_of_the_fetcher(spark, tmp_path):
    (tmp_path / "prices.csv").write_text("timestamp,price\n2023-11-19 01:00:00.000000,36582.37\n2023-11-20 01:00:00,\n")
    rows = readers.scan_csv(spark, str(tmp_path / "prices.csv"), "A").orderBy("timestamp").collect()
    assert [tuple(r) for r in rows] == [("A", dt.datetime(2023, 11, 19, 1), 36582.37), ("A", dt.datetime(2023, 11, 20, 1), None)]
    (tmp_path / "broken.csv").write_text("timestamp,price\nyesterday,1\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.scan_csv(spark, str(tmp_path / "broken.csv"), "A").collect()


def test_quote_files_one_indented_document_each(spark, tmp_path):
    for i in range(3):
        quote = {
            "timestamp": f"2024-01-0{i + 1} 10:00:00.500000",
            "price_usd": 500.0 * i,
            "volume_24h": 1.0,
            "change_24h": -0.5,
            "last_updated": "2024-01-01 00:00:00",
        }
        (tmp_path / f"quote_{i}.json").write_text(json.dumps(quote, indent=2))
    quotes = readers.scan_json_quotes(spark, str(tmp_path)).orderBy("timestamp").collect()
    assert [q["price_usd"] for q in quotes] == [0.0, 500.0, 1000.0]
    assert quotes[0]["timestamp"] == dt.datetime(2024, 1, 1, 10, 0, 0, 500000)

    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    sink_quotes(stream_quotes(spark, f"{tmp_path}/quote_*.json"), out, checkpoint).awaitTermination(60)
    (tmp_path / "quote_9.json").write_text(json.dumps({"price_usd": 2000.0}, indent=2))
    sink_quotes(stream_quotes(spark, f"{tmp_path}/quote_*.json"), out, checkpoint).awaitTermination(60)
    seen = spark.read.parquet(out).orderBy("price_usd").collect()
    assert [(r["price_usd"], r["severity"]) for r in seen] == [
        (0.0, "error"), (500.0, "warning"), (1000.0, "ok"), (2000.0, "ok"),
    ]


def test_json_lines_round_trip(spark, tmp_path):
    moment = dt.datetime(2024, 5, 1, 1, 2, 3, 4)
    quotes = spark.createDataFrame([(moment, 1.25, 2.0, None, moment)], S.QUOTE_SCHEMA)
    path = writers.sink_json_quotes(quotes, str(tmp_path / "quotes"))
    assert readers.scan_json_quotes(spark, path, lines=True).collect() == quotes.collect()


def test_market_chart(spark):
    text = json.dumps({"prices": [[1704067200000, 10.5], [1704153600000, 11], [1704160000000, 12.25]]})
    rows = spark.createDataFrame([("A", text)], "series_key string, payload string")
    pairs = payloads.decode_market_chart(rows).orderBy("position").collect()
    assert [p["price"] for p in pairs] == [10.5, 11.0, 12.25]
    with pytest.raises(Exception, match="no prices in"):
        payloads.decode_market_chart(rows.withColumn("payload", F.lit("{}"))).collect()
    history = payloads.market_chart_history(rows).orderBy("timestamp").collect()
    assert [h["timestamp"] for h in history] == [dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 2, 1)]


def test_quote_defaults_and_rejects(spark):
    rows = spark.createDataFrame(
        [(1, '{"bitcoin": {"usd": 5.5}}'), (2, '{"ether": {"usd": 1}}'), (3, "not json")], "i int, payload string"
    )
    kept = payloads.decode_quote(rows, "bitcoin", on_missing="drop").collect()
    assert [tuple(r) for r in kept] == [(1, 5.5, 0.0, 0.0, dt.datetime(1970, 1, 1))]
    assert sorted(r["i"] for r in payloads.rejected_quotes(rows, "bitcoin").collect()) == [2, 3]
    with pytest.raises(Exception, match="no quote of bitcoin"):
        payloads.decode_quote(rows, "bitcoin").collect()


def test_ticker(spark):
    rows = spark.createDataFrame([(1, '{"price": "64000.10"}'), (2, '{"price": "x"}')], "i int, payload string")
    assert [r["price"] for r in payloads.decode_ticker(rows, on_missing="drop").collect()] == [64000.1]
    with pytest.raises(Exception, match="no price in"):
        payloads.decode_ticker(rows).collect()


def test_empty_input_raises(spark):
    with pytest.raises(ValueError, match="bars has no rows"):
        readers.require_non_empty(closes(spark, [1]).filter(F.lit(False)), "bars")
