"""Layouts that save reads and shuffles: partitions, buckets, digests, observed counts, side outputs."""

import json

import pytest
from pyspark.sql import functions as F

from tests.frames import closes, days
from tests.test_split import same
from tickloom import schema as S
from tickloom.operators import dataset, profile, technical
from tickloom.plans.flows import run_features
from tickloom.plans.series import DAILY, Series
from tickloom.sources import readers, writers
from tickloom.streaming.quotes import land_quotes, sink_quotes, stream_rejected


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def bars(spark, n, key="A", shift=0.0):
    rows = [(key, d, 1.0 + i + shift, 2.0 + i, 0.5 + i, 1.5 + i + shift, 10.0) for i, d in enumerate(days(n))]
    return spark.createDataFrame(rows, S.BAR_SCHEMA)


def test_newest_partition_is_pruned(spark, tmp_path):
    for day, n in (("20231231", 5), ("20240102", 3), ("20240101", 4)):
        path = writers.sink_snapshot_partition(bars(spark, n), str(tmp_path), "bars", day)
    newest = readers.scan_latest_snapshot(spark, str(tmp_path), "bars", S.BAR_SCHEMA)
    assert newest.count() == 3 and newest.schema.names == S.BAR_SCHEMA.names
    filters = next(line for line in newest._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).splitlines() if "PartitionFilters" in line)
    assert "snapshot_date" in filters and "ubquery" in filters
    read = {f for f in newest.select("_metadata.file_path").distinct().toPandas().iloc[:, 0]} if "_metadata" in newest.columns else set()
    assert all("20240102" in f for f in read)
    # A day is written again, the others stay.
    writers.sink_snapshot_partition(bars(spark, 7), str(tmp_path), "bars", "20231231")
    assert spark.read.parquet(path).count() == 7 + 3 + 4
    # Days as folders of their own are still found.
    writers.sink_snapshot(bars(spark, 2), str(tmp_path), "other", "20240105")
    assert readers.scan_latest_snapshot(spark, str(tmp_path), "other", S.BAR_SCHEMA).count() == 2
    with pytest.raises(FileNotFoundError):
        readers.scan_latest_snapshot(spark, str(tmp_path), "none")


def test_a_bucketed_table_is_read_without_a_shuffle(spark, tmp_path):
    table = bars(spark, 300, "A").union(bars(spark, 250, "B", 5.0)).union(bars(spark, 40, "C", 7.0))
    name = writers.sink_bucketed(table, "bars_by_series", str(tmp_path / "bars"), DAILY, buckets=3)
    try:
        stored = spark.table(name)
        same(technical.sma(stored, series=DAILY), technical.sma(table, series=DAILY))
        for made in (technical.technical_features(stored, DAILY), dataset.temporal_split(stored, DAILY), profile.price_report(stored, keys=["series_key"])):
            assert "Exchange" not in plan(made)
        assert "Exchange" in plan(technical.sma(table, series=DAILY))
    finally:
        spark.sql(f"drop table {name}")


def test_duplicates_by_digest(spark):
    rows = [(1, None, "x"), (None, 1, "x"), (1, None, "x"), (None, None, None), (None, None, None), (2, 2, "y"), (1, None, "x")]
    table = spark.createDataFrame(rows, "_one int, _copies int, s string")
    assert [tuple(r) for r in profile.duplicate_rows(table).collect()] == [(3,)]
    assert profile.duplicate_rows(table.distinct()).first()["duplicates"] == 0
    assert profile.duplicate_rows(table.limit(0)).first()["duplicates"] == 0
    odd = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (1.0,)], "x double")
    assert profile.duplicate_rows(odd).first()["duplicates"] == 2


def test_rows_with_equal_hashes_are_compared(spark, monkeypatch):
    monkeypatch.setattr(profile.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    table = spark.createDataFrame([(1, "a"), (2, "a"), (1, "a"), (3, "b")], "i int, s string")
    assert profile.duplicate_rows(table).first()["duplicates"] == 1


def test_counts_come_from_the_write(spark, tmp_path):
    table = bars(spark, 260).withColumn("seq", F.lit(0))
    raw = table.union(table.filter("close < 5").withColumn("seq", F.lit(1)))
    run = run_features(raw, str(tmp_path / "bundle"), DAILY)
    summary = profile.load_summary(bars(spark, 260)).first()
    assert run.counts["rows_in"] == raw.count() and run.counts["rows_out"] == 260
    assert run.counts["rows_removed"] == raw.count() - 260
    assert (run.counts["first_date"], run.counts["last_date"]) == (days(1)[0], days(260)[-1])
    assert run.counts["mean_close"] == pytest.approx(summary["mean_close"])


def test_documents_that_do_not_parse_go_to_a_side_output(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"quote_{i}.json").write_text(json.dumps({"price_usd": 500.0 * i}, indent=2))
    (folder / "quote_3.json").write_text('{"price_usd": 5')
    out, bad, checkpoint = (str(tmp_path / n) for n in ("out", "bad", "checkpoint"))
    land_quotes(spark, str(folder), out, bad, checkpoint, files_per_batch=2).awaitTermination(60)
    (folder / "quote_4.json").write_text("no quote")
    (folder / "quote_5.json").write_text('{"price_usd": 2000.0}')
    land_quotes(spark, str(folder), out, bad, checkpoint).awaitTermination(60)
    seen = spark.read.parquet(out).orderBy("price_usd").collect()
    assert [(r["price_usd"], r["severity"]) for r in seen] == [(0.0, "error"), (500.0, "warning"), (1000.0, "ok"), (2000.0, "ok")]
    lost = spark.read.parquet(bad).orderBy("file").collect()
    assert [(r["file"], r["document"]) for r in lost] == [("quote_3.json", '{"price_usd": 5'), ("quote_4.json", "no quote")]
    alone = str(tmp_path / "alone")
    sink_quotes(stream_rejected(spark, str(folder)), alone, str(tmp_path / "c2")).awaitTermination(60)
    assert spark.read.parquet(alone).count() == 2
    assert readers.rejected_json_quotes(spark, str(folder)).count() == 2
