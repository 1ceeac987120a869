"""Sinks. Writers create their folders and leave file layout to Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.plans.series import Series
from tickloom.sources.readers import CSV_TIME, SNAPSHOT_DAY


def sink_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def sink_snapshot(df: DataFrame, folder: str, prefix: str, day: str) -> str:
    """Write the snapshot of one day (YYYYMMDD) where ``scan_latest_snapshot`` finds it."""
    return sink_parquet(df, f"{folder}/{prefix}_{day}.parquet")


def sink_snapshot_partition(df: DataFrame, folder: str, prefix: str, day: str) -> str:
    """Write the snapshot of one day (YYYYMMDD) as a partition of the table ``folder/prefix``; other days stay."""
    path = f"{folder}/{prefix}"
    writer = df.withColumn(SNAPSHOT_DAY, F.lit(int(day))).write.mode("overwrite").partitionBy(SNAPSHOT_DAY)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def sink_bucketed(df: DataFrame, table: str, path: str, series: Series = Series(), buckets: int = 200) -> str:
    """Write ``path`` as the catalog's ``table``, its rows dealt to ``buckets`` by the series' keys and sorted in them.

    Whatever runs per series over that table (windows, splits, profiles by key) reads it without a shuffle. Every bucket is one
    file, written by one task; use at least as many as there are cores, and so many that a bucket fits a task.
    """
    keys = list(series.keys)
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, series.order, *series.ties)
    writer.format("parquet").option("path", path).saveAsTable(table)
    return table


def sink_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("timestampFormat", CSV_TIME).csv(path)
    return path


def sink_json_quotes(quotes: DataFrame, path: str) -> str:
    """One JSON document per line and quote, times as strings with their full precision."""
    text = [
        F.date_format(f.name, CSV_TIME).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in quotes.schema
    ]
    quotes.select(text).write.mode("append").json(path)
    return path
