"""Bar, price, quote and payload tables derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.sources.bars import bars_from_ticks


# The order priorities of the given tables.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bars_daily(spark: SparkSession, folder: str) -> DataFrame:
    """One series over all orders; a daily bar series has at most one row per calendar day."""
    return _order_bars(spark, folder, F.lit("ALL"))


def bars_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """One series per order priority."""
    return _order_bars(spark, folder, F.col("o_orderpriority"))


def _order_bars(spark: SparkSession, folder: str, key) -> DataFrame:
    orders = given(spark, folder, "orders")
    return bars_from_ticks(orders, key, F.to_date("o_orderdate"), F.col("o_totalprice"), F.col("o_orderkey"))


def bars_supplier(spark: SparkSession, folder: str) -> DataFrame:
    """One series per supplier: their number grows with the data."""
    lines = given(spark, folder, "lineitem")
    sequence = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    key = F.col("l_suppkey").cast("string")
    return bars_from_ticks(lines, key, F.to_date("l_shipdate"), F.col("l_extendedprice"), sequence)


def bars_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed bars with faults: zeros, negative lows, missing closes and late corrections of the same day."""
    bars, day = bars_keyed(spark, folder), F.dayofyear("date")
    faulty = bars.select(
        "series_key",
        "date",
        F.lit(0).alias("seq"),
        F.when(day % 29 == 0, 0.0).otherwise(F.col("open")).alias("open"),
        "high",
        F.when(day % 41 == 0, -F.col("low")).otherwise(F.col("low")).alias("low"),
        F.when(day % 17 != 0, F.col("close")).alias("close"),
        F.when(day % 31 == 0, 0.0).otherwise(F.col("volume")).alias("volume"),
    )
    late = bars.filter(day % 23 == 0).select(
        "series_key", "date", F.lit(1).alias("seq"), "open", "high", "low", (F.col("close") + 1).alias("close"), "volume"
    )
    return faulty.unionByName(late)


def bars_hourly(spark: SparkSession, folder: str) -> DataFrame:
    events = given(spark, folder, "events")
    return bars_from_ticks(events, F.col("event_type"), F.date_trunc("hour", "ts"), F.col("value"), F.col("ts"))


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """All events as one long series whose length grows with the data; every seventh close is missing."""
    value = F.col("value")
    return given(spark, folder, "events").select(
        F.lit("ALL").alias("series_key"),
        F.col("ts").alias("date"),
        value.alias("open"),
        (value + 1).alias("high"),
        (value - 1).alias("low"),
        value.alias("close"),
        (F.col("event_id") % 10).cast("double").alias("volume"),
        F.when(F.col("event_id") % 7 != 0, value).alias("patchy"),
    )


def price_series(spark: SparkSession, folder: str) -> DataFrame:
    bars = bars_daily(spark, folder)
    return bars.select("series_key", F.col("date").cast("timestamp").alias("timestamp"), F.col("close").alias("price"))


def price_series_keyed(spark: SparkSession, folder: str) -> DataFrame:
    bars = bars_keyed(spark, folder)
    return bars.select("series_key", F.col("date").cast("timestamp").alias("timestamp"), F.col("close").alias("price"))


def quotes(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "events").select(
        F.col("event_id").alias("quote_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 50 == 0, 0.0).otherwise(F.col("value") * 1000).alias("price_usd"),
    )


def quotes_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes spread over the series of the keyed bars."""
    names = F.array(*[F.lit(name) for name in PRIORITIES])
    return quotes(spark, folder).withColumn("series_key", F.element_at(names, (F.col("quote_id") % 5 + 1).cast("int")))


def quote_records(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes with all recorded fields."""
    value = F.col("value")
    return given(spark, folder, "events").select(
        F.col("ts").alias("timestamp"),
        (value * 1000).alias("price_usd"),
        (value * 10).alias("volume_24h"),
        (value / 100).alias("change_24h"),
        F.date_trunc("second", "ts").alias("last_updated"),
    )


def quote_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Provider payloads in which the optional fields are sometimes absent."""
    number, value = F.col("event_id"), F.col("value")
    fields = F.struct(
        (value * 1000).alias("usd"),
        F.when(number % 7 != 0, value * 10).alias("usd_24h_vol"),
        F.when(number % 11 != 0, value / 100).alias("usd_24h_change"),
        F.when(number % 13 != 0, F.unix_seconds("ts")).alias("last_updated_at"),
    )
    payload = F.to_json(F.struct(fields.alias("coin")))
    return given(spark, folder, "events").select(number.alias("quote_id"), payload.alias("payload"))


def ticker_payloads(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("price_usd").cast("string").alias("price")
    return quotes(spark, folder).select("quote_id", F.to_json(F.struct(price)).alias("payload"))


def chart_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One payload per series and month, landed early on the first day of the next: that day, still unfinished,
    ends the payload and comes again in the one after. A payload never exceeds the days of a month by more."""
    prices = price_series(spark, folder)
    before = F.lag(F.date_trunc("month", "timestamp")).over(Window.partitionBy("series_key").orderBy("timestamp"))
    prices = prices.withColumns({"month": F.date_trunc("month", "timestamp"), "before": before})
    months = F.array("month", F.when(F.col("before") < F.col("month"), F.col("before")))
    landed = prices.withColumn("month", F.explode(F.filter(months, lambda m: m.isNotNull())))
    pair = F.array(F.unix_millis("timestamp").cast("double"), F.col("price"))
    pairs = landed.groupBy("series_key", "month").agg(F.sort_array(F.collect_list(pair)).alias("prices"))
    return pairs.select("series_key", F.to_json(F.struct("prices")).alias("payload"))
