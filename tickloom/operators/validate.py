"""Validation rules. Each gives one row per series: rule, severity, violations, passed."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.rolling import shift
from tickloom.plans.series import Lane, Series, over_series, whole_lane
from tickloom.schema import BAR_VALUES

# Limits of the rules.
MAX_GAP_DAYS = 3
MAX_CHANGE = 0.5
MAX_ZERO_VOLUME_ROWS = 10
QUOTE_RANGE = (1_000, 500_000)

MICROS_PER_DAY = 86_400_000_000


def _rule(df: DataFrame, series: Series, name: str, severity: str, violations: Column, limit: int) -> DataFrame:
    counted = df.groupBy(*series.keys).agg(F.coalesce(violations, F.lit(0)).cast("long").alias("violations"))
    return counted.select(
        *series.keys,
        F.lit(name).alias("rule"),
        F.lit(severity).alias("severity"),
        "violations",
        (F.col("violations") <= limit).alias("passed"),
    )


def _is_negative() -> Column:
    return F.least(*BAR_VALUES) < 0


def val_negative(df: DataFrame, series: Series = Series()) -> DataFrame:
    return _rule(df, series, "negative", "error", F.count_if(_is_negative()), 0)


def val_high_low(df: DataFrame, series: Series = Series()) -> DataFrame:
    return _rule(df, series, "high_low", "error", F.count_if(F.col("high") < F.col("low")), 0)


def val_zero_volume(df: DataFrame, series: Series = Series()) -> DataFrame:
    zero = F.count_if(F.col("volume") == 0)
    return _rule(df, series, "zero_volume", "error", zero, MAX_ZERO_VOLUME_ROWS)


def _gap(df: DataFrame, order: str, lane: Lane) -> Column:
    """Whole days since the row before."""
    before, now = shift(F.col(order), 1, lane), F.col(order)
    if isinstance(df.schema[order].dataType, T.DateType):
        return F.datediff(now, before)
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(before.cast("timestamp"))
    return F.floor(micros / MICROS_PER_DAY)


def _is_outlier(before: Column, now: Column) -> Column:
    return ((before == 0) & (now != 0)) | (F.abs(F.try_divide(now, before) - 1) > MAX_CHANGE)


def val_date_gap(df: DataFrame, series: Series = Series()) -> DataFrame:
    """``violations`` is the widest gap between neighbouring dates, in whole days.

    Rows of a day collapse map-side to the first and the last moment of it, as no gap inside a day is a whole one. So a series of
    any length has at most a row per calendar day when it is looked at in order.
    """
    order = series.order
    kind = df.schema[order].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType)):
        raise TypeError(f"{order} is no date")
    moment = F.unix_micros(F.col(order).cast("timestamp"))
    days = df.groupBy(*series.keys, F.floor(moment / MICROS_PER_DAY).alias("_day")).agg(
        F.min(moment).alias("_first"), F.max(moment).alias("_last")
    )
    earlier = F.lag("_last").over(Window.partitionBy(*series.keys).orderBy(F.col("_day").asc_nulls_last()))
    gaps = days.withColumn("gap", F.floor((F.col("_first") - earlier) / MICROS_PER_DAY))
    return _rule(gaps, series, "date_gap", "warning", F.max("gap"), MAX_GAP_DAYS)


def val_outlier_change(df: DataFrame, series: Series = Series()) -> DataFrame:
    """Changes above 50 % between neighbouring known closes; missing closes repeat the one before, so they never count.

    Closes of the same date follow each other by size, copies among them counting once. Where a series may be longer than a block,
    rows are dealt to tasks by range, once, and every task reduces its stretch of a series to its first and last close and
    its count; stretches are then joined in order (``_stretches``).
    """
    known = df.select(*series.keys, series.order, "close").filter(F.col("close").isNotNull())
    if series.bounded:
        def build(d: DataFrame, lane: Lane) -> DataFrame:
            return d.withColumn("outlier", _is_outlier(shift(F.col("close"), 1, lane), F.col("close")))

        flagged = over_series(known.distinct(), replace(series, ties=("close",)), build, back=1)
        found = _rule(flagged, series, "outlier_change", "warning", F.count_if("outlier"), 0)
    else:
        before = F.lag("last").over(Window.partitionBy(*series.keys).orderBy("slice"))
        joined = _stretches(known, series).withColumn("between", _is_outlier(before, F.col("first")))
        found = _rule(joined, series, "outlier_change", "warning", F.sum("inside") + F.count_if("between"), 0)
    silent = df.groupBy(*series.keys).agg(F.count("close").alias("known")).filter("known = 0")
    return found.unionByName(_rule(silent, series, "outlier_change", "warning", F.lit(0), 0))


def _stretches(known: DataFrame, series: Series) -> DataFrame:
    """keys, slice, first and last close and the outliers inside, of every stretch of a series that lies in one task.

    Changes are independent of where stretches are cut: the two sides of a cut are the last close of one and the first of the next.
    """
    keys = list(series.keys)
    kinds = "".join(f"`{k}` {known.schema[k].dataType.simpleString()}, " for k in keys)
    names = [*keys, "slice", "first", "last", "inside"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, types = TaskContext.get().partitionId(), []
        now, first, last, inside = None, 0.0, 0.0, 0

        def row() -> pa.RecordBatch:
            values = [*now, place, first, last, inside]
            made = [*types, pa.int32(), pa.float64(), pa.float64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, made)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.schema.field(k).type for k in keys]
            close = batch.column("close").to_numpy()
            cuts = _changes([batch.column(k) for k in keys], len(close))
            total = np.concatenate([[0], np.cumsum(_jumps(close[:-1], close[1:]))])
            for low, high in zip(cuts, cuts[1:]):
                key = tuple(batch.column(k)[low].as_py() for k in keys)
                if now != key:
                    if now is not None:
                        yield row()
                    now, first, inside = key, float(close[low]), 0
                else:
                    inside += int(_jumps(np.array([last]), close[low : low + 1])[0])
                inside += int(total[high - 1] - total[low])
                last = float(close[high - 1])
        if now is not None:
            yield row()

    order = [*map(F.col, keys), *replace(series, ties=("close",)).ordering]
    dealt = known.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = dealt.select(*keys, F.col("close").cast("double").alias("close"))
    return stored.mapInArrow(run, f"{kinds}slice int, first double, last double, inside long")


def _jumps(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """``_is_outlier`` of arrays; what is no number counts, as it does there."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(before == 0, after != 0, ~(np.abs(after / before - 1) <= MAX_CHANGE))


def _changes(columns: list[pa.Array], rows: int) -> list[int]:
    """0, the places where any of the columns differs from the row before (nulls are equal), and ``rows``."""
    differs = np.zeros(max(0, rows - 1), bool)
    for c in columns:
        codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy()
        differs |= codes[1:] != codes[:-1]
    return [0, *(np.flatnonzero(differs) + 1).tolist(), rows]


def validate_bars(df: DataFrame, series: Series = Series()) -> DataFrame:
    """All rules, from one read of the rows.

    Rows of the same date and close collapse map-side to their counts; one window per series then looks at the
    date and the known close before, and one aggregate over the same partitions counts all five rules. Where
    some series have to be split, the rules on neighbours run block by block instead.
    """
    keys, order = list(series.keys), series.order
    series = series.measured(df)
    cells = df.groupBy(*keys, order, "close").agg(
        F.count_if(_is_negative()).alias("negative"),
        F.count_if(F.col("high") < F.col("low")).alias("high_low"),
        F.count_if(F.col("volume") == 0).alias("zero_volume"),
    )
    errors = {
        "negative": (F.sum("negative"), 0),
        "high_low": (F.sum("high_low"), 0),
        "zero_volume": (F.sum("zero_volume"), MAX_ZERO_VOLUME_ROWS),
    }
    if not series.bounded:
        single = _rules(cells, series, {n: ("error", *rule) for n, rule in errors.items()})
        return reduce(DataFrame.unionByName, [single, val_date_gap(df, series), val_outlier_change(df, series)])
    lane = whole_lane(replace(series, ties=("close",)))
    earlier = lane.window.rowsBetween(Window.unboundedPreceding, -1)
    seen = cells.withColumns(
        {"gap": _gap(df, order, lane), "outlier": _is_outlier(F.last("close", True).over(earlier), F.col("close"))}
    )
    rules = {n: ("error", *rule) for n, rule in errors.items()}
    rules["date_gap"] = ("warning", F.max("gap"), MAX_GAP_DAYS)
    rules["outlier_change"] = ("warning", F.count_if("outlier"), 0)
    return _rules(seen, series, rules)


def _rules(df: DataFrame, series: Series, rules: dict[str, tuple[str, Column, int]]) -> DataFrame:
    """Several rules of one aggregate, a row per series and rule."""
    counted = df.groupBy(*series.keys).agg(
        *(F.coalesce(violations, F.lit(0)).cast("long").alias(name) for name, (_, violations, _) in rules.items())
    )
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.lit(severity).alias("severity"),
            F.col(name).alias("violations"),
            (F.col(name) <= limit).alias("passed"),
        )
        for name, (severity, _, limit) in rules.items()
    ]
    return counted.select(*series.keys, F.inline(F.array(*rows)))


def val_verdict(rules: DataFrame, series: Series = Series()) -> DataFrame:
    """Per series: number of failed errors and warnings; only errors decide ``valid``."""
    failed = ~F.col("passed")
    counted = rules.groupBy(*series.keys).agg(
        F.count_if(failed & (F.col("severity") == "error")).alias("errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
    )
    return counted.withColumn("valid", F.col("errors") == 0)


def require_valid(rules: DataFrame, shown: int = 20) -> DataFrame:
    """Raise when any error rule failed; the message names the first few, the check covers all."""
    failed = rules.filter((F.col("severity") == "error") & ~F.col("passed"))
    first = failed.take(shown)
    if first:
        raise ValueError("validation failed: " + "; ".join(str(row.asDict()) for row in first))
    return rules


def require_valid_quotes(quotes: DataFrame, price: str = "price_usd", shown: int = 20) -> DataFrame:
    """Raise when any quote is an error; the message names the first few, the check covers all."""
    flagged = val_quote(quotes, price)
    first = flagged.filter(F.col("severity") == "error").take(shown)
    if first:
        raise ValueError("invalid quotes: " + "; ".join(str(row.asDict()) for row in first))
    return flagged


def val_quote(quotes: DataFrame, price: str = "price_usd") -> DataFrame:
    """Add ``severity``: error for a price of zero or less, warning outside the plausible range."""
    value, (low, high) = F.col(price), QUOTE_RANGE
    severity = (
        F.when(value.isNull() | (value <= 0), "error")
        .when((value < low) | (value > high), "warning")
        .otherwise("ok")
    )
    return quotes.withColumn("severity", severity)
