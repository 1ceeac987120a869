"""Cleaning: keep-last de-duplication, positional interpolation, zero repair and their counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import numeric_columns
from tickloom.plans.series import Series, arrange, build_over, known_neighbours
from tickloom.schema import BAR_VALUES, PRICES


def count_duplicates(df: DataFrame, series: Series = Series()) -> DataFrame:
    """Rows whose key and date were already seen, as one row; copies collapse before the shuffle."""
    copies = df.groupBy(*series.keys, series.order).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("duplicates"))


def dedup_keep_last(df: DataFrame, series: Series = Series(), seq: str = "seq") -> DataFrame:
    """Keep the row with the highest ingest sequence per key and date, whole.

    The largest row is taken as one struct, which combines map-side, so a date with many copies never gathers
    in one task. A missing sequence is the lowest. Copies of equal sequence have no last one; of those the row
    with the larger values stays, compared column by column, so the result doesn't depend on how rows arrive.
    """
    identity = [*series.keys, series.order]
    rest = [c for c in df.columns if c not in (*identity, seq)]
    last = F.max(F.struct(seq, *rest)).alias("_last")
    return df.groupBy(*identity).agg(last).select(*identity, "_last.*").select(*df.columns)


def null_census(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``(column_name, nulls)`` for every column that has any."""
    counts = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("nulls"))
        for c in (columns or df.columns)
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts")).filter("nulls > 0")


def interpolate_linear(
    df: DataFrame, columns: Iterable[str] = BAR_VALUES, series: Series = Series()
) -> DataFrame:
    """Fill gaps on a straight line over row positions; a leading gap stays, a trailing gap repeats the last value."""
    columns = list(columns)
    near = known_neighbours(arrange(df, series, number=False), columns)
    filled = {}
    for c in columns:
        prev, nxt = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        share = F.try_divide(prev["steps"], prev["steps"] + nxt["steps"])
        on_line = prev["value"] + (nxt["value"] - prev["value"]) * share
        filled[c] = F.coalesce(F.col(c), on_line, prev["value"])
    return near.withColumns(filled).select(*df.columns)


def invalid_price_census(df: DataFrame, columns: Iterable[str] = PRICES) -> DataFrame:
    """``(column_name, invalid)``: values that are zero or negative, for each price column."""
    counts = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c) <= 0).alias("invalid")) for c in columns
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def zero_to_previous(df: DataFrame, columns: Iterable[str] = PRICES, series: Series = Series()) -> DataFrame:
    """Replace exact zeros by the last non-zero value of the series; negative and missing values stay as they are."""
    columns = list(columns)
    blank = df.withColumns({f"_zero_{c}": F.col(c) == 0 for c in columns})
    blank = blank.withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in columns})
    near = known_neighbours(arrange(blank, series, number=False), columns, after=False)
    filled = {c: F.when(F.col(f"_zero_{c}"), F.col(f"_prev_{c}")["value"]).otherwise(F.col(c)) for c in columns}
    return near.withColumns(filled).select(*df.columns)


def clean_bars(df: DataFrame, series: Series = Series(), seq: str = "seq") -> DataFrame:
    """De-duplicate, interpolate, then repair zeros, in that order; the ingest sequence is consumed."""
    rows = dedup_keep_last(df, series, seq).drop(seq)
    series = series.measured(rows)
    columns = [c for c in numeric_columns(rows) if c not in (*series.keys, series.order)]
    prices = [c for c in PRICES if c in columns]
    return zero_to_previous(interpolate_linear(rows, columns, series), prices, series)


def clean_metrics(raw: DataFrame, series: Series = Series()) -> DataFrame:
    """Rows in, rows out and rows removed by cleaning, in one pass over the raw rows."""
    copies = raw.groupBy(*series.keys, series.order).agg(F.count(F.lit(1)).alias("copies"))
    rows_in, rows_out = F.coalesce(F.sum("copies"), F.lit(0)).cast("long"), F.count(F.lit(1))
    return copies.agg(
        rows_in.alias("rows_in"), rows_out.alias("rows_out"), (rows_in - rows_out).alias("rows_removed")
    )


def sort_by_date(df: DataFrame, series: Series = Series()) -> DataFrame:
    """Add ``row_no``, the 0-based position of each row in its series. Physical order is left to the sink."""
    numbered = build_over(arrange(df, series), lambda d, lane: d.withColumn("row_no", F.col("_rn")))
    return numbered.select(*df.columns, "row_no")


def drop_last_row(df: DataFrame, series: Series = Series()) -> DataFrame:
    """Drop the newest row of every series (the unfinished period)."""

    def build(d: DataFrame, lane) -> DataFrame:
        return d.withColumn("_follows", F.lead(F.lit(True), 1, False).over(lane.window))

    return build_over(arrange(df, series, number=False), build, ahead=1).filter("_follows").select(*df.columns)


def append_row(df: DataFrame, newest: DataFrame) -> DataFrame:
    """Add the current quote(s) to the history; copies are kept."""
    return df.unionByName(newest)
