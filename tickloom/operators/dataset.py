"""From the feature table to a chronological train/test bundle."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampType

from tickloom.operators.selection import ordered_bits, select_by_bits
from tickloom.plans.series import Series, arrange, list_long, lookup
from tickloom.schema import LABEL, NOT_FEATURES
from tickloom.session import materialise


def drop_incomplete_rows(df: DataFrame) -> DataFrame:
    """Drop rows with any missing column; infinite values count as present."""
    return df.na.drop("any")


def feature_names(df: DataFrame, series: Series = Series(), drop_label: bool = False) -> list[str]:
    """Model inputs in column order.

    The label itself is among them by default, as in the original data set definition; training on it
    leaks the answer, so pass ``drop_label=True`` for honest inputs.
    """
    hidden = {*NOT_FEATURES, *series.keys, series.order, "split", *([LABEL] if drop_label else [])}
    return [c for c in df.columns if c not in hidden]


def select_features(df: DataFrame, series: Series = Series(), drop_label: bool = False) -> DataFrame:
    """Keys and model inputs; rows stay aligned by key, never by position."""
    return df.select(*series.keys, series.order, *feature_names(df, series, drop_label))


def label_column(df: DataFrame, series: Series = Series()) -> DataFrame:
    return df.select(*series.keys, series.order, F.col(LABEL).alias("target"))


def reference_prices(df: DataFrame, series: Series = Series()) -> DataFrame:
    return df.select(*series.keys, series.order, "close", "target_next_close")


def temporal_split(df: DataFrame, series: Series = Series(), share: float = 0.8) -> DataFrame:
    """Add ``split``: the first ``int(n * share)`` rows of each series are train, the rest test.

    Series that fit a task are numbered. Of a longer one only the boundary is searched, by counts over the bits of the order
    column; its rows are neither numbered nor shuffled, but for those at the boundary itself where ties order them.
    """
    order = df.schema[series.order].dataType
    if series.bounded or not isinstance(order, (DateType, TimestampType, IntegralType)):
        return _numbered_split(df, series, share)
    keys = list(series.keys)
    long, count, _ = list_long(df, series)
    if not count:
        return _numbered_split(df, replace(series, fits=True), share)
    if series.materialise:
        df = materialise(df, "series")
    marked = lookup(df, long.select(*keys, F.lit(True).alias("_long")), keys, count)
    # Rows without an order value come last.
    bits = F.coalesce(ordered_bits(F.col(series.order), order), F.lit(2**63 - 1))
    rows = materialise(marked.filter("_long").withColumn("_bits", bits).drop("_long"), "bits")
    first = F.floor(F.col("_n") * F.lit(float(share)))
    edge = select_by_bits(rows.select(*keys, "_bits"), keys, count, {"edge": first})
    placed = lookup(rows, edge, keys, count)
    # Without a boundary all rows are train.
    train = F.coalesce(F.col("_bits") < F.col("edge_low"), F.lit(True))
    cut = (F.col("_bits") == F.col("edge_low")) & (F.col("edge_rank") > 0)
    whole = placed.filter(~F.coalesce(cut, F.lit(False))).withColumn("split", F.when(train, "train").otherwise("test"))
    at_edge = arrange(placed.filter(cut), series).df
    at_edge = at_edge.withColumn("split", F.when(F.col("_rn") < F.col("edge_rank"), "train").otherwise("test"))
    short = _numbered_split(marked.filter("_long is null").select(*df.columns), replace(series, fits=True), share)
    return whole.select(*df.columns, "split").union(at_edge.select(*df.columns, "split")).union(short)


def _numbered_split(df: DataFrame, series: Series, share: float) -> DataFrame:
    numbered = arrange(df, series).df
    train = F.col("_rn") < F.floor(F.col("_n") * F.lit(float(share)))
    return numbered.withColumn("split", F.when(train, "train").otherwise("test")).select(*df.columns, "split")


def split_periods(df: DataFrame, series: Series = Series()) -> DataFrame:
    """Rows, period, mean close and class balance of each split, over all series together."""
    up, rows = F.sum(LABEL), F.count(F.lit(1))
    return df.groupBy("split").agg(
        rows.alias("rows"),
        F.min(series.order).alias("first_date"),
        F.max(series.order).alias("last_date"),
        F.avg("close").alias("mean_close"),
        up.cast("long").alias("days_up"),
        (rows - up).cast("long").alias("days_down"),
    )


def prepare_dataset(df: DataFrame, series: Series = Series(), share: float = 0.8) -> DataFrame:
    return temporal_split(drop_incomplete_rows(df), series, share)


def write_bundle(df: DataFrame, path: str, series: Series = Series(), drop_label: bool = False) -> dict[str, str]:
    """Write X, y and prices for train and test under ``path`` and return the six locations.

    The prepared table is written once to the shared folder and each output reads only its columns, so
    the feature plan runs a single time and a lost executor costs a re-read, not a recomputation.
    """
    stored = materialise(df, "bundle")
    made = {}
    for split in ("train", "test"):
        part = stored.filter(F.col("split") == split)
        outputs = {
            "X": select_features(part, series, drop_label),
            "y": label_column(part, series),
            "prices": reference_prices(part, series),
        }
        for name, out in outputs.items():
            made[f"{name}_{split}"] = f"{path}/{name}_{split}"
            out.write.mode("overwrite").parquet(made[f"{name}_{split}"])
    return made
