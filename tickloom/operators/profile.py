"""Profiles and reports. Each is one aggregate over the table, turned into long rows where useful."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.functions.scalars import numeric_columns
from tickloom.operators.selection import exact_median
from tickloom.session import materialise


def _rows() -> Column:
    return F.count(F.lit(1))


def load_summary(df: DataFrame, date: str = "date", keys: Iterable[str] = ()) -> DataFrame:
    """Over all rows, or per key; so for the other reports."""
    return df.groupBy(*keys).agg(
        _rows().alias("rows"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.avg("close").alias("mean_close"),
        F.max("high").alias("max_high"),
        F.min("low").alias("min_low"),
    ).withColumn("columns", F.lit(len(df.columns)))


def price_report(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        _rows().alias("rows"),
        F.max("high").alias("max_high"),
        F.min("low").alias("min_low"),
        F.avg("close").alias("mean_close"),
        F.stddev_samp("close").alias("std_close"),
    )


def quote_vs_mean(
    quotes: DataFrame, bars: DataFrame, price: str = "price_usd", keys: Iterable[str] = ("series_key",)
) -> DataFrame:
    """Sign, absolute and percent distance of each quote to the mean close of the same series.

    A quote without bars of its series stays, with nothing to compare.
    """
    keys = list(keys)
    means = bars.groupBy(*keys).agg(F.avg("close").alias("mean_close"))
    value, mean = F.col(price), F.col("mean_close")
    return quotes.join(means, keys, "left").withColumns(
        {
            "sign": F.when(value > mean, "+").when(value.isNotNull() & mean.isNotNull(), "-"),
            "difference": F.abs(value - mean),
            "percent": F.abs(F.try_divide(value - mean, mean) * 100),
        }
    )


def feature_report(features: DataFrame, prepared: DataFrame) -> DataFrame:
    """``(metric, value)`` rows: feature counts, split sizes and the balance of the target."""
    from tickloom.operators.dataset import feature_names

    sizes = prepared.agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test")
    )
    balance = features.agg(
        _rows().alias("rows"),
        F.sum(S.LABEL).alias("up"),
        F.avg("target_pct_change").alias("mean_pct_change"),
    )
    total, up, rows = F.col("train") + F.col("test"), F.col("up"), F.col("rows")
    return _metrics(
        sizes,
        features=F.lit(len(feature_names(features))),
        technical_features=F.lit(sum(c in S.TECHNICAL for c in features.columns)),
        calendar_features=F.lit(sum(c in S.CALENDAR for c in features.columns)),
        train_rows=F.col("train"),
        test_rows=F.col("test"),
        train_percent=F.try_divide(F.col("train") * 100.0, total),
        test_percent=F.try_divide(F.col("test") * 100.0, total),
    ).unionByName(
        _metrics(
            balance,
            days_up=up,
            days_down=rows - up,
            percent_up=F.try_divide(up * 100.0, rows),
            percent_down=F.try_divide((rows - up) * 100.0, rows),
            mean_pct_change=F.col("mean_pct_change"),
        )
    )


def _metrics(row: DataFrame, **values: Column) -> DataFrame:
    """One aggregate row as ``(metric, value)`` rows."""
    made = [F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value")) for name, value in values.items()]
    return row.select(F.inline(F.array(*made)))


def rsi_stats(df: DataFrame, column: str = "rsi_14", keys: Iterable[str] = ()) -> DataFrame:
    x = F.col(column)
    return df.groupBy(*keys).agg(
        F.avg(x).alias("mean"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.count_if(x > 70).alias("overbought"),
        F.count_if(x < 30).alias("oversold"),
    )


def macd_stats(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    line, signal = F.col("macd"), F.col("macd_signal")
    return df.groupBy(*keys).agg(
        F.avg(line).alias("mean"),
        F.count_if(line > signal).alias("bullish"),
        F.count_if(line < signal).alias("bearish"),
    )


def volatility_stats(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(f"volatility_{n}").alias(f"mean_volatility_{n}") for n in S.VOLATILITY_ROWS])


def target_profile(df: DataFrame, block_rows: int = 1_000_000, keys: Iterable[str] = ()) -> DataFrame:
    """Up/down counts (missing labels in neither) and the spread of the percent target.

    Labels and targets are written once, for the spread and the median read them both.
    """
    keys = list(keys)
    df = materialise(df.select(*keys, S.LABEL, "target_pct_change"), "targets")
    x, up = F.col("target_pct_change"), F.sum(S.LABEL)
    spread = df.groupBy(*keys).agg(
        up.cast("long").alias("days_up"),
        (F.count(S.LABEL) - up).cast("long").alias("days_down"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.max(x).alias("max"),
        F.min(x).alias("min"),
    )
    middle = exact_median(df, "target_pct_change", keys, block_rows=block_rows)
    # One row each per key: stacked, and merged by taking the known value of every column.
    both = spread.unionByName(middle, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in both.columns if c not in keys])


def class_balance(labels: DataFrame, column: str = "target", limit: float = 0.4, keys: Iterable[str] = ()) -> DataFrame:
    """Counts and shares of both classes and whether the rarer one reaches ``limit`` of the other."""
    down, up = F.count_if(F.col(column) == 0), F.count_if(F.col(column) == 1)
    keys = list(keys)
    counted = labels.groupBy(*keys).agg(_rows().alias("_rows"), down.alias("class_0"), up.alias("class_1"))
    ratio = F.try_divide(F.least("class_0", "class_1").cast("double"), F.greatest("class_0", "class_1"))
    return counted.select(
        *keys,
        "class_0",
        "class_1",
        F.try_divide(F.col("class_0") * 100.0, "_rows").alias("percent_0"),
        F.try_divide(F.col("class_1") * 100.0, "_rows").alias("percent_1"),
        ratio.alias("ratio"),
        F.coalesce(ratio > limit, F.lit(False)).alias("balanced"),
    )


def _long(df: DataFrame, columns: list[str], *kept: Column) -> DataFrame:
    """One row per row and column: its 1-based place, name and value."""
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for i, c in enumerate(columns, 1)
    ]
    return df.select(*kept, F.inline(F.array(*cells)))


def _statistics(df: DataFrame, columns: Iterable[str], keys: Iterable[str], **measures: Column) -> DataFrame:
    """Statistics of every column, per key if there are any.

    The long form keeps the aggregate at a few buffers per column however wide the table is; it is reduced
    to one row per column before the shuffle.
    """
    named = [measure.alias(name) for name, measure in measures.items()]
    keys = list(keys)
    return _long(df, list(columns), *map(F.col, keys)).groupBy(*keys, "position", "feature").agg(*named)


def describe_features(df: DataFrame, columns: Iterable[str], keys: Iterable[str] = ()) -> DataFrame:
    return _statistics(
        df, columns, keys, mean=F.avg("value"), std=F.stddev_samp("value"), min=F.min("value"), max=F.max("value")
    )


def feature_ranges(df: DataFrame, columns: Iterable[str], keys: Iterable[str] = ()) -> DataFrame:
    return _statistics(df, columns, keys, min=F.min("value"), max=F.max("value"), mean=F.avg("value"))


def target_correlation(
    df: DataFrame, label: str = S.LABEL, columns: Iterable[str] | None = None, keys: Iterable[str] = ()
) -> DataFrame:
    """Pearson correlation of every numeric column with the label over rows where both are known."""
    columns = list(columns or numeric_columns(df))
    both = F.col("value").isNotNull() & F.col("_label").isNotNull()
    x, y = F.when(both, F.col("value")), F.when(both, F.col("_label"))
    value = F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
    keys = list(keys)
    long = _long(df, columns, *map(F.col, keys), F.col(label).cast("double").alias("_label"))
    return long.groupBy(*keys, "position", "feature").agg(F.when(~F.isnan(value), value).alias("correlation"))


def top_k_correlation(correlations: DataFrame, k: int = 15, label: str = S.LABEL) -> DataFrame:
    """First and last ``k`` of the descending order, a missing correlation coming last.

    Places count within each end and keep the gaps left by the label and the targets. The input has one
    row per column of the feature table, so ordering it in one task is bounded by the schema.
    """
    best = Window.orderBy(F.col("correlation").desc_nulls_last(), F.col("position"))
    ranked = correlations.withColumns({"_rank": F.row_number().over(best), "_total": _rows().over(Window.partitionBy())})
    rank, tail_start = F.col("_rank"), F.greatest(F.col("_total") - k, F.lit(0))
    ends = F.array(
        F.when((rank <= k) & (F.col("feature") != label), F.struct(F.lit("highest").alias("side"), rank.alias("place"))),
        F.when(
            (rank > tail_start) & ~F.col("feature").isin(*S.TARGETS),
            F.struct(F.lit("lowest").alias("side"), (rank - tail_start).cast("int").alias("place")),
        ),
    )
    picked = ranked.withColumn("_end", F.explode(ends)).filter(F.col("_end").isNotNull())
    return picked.select("_end.side", "_end.place", "feature", "correlation")


def _counts(df: DataFrame, columns: list[str], name: str, condition) -> DataFrame:
    """How often a condition holds per column; every column has a row, also for an empty table."""
    counts = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.count_if(condition(F.col(c))).alias(name))
        for i, c in enumerate(columns, 1)
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def nan_census(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Missing values per column, and their total as the row with place 0."""
    counted = _counts(df, list(columns), "missing", lambda c: c.isNull())
    total = counted.agg(F.lit(0).alias("position"), F.lit("total").alias("feature"), F.sum("missing").alias("missing"))
    return counted.unionByName(total)


def inf_census(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    infinite = F.lit(float("inf"))
    return _counts(
        df, list(columns or numeric_columns(df)), "infinite", lambda c: F.abs(c.cast("double")) == infinite
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier one in all columns, as one row.

    Rows go by two hashes first, 16 bytes however wide they are, counted map-side. Only rows whose hashes occur again are
    compared in full, so a collision costs a comparison and changes nothing.
    """
    def hashed(rows: DataFrame, a: str, b: str) -> DataFrame:
        return rows.select("*", F.xxhash64(*df.columns).alias(a), F.xxhash64(F.lit("again"), *reversed(df.columns)).alias(b))

    again = hashed(df, "_a", "_b").groupBy("_a", "_b").agg(_rows().alias("_n")).filter("_n > 1").select("_a", "_b")
    one, other = (_free(df, name) for name in ("_one", "_other"))
    rows = hashed(df, one, other)
    some = rows.join(again, (rows[one] == again["_a"]) & (rows[other] == again["_b"]), "left_semi").drop(one, other)
    copies = some.groupBy(*df.columns).agg(_rows().alias(_free(df, "_copies")))
    extra = F.col(_free(df, "_copies")) - 1
    return copies.agg(F.coalesce(F.sum(extra), F.lit(0)).cast("long").alias("duplicates"))


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name
