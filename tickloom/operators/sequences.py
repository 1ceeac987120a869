"""Sequences of consecutive prices, kept as strided blocks.

A block holds the prices of ``block`` consecutive rows of a series and those of the rows a sequence that starts in
it reaches into, so a price is stored about once, not once per sequence. A sequence is a place in a block: the
window of ``rows`` prices from there on, and the price behind it as its label.

Sequence s of a series with N prices covers rows s .. s + rows - 1, and there are M = N - rows of them. Fold f of
n, with ``step`` sequences from one fold to the next, trains on sequences before i = M - 2 - (n - 1 - f) * step,
tests on i and validates on i + 1; folds with i < 1 do not exist. The last fold ends with the last sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.plans.series import Series, arrange

PRICES_BY_TIME = Series(order="timestamp")
SEQUENCE_ROWS = 30
FOLDS = 5
BLOCK = 4096


def sequence_blocks(
    df: DataFrame,
    series: Series = PRICES_BY_TIME,
    rows: int = SEQUENCE_ROWS,
    price: str = "price",
    block: int = BLOCK,
    beyond: int = 0,
) -> DataFrame:
    """One row per block: ``first`` (its first sequence), ``count``, ``sequences`` of the series, ``prices``, ``times``.

    ``prices`` and ``times`` go on for ``rows + beyond`` rows after the block's last sequence starts, as far as the series
    does. A missing price keeps its place as NULL. Every price is shuffled once, those near a block's start twice.
    """
    reach = rows + beyond
    block = max(block, reach)
    arranged = arrange(df.select(*series.keys, series.order, *series.ties, price), series)
    home, offset = F.floor(F.col("_rn") / block).cast("long"), F.col("_rn") % block
    copies = F.array(home, F.when((offset < reach) & (home > 0), home - 1))
    spread = arranged.df.where(F.col("_n") > rows).withColumn("_block", F.explode(F.filter(copies, lambda b: b.isNotNull())))
    # A struct is never NULL, so a list of them keeps the place of a missing price.
    row = F.struct(F.col("_rn"), F.col(price).alias("price"), F.col(series.order).alias("time"))
    made = spread.groupBy(*series.keys, "_block").agg(
        F.array_sort(F.collect_list(row)).alias("_rows"), (F.max("_n") - rows).alias("sequences")
    )
    first = F.col("_block") * block
    return made.where(first < F.col("sequences")).select(
        *series.keys,
        first.alias("first"),
        F.least(F.lit(block), F.col("sequences") - first).cast("int").alias("count"),
        "sequences",
        F.col("_rows.price").alias("prices"),
        F.col("_rows.time").alias("times"),
    )


def sequence_windows(blocks: DataFrame, series: Series = PRICES_BY_TIME, rows: int = SEQUENCE_ROWS) -> DataFrame:
    """The sequences of blocks, a row each: ``seq``, its prices, the price that follows and that row's time."""
    at = F.col("at")
    spread = blocks.select("*", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("at"))
    return spread.select(
        *series.keys,
        (F.col("first") + at).alias("seq"),
        "sequences",
        F.slice("prices", at + 1, F.lit(rows)).alias("features"),
        F.get("prices", at + rows).alias("label"),
        F.get("times", at + rows).alias("label_time"),
    )


def make_sequences(
    df: DataFrame, series: Series = PRICES_BY_TIME, rows: int = SEQUENCE_ROWS, price: str = "price"
) -> DataFrame:
    """One row per sequence: ``seq``, its prices, the price that follows and that row's time.

    A missing price keeps its place in ``features`` as NULL.
    """
    return sequence_windows(sequence_blocks(df, series, rows, price), series, rows)


def lag_columns(sequences: DataFrame, rows: int = SEQUENCE_ROWS) -> DataFrame:
    """The sequence as scalar columns ``lag_T .. lag_1``, oldest first."""
    lags = [F.col("features")[k].alias(f"lag_{rows - k}") for k in range(rows)]
    return sequences.select(*[c for c in sequences.columns if c != "features"], *lags)


def check_folds(folds: int, step: int) -> None:
    if step < 1 or folds < 1:
        raise ValueError("folds and step must be at least 1")


def fold_start(fold: Column | int, sequences: Column, folds: int, step: int) -> Column:
    """The sequence a fold tests on; it trains on those before."""
    check_folds(folds, step)
    return sequences - 2 - (F.lit(folds - 1) - fold) * step


def fold_spans(sequences: DataFrame, folds: int = FOLDS, step: int = 1) -> DataFrame:
    """Fold membership as an interval, whatever the number of folds: one row per sequence.

    It trains in the folds from ``train_from`` on, is tested in ``test_fold`` and validates ``validation_fold``; NULL
    where there is none.
    """
    check_folds(folds, step)
    last = F.lit(folds - 1)
    ahead = F.col("sequences") - 2 - F.col("seq")  # sequences between this one and the last fold's test

    def whole(n: Column) -> Column:
        return F.floor(n / step).cast("long")

    # Folds before this one would train on nothing.
    least = F.greatest(F.lit(0), last - whole(F.col("sequences") - 3))
    train = F.greatest(least, last - whole(ahead - 1))

    def only(n: Column) -> Column:
        fold = last - whole(n)
        return F.when((n >= 0) & (n % step == 0) & (fold >= least), fold)

    exists = F.col("sequences") >= 3
    return sequences.withColumns({
        "train_from": F.when(exists & (ahead >= 1) & (train <= last), train).cast("int"),
        "test_fold": F.when(exists, only(ahead)).cast("int"),
        "validation_fold": F.when(exists, only(ahead + 1)).cast("int"),
    })


def walk_forward_folds(sequences: DataFrame, folds: int = FOLDS, step: int = 1) -> DataFrame:
    """Fold membership, a row per sequence, fold and role (``train``, ``test`` or ``validation``).

    A training sequence belongs to every later fold, so the result has up to ``folds`` rows per sequence; ``fold_spans``
    says the same in one. The fitting operators use neither: they meet every sequence once.
    """

    def member(fold: Column, role: str) -> Column:
        return F.struct(fold.alias("fold"), F.lit(role).alias("role"))

    none = F.array().cast("array<int>")
    trained = F.when(F.col("train_from").isNotNull(), F.sequence("train_from", F.lit(folds - 1))).otherwise(none)
    held = F.array(member(F.col("test_fold"), "test"), member(F.col("validation_fold"), "validation"))
    members = F.concat(F.transform(trained, lambda f: member(f, "train")), F.filter(held, lambda m: m["fold"].isNotNull()))
    return fold_spans(sequences, folds, step).select(*sequences.columns, F.inline(members))
