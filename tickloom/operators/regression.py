"""Least squares on whole sequences for every fold of a walk-forward, each sequence met once.

What a fit needs are the number, means and centred products of (lags, label) over its training sequences, which merge
like sums. The training sets of consecutive folds differ by a few sequences only, so they are prefixes of one scan
over blocks of sequences (operators.sequences):

1. every block that a later fold trains on gives its moments, from windows that overlap in memory; blocks before the first
   fold are merged in their task;
2. per series the moments are added up in the order of blocks, as they stream by, which gives those of everything
   before a block;
3. a block in which folds start goes on from there: each fold adds the sequences since the one before, is
   solved, and forecasts its validation sequence.

Blocks of a series are worked on by many tasks; rows and work of a fit do not depend on the number of folds, but
for one solution each. Of a rank-deficient system the shortest solution is taken. Prediction is the same on scaled
and on plain prices, so nothing is scaled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tickloom.operators.sequences import BLOCK, FOLDS, PRICES_BY_TIME, SEQUENCE_ROWS, check_folds, sequence_blocks
from tickloom.plans.series import Series

# Eigenvalues below this share of the largest count as none.
RANK = 1e-11
# Series whose moments a task merges before it hands them on.
MERGED = 256


class Moments:
    """Number, means and centred products of rows; ``+`` merges."""

    __slots__ = ("n", "mean", "products")

    def __init__(self, n: float, mean: np.ndarray, products: np.ndarray):
        self.n, self.mean, self.products = n, mean, products

    @classmethod
    def none(cls, width: int) -> Moments:
        return cls(0.0, np.zeros(width), np.zeros((width, width)))

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        """Of rows without a gap; the others are left out."""
        rows = rows[np.isfinite(rows).all(1)]
        if not len(rows):
            return cls.none(rows.shape[1])
        mean = rows.mean(0)
        rows = rows - mean
        return cls(float(len(rows)), mean, rows.T @ rows)

    @classmethod
    def packed(cls, flat: np.ndarray, width: int) -> Moments:
        return cls(float(flat[0]), flat[1 : width + 1], flat[width + 1 :].reshape(width, width))

    def pack(self) -> np.ndarray:
        return np.concatenate([[self.n], self.mean, self.products.ravel()])

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not other.n or not self.n:
            return self if self.n else other
        apart = other.mean - self.mean
        products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), products)


def predictions(fits: list[Moments], lags: np.ndarray) -> np.ndarray:
    """Forecast of each fit for its row of lags; NaN without training rows or with a gap."""
    out = np.full(len(fits), np.nan)
    some = [i for i, fit in enumerate(fits) if fit.n and np.isfinite(lags[i]).all()]
    if some:
        mean = np.stack([fits[i].mean for i in some])
        spread = np.stack([fits[i].products / fits[i].n for i in some])
        slope = (np.linalg.pinv(spread[:, :-1, :-1], rcond=RANK, hermitian=True) @ spread[:, :-1, -1:])[..., 0]
        out[some] = mean[:, -1] + ((lags[some] - mean[:, :-1]) * slope).sum(1)
    return out


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values (NULL as NaN) and the place of each list's first one."""
    values = column.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    return values, column.offsets.to_numpy()


def _windows(prices: np.ndarray, width: int) -> np.ndarray:
    """All stretches of ``width`` prices, without a copy."""
    return np.lib.stride_tricks.sliding_window_view(prices, width)


def _block_moments(blocks: DataFrame, keys: list[str], rows: int, block: int) -> DataFrame:
    """(keys, block, state): moments of blocks; those before ``opens``, the block of the first fold, are merged as the one before it."""
    width = rows + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Moments] = {}

        def made() -> pa.RecordBatch:
            columns = list(zip(*held)) if held else [[]] * (len(keys) + 1)
            arrays = [pa.array(list(c), kinds[i]) for i, c in enumerate(columns[:-1])]
            states = pa.array([m.pack() for m in held.values()], pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([*arrays, pa.array(list(columns[-1]), pa.int64()), states], [*keys, "block", "state"])

        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys]
            prices, starts = _lists(batch.column("prices"))
            names = list(zip(*(batch.column(k).to_pylist() for k in keys))) if keys else [()] * batch.num_rows
            for i, (first, count, opens) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("first", "count", "opens")))):
                moments = Moments.of(_windows(prices[starts[i] : starts[i + 1]], width)[:count])
                place = (*names[i], max(first // block, opens - 1))
                held[place] = held[place] + moments if place in held else moments
                if len(held) >= MERGED:
                    yield made()
                    held = {}
        if held:
            yield made()

    kinds = "".join(f"`{k}` {blocks.schema[k].dataType.simpleString()}, " for k in keys)
    return blocks.select(*keys, "first", "count", "opens", "prices").mapInArrow(run, f"{kinds}block long, state array<double>")


def _sums_before(parts: DataFrame, keys: list[str], width: int) -> DataFrame:
    """(keys, block, before): moments of everything in front of a block, added up in order as rows stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, place = None, Moments.none(width), None
        done: list[tuple] = []
        kinds: list[pa.DataType] = []

        def made() -> pa.RecordBatch:
            columns = list(zip(*done))
            arrays = [pa.array(list(c), k) for c, k in zip(columns, [*kinds, pa.int64(), pa.list_(pa.float64())])]
            return pa.RecordBatch.from_arrays(arrays, [*keys, "block", "before"])

        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys]
            states, starts = _lists(batch.column("state"))
            names = list(zip(*(batch.column(k).to_pylist() for k in keys))) if keys else [()] * batch.num_rows
            for i, at in enumerate(batch.column("block").to_pylist()):
                if now is not None and (names[i], at) != (now, place):
                    done.append((*now, place + 1, total.pack()))
                    if names[i] != now:
                        total = Moments.none(width)
                now, place = names[i], at
                total = total + Moments.packed(states[starts[i] : starts[i + 1]], width)
                if len(done) >= MERGED:
                    yield made()
                    done = []
        if now is not None:
            done.append((*now, place + 1, total.pack()))
            yield made()

    kinds = "".join(f"`{k}` {parts.schema[k].dataType.simpleString()}, " for k in keys)
    dealt = parts.repartition(*keys) if keys else parts.repartition(1)
    return dealt.sortWithinPartitions(*keys, "block").mapInArrow(run, f"{kinds}block long, before array<double>")


def walk_forward_lr(
    df: DataFrame,
    series: Series = PRICES_BY_TIME,
    rows: int = SEQUENCE_ROWS,
    folds: int = FOLDS,
    price: str = "price",
    step: int = 1,
    block: int = BLOCK,
) -> DataFrame:
    """Forecast each fold's validation row by least squares of the label on the whole sequence.

    Sequences with a missing or infinite price train nothing; a held-out one has no forecast.
    """
    check_folds(folds, step)
    keys, width = list(series.keys), rows + 1
    block = max(block, rows + 2)
    made = sequence_blocks(df, series, rows, price, block, beyond=2)
    # The fold of start i belongs to the block of sequence i - 1, its last training sequence.
    starts = F.col("sequences") - 2
    earliest = F.greatest(starts - (folds - 1) * step, F.pmod(starts - 1, F.lit(step)) + 1)
    made = made.where("sequences >= 3").withColumn("opens", F.floor((earliest - 1) / block).cast("long"))
    passed = made.where(F.col("first") + F.col("count") < starts)
    before = _sums_before(_block_moments(passed, keys, rows, block), keys, width)
    opened = made.where(F.col("first") >= F.col("opens") * block).withColumn("block", F.floor(F.col("first") / block).cast("long"))
    known = before.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("block").alias("_block"), "before")
    same = F.col("block") == F.col("_block")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    ready = opened.join(known, same, "left").select(*keys, "first", "count", "sequences", "prices", "times", "before")
    out = ready.select(
        *keys, F.lit(0).alias("fold"), F.get("times", F.lit(0)).alias("time"), F.get("prices", F.lit(0)).cast("double").alias("actual"),
        F.lit(0.0).alias("predicted"),
    ).schema
    out = StructType([StructField(f.name, f.dataType) for f in out.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prices, starts = _lists(batch.column("prices"))
            times = batch.column("times")
            states, of = _lists(batch.column("before"))
            places, numbers, held, fits = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("first", "count", "sequences"))
            for i, (first, count, sequences) in enumerate(zip(*columns)):
                windows = _windows(prices[starts[i] : starts[i + 1]], width)
                state = states[of[i] : of[i + 1]]
                total, at = Moments.packed(state, width) if len(state) else Moments.none(width), 0
                for f in range(folds):
                    start = sequences - 2 - (folds - 1 - f) * step
                    if start < 1 or not first <= start - 1 < first + count:
                        continue
                    total, at = total + Moments.of(windows[at : start - first]), start - first
                    places.append(i)
                    numbers.append(f)
                    fits.append(total)
                    held.append(starts[i] + at + 1)
            if not places:
                continue
            rows_of = np.array(held)
            lags = prices[rows_of[:, None] + np.arange(rows)]
            predicted = predictions(fits, lags)
            chosen = pa.array(places)
            last = pa.array(rows_of + rows)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k).take(chosen) for k in keys), pa.array(numbers, pa.int32()), times.values.take(last),
                    batch.column("prices").values.take(last).cast(pa.float64()), pa.array(predicted, pa.float64(), from_pandas=True),
                ],
                [*keys, "fold", "time", "actual", "predicted"],
            )

    return ready.mapInArrow(run, out)
