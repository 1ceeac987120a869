"""Strided sequences, folds at a stride and least squares by blocks against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.frames import days
from tickloom.operators import forecast
from tickloom.operators.regression import Moments
from tickloom.plans.series import Series

BY_TIME = Series(order="timestamp")
SCHEMA = "series_key string, timestamp timestamp, price double"


@pytest.fixture(scope="module")
def prices():
    rng = np.random.default_rng(3)
    made = {k: np.cumsum(rng.normal(size=n)).round(3).tolist() for k, n in (("long", 700), ("short", 90), ("tiny", 9), ("none", 4), (None, 60))}
    for at in (3, 50, 51, 300, 695):
        made["long"][at] = None
    made["short"][40] = float("inf")
    return made


def table(spark, prices):
    rows = [(k, day, p) for k, all_ in prices.items() for day, p in zip(days(len(all_)), all_)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain(prices, rows, folds, step):
    """(key, fold) -> (actual, predicted) by a fit of its own for every fold."""
    out = {}
    for key, all_ in prices.items():
        p = np.array([np.nan if x is None else x for x in all_], float)
        p = np.where(np.isfinite(p), p, np.nan)
        m = len(p) - rows
        z = np.array([p[s : s + rows + 1] for s in range(m)]).reshape(-1, rows + 1)
        for f in range(folds):
            i = m - 2 - (folds - 1 - f) * step
            if i < 1:
                continue
            train = z[:i][np.isfinite(z[:i]).all(1)]
            lags, actual = z[i + 1, :-1], all_[i + 1 + rows]
            if len(train) and np.isfinite(lags).all():
                mean = train.mean(0)
                slope = np.linalg.pinv(train[:, :-1] - mean[:-1], rcond=10**-5.5) @ (train[:, -1] - mean[-1])
                out[key, f] = (actual, mean[-1] + slope @ (lags - mean[:-1]))
            else:
                out[key, f] = (actual, None)
    return out


@pytest.mark.parametrize("rows, folds, step, block, block_rows", [(4, 5, 1, 4096, 10**6), (4, 37, 11, 50, 10**6), (6, 9, 70, 16, 200), (1, 300, 2, 33, 64)])
def test_every_fold_equals_a_fit_of_its_own(spark, prices, rows, folds, step, block, block_rows):
    series = Series(order="timestamp", block_rows=block_rows)
    made = forecast.walk_forward_lr(table(spark, prices), series, rows, folds, step=step, block=block).collect()
    expected = plain(prices, rows, folds, step)
    assert {(r.series_key, r.fold) for r in made} == set(expected) and len(made) == len(expected)
    for r in made:
        actual, predicted = expected[r.series_key, r.fold]
        assert r.actual == actual
        assert r.predicted == (None if predicted is None else pytest.approx(predicted, rel=1e-6, abs=1e-6))


def test_series_without_keys(spark, prices):
    one = table(spark, {"long": prices["long"]}).drop("series_key")
    series = Series(keys=(), order="timestamp")
    made = forecast.walk_forward_lr(one, series, 4, 7, step=9, block=20).collect()
    expected = plain({"long": prices["long"]}, 4, 7, 9)
    assert {r.fold: r.predicted for r in made} == {f: p if p is None else pytest.approx(p, rel=1e-6, abs=1e-6) for (_, f), (_, p) in expected.items()}


def test_rows_of_a_fit_do_not_depend_on_the_number_of_folds(spark, prices):
    blocks = forecast.sequence_blocks(table(spark, prices), BY_TIME, 4, block=64)
    stored = blocks.agg(F.sum(F.size("prices"))).first()[0]
    total = sum(len(p) for p in prices.values() if len(p) > 4)
    assert total <= stored <= total + 4 * (blocks.count() - 1)
    few, many = (forecast.walk_forward_lr(table(spark, prices), BY_TIME, 4, n, block=64) for n in (2, 200))
    spreads = [p._jdf.queryExecution().optimizedPlan().toString().count("Generate") for p in (few, many)]
    assert spreads[0] == spreads[1]


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_windows_of_blocks_are_the_sequences(spark, prices, block):
    blocks = forecast.sequence_blocks(table(spark, prices), BY_TIME, 5, block=block)
    got = {(r.series_key, r.seq): (r.features, r.label, r.label_time, r.sequences) for r in forecast.sequence_windows(blocks, BY_TIME, 5).collect()}
    expected = {
        (k, s): (p[s : s + 5], p[s + 5], days(len(p))[s + 5], len(p) - 5) for k, p in prices.items() for s in range(len(p) - 5)
    }
    assert got == expected


@pytest.mark.parametrize("folds, step", [(5, 1), (4, 3), (50, 7), (1, 1), (3, 1000)])
def test_folds_and_spans(spark, prices, folds, step):
    sequences = forecast.make_sequences(table(spark, prices), BY_TIME, 5)
    got = {(r.series_key, r.seq, r.fold, r.role) for r in forecast.walk_forward_folds(sequences, folds, step).collect()}
    expected = set()
    for key, p in prices.items():
        m = len(p) - 5
        for f in range(folds):
            i = m - 2 - (folds - 1 - f) * step
            if i >= 1:
                expected |= {(key, s, f, "train") for s in range(i)} | {(key, i, f, "test"), (key, i + 1, f, "validation")}
    assert got == expected
    spans = forecast.fold_spans(sequences, folds, step).collect()
    assert len(spans) == sequences.count()
    for r in spans:
        trained = [f for k, s, f, role in expected if (k, s, role) == (r.series_key, r.seq, "train")]
        assert r.train_from == (min(trained) if trained else None) and (not trained or sorted(trained) == list(range(min(trained), folds)))


def test_bad_folds_raise(spark, prices):
    with pytest.raises(ValueError, match="step"):
        forecast.walk_forward_lr(table(spark, prices), BY_TIME, 4, 5, step=0).collect()


def test_moments_merge_like_one_pass():
    rows = np.random.default_rng(1).normal(1e6, 1, (300, 4))
    whole, merged = Moments.of(rows), Moments.none(4)
    for a in (0, 1, 2, 150, 299):
        merged = merged + Moments.of(rows[a : {0: 1, 1: 2, 2: 150, 150: 299, 299: 300}[a]])
    assert merged.n == whole.n and np.allclose(merged.products, whole.products, rtol=1e-7)
