"""Every registered query against its SQL."""

import numpy as np
import pytest

import __spark_entry__ as entry
from tickloom.catalog import tables
from tickloom.catalog.oracle import oracle_sql
from tickloom.catalog.queries import QUERIES
from tests.compare import database, differences

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert differences(spark, con, FOLDER, name, SQL[name]) is None


def test_forecasts_on_the_whole_sequence_equal_a_plain_fit(spark):
    series = {}
    for r in tables.price_series_keyed(spark, FOLDER).orderBy("series_key", "timestamp").collect():
        series.setdefault(r.series_key, []).append((r.timestamp, r.price))
    expected = {}
    for key, rows in series.items():
        prices = np.array([p for _, p in rows], float)
        x = np.array([prices[i : i + 30] for i in range(len(prices) - 30)])
        y = prices[30:]
        for fold in range(5):
            at = len(y) - 5 + fold  # the held-out sequence; the test sequence before it trains nothing
            n = at - 1
            if n < 1:
                continue
            mean = x[:n].mean(0)
            slope = np.linalg.lstsq(x[:n] - mean, y[:n] - y[:n].mean(), rcond=10**-5.5)[0]
            expected[key, fold] = y[:n].mean() + slope @ (x[at] - mean)
    assert len(expected) >= 20
    made = entry.queries()["walk_forward_lr_whole"](spark, FOLDER).collect()
    assert {(r.series_key, r.fold): r.predicted for r in made} == pytest.approx(expected, rel=1e-4, abs=1e-3)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
