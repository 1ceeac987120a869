"""Medians by the bits of ordered values."""

import math
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tickloom.operators.selection import exact_median, from_bits, middle_by_bits, ordered_bits

EDGES = [
    0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308,
    float("inf"), float("-inf"), 1.0, math.nextafter(1, 0), math.nextafter(1, 2), math.nextafter(2, 0), 1e22, 0.1, 3.0, 1e-300, 2.0**-1000,
    math.nextafter(2.0**40, 0), 2.0**40, -(2.0**-1022), math.nextafter(2.0**-1022, 0),
]


def test_bits_keep_value_and_order(spark):
    rng = np.random.default_rng(4)
    some = EDGES + [float(s * m * 2.0**e) for s, m, e in zip(rng.choice([-1, 1], 800), rng.uniform(1, 2, 800), rng.integers(-1070, 1023, 800))]
    some += [s * 2.0**e for e in range(-1074, 1024) for s in (1, -1)]
    table = spark.createDataFrame([(x,) for x in some], "x double")
    kind = table.schema["x"].dataType
    rows = table.select("x", ordered_bits(F.col("x"), kind).alias("b")).select("x", "b", from_bits(F.col("b"), kind).alias("back")).collect()
    assert all(r.back == r.x for r in rows)
    assert [r.x for r in sorted(rows, key=lambda r: r.b)] == sorted(some)
    assert all((r.b == q.b) == (r.x == q.x) for r, q in zip(rows, rows[1:]))


def test_bits_of_other_types(spark):
    table = spark.createDataFrame([(-(2**63), "-12.34", -1.5, -7), (2**63 - 1, "99999999.99", 2.25, 7), (0, "0.01", 0.0, 0)], "l long, s string, f float, i int")
    table = table.withColumn("d", F.col("s").cast("decimal(18,2)")).withColumn("f", F.col("f").cast("float"))
    for name in ("l", "d", "f", "i"):
        kind = table.schema[name].dataType
        rows = table.select(F.col(name).alias("x"), ordered_bits(F.col(name), kind).alias("b")).withColumn("back", from_bits(F.col("b"), kind)).collect()
        assert all(r.back == r.x for r in rows)
        assert sorted(rows, key=lambda r: r.b) == sorted(rows, key=lambda r: r.x)
    with pytest.raises(TypeError):
        ordered_bits(F.col("s"), table.schema["s"].dataType)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0, 1e-320]))), min_size=1, max_size=50), st.sampled_from([12, 31]))
def test_median_of_large_and_small_groups(spark, rows, bits):
    table = spark.createDataFrame(rows, "k string, x double")
    groups = {}
    for k, x in rows:
        if x is not None:
            groups.setdefault(k, []).append(x)
    expected = {k: statistics.median(v) for k, v in groups.items()}
    got = {r.k: r.median for r in exact_median(table, "x", ["k"], block_rows=4, bits=bits).collect()}
    assert got == pytest.approx(expected, rel=1e-15)


def test_shuffled_rows_do_not_follow_the_values(spark):
    """Ten times the different values: the counts of a pass stay within their bound."""
    for n in (20_000, 200_000):
        table = spark.range(n).select(F.lit("A").alias("k"), (F.rand(7) * 1000).alias("x"))
        table = table.persist()
        values = sorted(r.x for r in table.collect())
        low, high = values[(n - 1) // 2], values[n // 2]
        found = middle_by_bits(table, "x", ["k"], 1, bits=8).first()
        assert (found.low, found.high) == (low, high)
        counted = table.groupBy("k", F.shiftright(ordered_bits(F.col("x"), table.schema["x"].dataType), 52)).count()
        assert counted.count() <= 2**12
        table.unpersist()
