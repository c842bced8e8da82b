"""Exact order statistics against a sort."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martweave.operators.quantile import exact_quantile, order_statistics

EDGES = [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 1.0, np.nextafter(1.0, 2)]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(3)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.sampled_from(EDGES), st.floats(allow_nan=False)), min_size=1, max_size=40), st.data())
def test_ranks_equal_a_sort(spark, values, data):
    ranks = data.draw(st.lists(st.integers(0, len(values) - 1), min_size=1, max_size=3))
    assert order_statistics(frame(spark, [*values, None, math.nan]), "v", ranks) == [sorted(values)[r] for r in ranks]


@pytest.mark.parametrize("share", [0.0, 0.05, 0.5, 0.999, 1.0])
def test_quantiles_equal_numpy(spark, share):
    df = spark.range(20_000, numPartitions=5).select((F.sin(F.col("id") * 7919) * F.exp(F.col("id") % 9)).alias("v"))
    expected = np.quantile([r.v for r in df.collect()], share)
    assert exact_quantile(df, "v", share) == pytest.approx(expected, rel=1e-14)


def test_one_value_for_most_rows(spark):
    df = spark.range(10_000, numPartitions=4).select(F.when(F.col("id") < 9_000, 0.5).otherwise(F.col("id")).alias("v"))
    assert exact_quantile(df, "v", 0.3) == 0.5 and order_statistics(df, "v", [8_999, 9_000]) == [0.5, 9_000.0]


def test_nothing_to_rank(spark):
    assert exact_quantile(frame(spark, []), "v", 0.5) is None and exact_quantile(frame(spark, [None, math.nan]), "v", 0.5) is None
    with pytest.raises(ValueError):
        order_statistics(frame(spark, [1.0]), "v", [1])
    with pytest.raises(ValueError):
        exact_quantile(frame(spark, [1.0]), "v", 1.5)
