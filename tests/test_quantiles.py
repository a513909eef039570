"""Exact percentiles and modes against numpy and plain counting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from notifyq.operators import quantiles
from notifyq.operators.profile import category_modes
from notifyq.operators.quantiles import exact_percentiles

FRACTIONS = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]


def test_ten_million_distinct_values(spark, monkeypatch):
    n = 10_000_000
    passes = []
    narrowed = quantiles._narrowed
    monkeypatch.setattr(quantiles, "_narrowed", lambda *a: passes.append(1) or narrowed(*a))
    # A permutation of 0 .. n-1, halved.
    rows = spark.range(0, n, 1, 8).select((F.pmod(F.col("id") * 7_654_321 + 11, F.lit(n)) / 2).alias("x"))
    got = exact_percentiles(rows, F.col("x"), FRACTIONS)
    assert got == pytest.approx([(n - 1) * f / 2 for f in FRACTIONS], abs=1e-6)
    assert len(passes) == 1


@pytest.mark.parametrize("keep", [1, 5, 1 << 14])
def test_ties_outliers_nulls_and_few_values(spark, monkeypatch, keep):
    monkeypatch.setattr(quantiles, "KEEP", keep)
    rng = np.random.default_rng(2)
    sets = [
        [1.5], [2.0, 1.0], [7.0] * 500, [7.0] * 300 + [8.0] * 300,
        [*rng.normal(0, 1, 700), *[0.25] * 400, 1e300, -1e300, 5e-324],
        [*range(1000), *[500] * 3000],
    ]
    for values in sets:
        rows = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(3)
        got = exact_percentiles(rows, F.col("x"), FRACTIONS)
        want = np.percentile(np.array(values, float), [100 * f for f in FRACTIONS])
        assert got == pytest.approx(list(want), rel=1e-12)
    assert exact_percentiles(spark.createDataFrame([(None,)], "x double"), F.col("x"), [0.5]) == [None]


def test_modes_take_the_smallest_of_equals_and_keep_empty_columns(spark):
    rows = [("b", None), ("a", None), ("a", None), ("b", None), (None, None), (None, None), (None, None)]
    got = category_modes(spark.createDataFrame(rows, "x string, y string"), ["x", "y"]).collect()
    assert sorted((r.variable, r.mode) for r in got) == [("x", "a"), ("y", None)]


def test_no_buffer_of_all_values_in_the_plans(spark):
    from conftest import SF0001
    from notifyq.plans.queries import QUERIES

    for name in ("latency_stats", "category_modes"):
        plan = QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert "percentile(" not in plan and "mode(" not in plan, name
