import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.functions import fits
from tidecast.operators import unit_root


def test_same_as_the_regression_on_one_array(spark):
    r = np.random.default_rng(3)
    rows = [r.normal(size=n) for n in (4, 5, 6, 7, 9, 12, 30, 101, 400)]
    rows += [1e5 + 300 * r.normal(size=n).cumsum() for n in (8, 25, 77, 430)]
    rows += [np.ones(50), np.arange(40.0), np.array([1.0, 2.0]), np.array([])]
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(rows)],
                               "i int, x array<double>")
    found = {x.i: x for x in unit_root.adf(df).collect()}
    for i, x in enumerate(rows):
        tau, p, lags = fits.adf_test(x) if len(x) >= 4 else (math.nan,) * 3
        if math.isnan(tau) or i == 14:  # a straight line leaves nothing but rounding
            assert found[i].adf_stat is None and found[i].adf_p is None, i
        else:
            assert found[i].adf_lags == lags, i
            assert found[i].adf_stat == pytest.approx(tau, rel=1e-6), i
            assert found[i].adf_p == pytest.approx(p, abs=1e-7), i


def test_normal_distribution(spark):
    z = [-9.0, -4.5, -2.0, -0.3, 0.0, 0.5, 1.96, 3.7, 8.0]
    df = spark.createDataFrame([(x,) for x in z], "z double")
    for row in df.select("z", unit_root.normal_share(F.col("z")).alias("p")).collect():
        assert row.p == pytest.approx(0.5 * (1 + math.erf(row.z / math.sqrt(2))), abs=1e-12)


def test_fixed_lags_are_least_squares(spark):
    x = np.random.default_rng(8).normal(size=80).cumsum()
    df = spark.createDataFrame([(x.tolist(),)], "x array<double>")
    for row in unit_root.adf_at(df, [0, 2, 5]).collect():
        p, steps = row.lags, np.diff(x)
        rows = len(steps) - p
        design = np.column_stack([np.ones(rows), x[p:p + rows], *(
            steps[p - k:p - k + rows] for k in range(1, p + 1))])
        beta = np.linalg.lstsq(design, steps[p:], rcond=None)[0]
        miss = steps[p:] - design @ beta
        error = math.sqrt(miss @ miss / (rows - p - 2) * np.linalg.inv(design.T @ design)[1, 1])
        assert row.adf_stat == pytest.approx(beta[1] / error, rel=1e-8)


def test_cost_follows_the_length(spark):
    """The mean of a series is worked out once, not for every value of it."""
    x = np.random.default_rng(9).normal(size=12_000).cumsum()
    df = spark.createDataFrame([(i, x.tolist()) for i in range(8)], "i int, x array<double>")
    begun = time.perf_counter()
    found = unit_root.centred(df).select(F.col("_z")[5].alias("z")).collect()
    assert time.perf_counter() - begun < 6
    assert [r.z for r in found] == pytest.approx([x[5] - x.mean()] * 8)
