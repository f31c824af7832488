
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.functions import fits
from tidecast.operators import diagnostics, statistical


def walk(n, seed=1):
    return (100 + np.random.default_rng(seed).normal(size=n).cumsum()).tolist()


def correlations(x, lags):
    z = np.asarray(x) - np.mean(x)
    return np.array([z[k:] @ z[:len(z) - k] for k in range(lags + 1)]) / (z @ z)


def test_describe(make_series):
    values = walk(37)
    row = diagnostics.describe(make_series(a=values)).first()
    assert row["count"] == 37
    expected = [np.mean(values), np.std(values, ddof=1), min(values),
                *np.percentile(values, [25, 50, 75]), max(values)]
    assert [row[c] for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]] == (
        pytest.approx(expected))


def test_describe_of_one_row(make_series):
    row = diagnostics.describe(make_series(a=[3])).first()
    assert (row.p25, row.p75, row["std"]) == (3.0, 3.0, None)


def test_acf(make_series):
    values = walk(200)
    diff = np.diff(values[:160])
    rows = diagnostics.acf(make_series(a=values)).orderBy("lag").collect()
    r = correlations(diff, 40)
    assert [x.value for x in rows] == pytest.approx(r.tolist())
    assert rows[0].value == 1.0 and rows[0].lo == rows[0].hi == 1.0
    half = 1.959964 * np.sqrt((1 + 2 * (r[1:5] ** 2).sum()) / len(diff))
    assert rows[5].hi - rows[5].value == pytest.approx(half)


def test_lags_shrink_with_a_short_series(make_series):
    # 48 train rows: 16 lags where three rows are asked for each, else 40; 8 rows: 6 lags
    assert diagnostics.acf(make_series(a=walk(60)), rows_per_lag=3).count() == 17
    assert diagnostics.acf(make_series(a=walk(60))).count() == 41
    assert diagnostics.acf(make_series(a=walk(10))).count() == 7


def test_pacf_solves_yule_walker(make_series):
    values = walk(200, 3)
    rows = diagnostics.pacf(make_series(a=values)).orderBy("lag").collect()
    r = correlations(np.diff(values[:160]), 40)
    assert rows[1].value == pytest.approx(r[1])
    for k in (2, 7, 40):
        toeplitz = r[np.abs(np.subtract.outer(np.arange(k), np.arange(k)))]
        assert rows[k].value == pytest.approx(np.linalg.solve(toeplitz, r[1:k + 1])[-1])
    assert rows[0].lo == rows[0].hi == 1.0
    assert rows[3].hi - rows[3].value == pytest.approx(1.959964 / np.sqrt(159))


def test_no_series_vanishes_from_the_correlograms(make_series):
    source = make_series(a=[5] * 60, line=range(60), one=[1], two=[1, 2], three=[1, 2, 4])
    rows = diagnostics.correlograms(source).collect()
    assert {r.series for r in rows} == {"a", "line", "three"}
    assert all(r.value is None for r in rows)
    assert {r.series for r in diagnostics.no_correlogram(source).collect()} == {"one", "two"}


def decomposed(make_series, n):
    days = [v + 10 * (i % 7) for i, v in enumerate(walk(n, 5))]
    return diagnostics.decompose(make_series(a=days)).orderBy("date").toPandas()


def test_decomposition_weekly(make_series):
    out = decomposed(make_series, 70)
    assert set(out.period) == {5}
    inner = out.dropna()
    assert len(out) - len(inner) == 4
    assert np.allclose(inner.trend + inner.seasonal + inner.resid, inner.observed)
    assert abs(out.seasonal[:5].sum()) < 1e-9
    assert inner.trend.iloc[0] == pytest.approx(out.observed[:5].mean())


def test_decomposition_yearly(make_series):
    out = decomposed(make_series, 1000)
    assert set(out.period) == {252}
    assert out.trend.notna().sum() == len(out) - 252
    inner = out.dropna()
    assert np.allclose(inner.trend + inner.seasonal + inner.resid, inner.observed)
    assert abs(out.seasonal[:252].sum()) < 1e-6
    window = out.observed[:253].to_numpy()
    expected = (2 * window[1:-1].sum() + window[0] + window[-1]) / 504
    assert inner.trend.iloc[0] == pytest.approx(expected)


def test_short_series_are_named(make_series):
    df = make_series(a=range(12), b=range(70))
    assert [r.series for r in diagnostics.undecomposable(df).collect()] == ["a"]
    assert {r.series for r in diagnostics.decompose(df).select("series").collect()} == {"b"}


def test_kpss_agrees_with_the_fit(make_series):
    values = walk(100, 7)
    rows = diagnostics.kpss_statistic(make_series(a=values)).orderBy("lags").collect()
    for r in rows:
        assert r.statistic == pytest.approx(fits.kpss_test(values[:80], r.lags)[0])


def test_correlogram_columns(make_series):
    out = diagnostics.correlograms(make_series(a=walk(120)))
    wide = out.filter(F.col("lag") == 2).orderBy("kind").collect()
    assert [r.kind for r in wide] == ["acf", "pacf"]
    assert all(r.upper == r.lower > 0 for r in wide)


def test_native_kpss_agrees_with_the_fit(make_series):
    df = make_series(a=walk(200, 7), b=[float((i * 37) % 11) for i in range(90)])
    rows = {(r.series, r.variant): r for r in statistical.kpss_report(df).collect()}
    for name, train in (("a", walk(200, 7)[:160]), ("b", [(i * 37) % 11 for i in range(72)])):
        for variant, x in (("level", train), ("difference", np.diff(train))):
            stat, p, lags = fits.kpss_test(np.asarray(x, float))
            row = rows[name, variant]
            assert row.kpss_lags == lags
            assert (row.kpss_stat, row.kpss_p) == (pytest.approx(stat), pytest.approx(p))


def test_kpss_of_short_and_constant_series(make_series):
    df = make_series(a=[5] * 30, b=[1, 2], c=[1, 3, 2])
    rows = statistical.kpss_report(df).collect()
    # the train part of b is one row and has no difference
    assert len(rows) == 5
    assert {(r.kpss_stat, r.kpss_verdict) for r in rows} == {(None, "undetermined")}


def test_lag_cap_can_be_lifted(make_series):
    assert diagnostics.acf(make_series(a=walk(60)), rows_per_lag=1).count() == 41
