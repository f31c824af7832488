
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import baselines, pooled, statistical
from tidecast.operators.features import FEATURES
from tidecast.plans.forecast_run import forecast_run, run_and_save
from tidecast.plans.quick_analysis import quick_analysis, quick_metrics
from tidecast.sources import sinks


def walk(n, seed):
    return (100 + np.random.default_rng(seed).normal(size=n).cumsum()).tolist()


def predicted(df, name="a"):
    return [r.predicted for r in df.filter(F.col("series") == name).orderBy("date").collect()]


def test_last_value(make_series):
    df = make_series(a=[1, 2, 3, 4, 9], b=[7])
    assert predicted(baselines.last_value(df)) == [4.0]
    assert predicted(baselines.last_value(df), "b") == []


def test_linear_trend(make_series):
    df = make_series(a=[1, 3, 5, 7, 9, 11, 13, 15, 0, 0], b=[4, 6])
    assert predicted(baselines.linear_trend(df)) == pytest.approx([17.0, 19.0])
    assert predicted(baselines.linear_trend(df), "b") == [4.0]


def test_holt_on_grid_takes_the_better_point(make_series):
    values = walk(50, 1)
    df = make_series(a=values)
    states = baselines.holt_states(df, [(0.9, 0.1), (0.2, 0.1)]).orderBy("sse").first()
    out = predicted(baselines.holt_on_grid(df, [(0.9, 0.1), (0.2, 0.1)]))
    steps = np.arange(1, 11)
    assert out == pytest.approx((states.level + steps * states.trend).tolist())


def test_holt_forecast_beats_the_grid(make_series):
    df = make_series(a=walk(80, 2))
    fitted = statistical.holt_fits(df).first()
    grid = baselines.holt_states(df, [(0.5, 0.1), (0.9, 0.1)]).agg(F.min("sse")).first()[0]
    assert fitted.fallback is None and fitted.sse <= grid


def test_failed_fits_say_so(make_series):
    df = make_series(a=[1, 2, 5], b=[3], c=walk(60, 3))
    holt = {r.series: r for r in statistical.holt_fits(df).collect()}
    assert set(holt) == {"a", "c"}
    assert "three values" in holt["a"].fallback and holt["c"].fallback is None
    arima = statistical.arima_fits(df)
    orders = {r.series: r for r in statistical.arima_orders(arima).collect()}
    assert "too few" in orders["a"].fallback and orders["a"].p is None
    assert orders["c"].fallback is None and 0 <= orders["c"].d <= 2
    assert predicted(statistical.arima_predictions(arima)) == [2.0]
    assert [r.series for r in statistical.unfitted(df).collect()] == ["b"]


def test_arima_covers_the_test_span(make_series):
    df = make_series(**{f"s{i}": walk(50 + i, i) for i in range(20)})
    out = statistical.arima_predictions(statistical.arima_fits(df))
    assert out.count() == sum(n - int(n * 0.8) for n in range(50, 70))
    assert out.filter(F.col("predicted").isNull()).count() == 0


def test_stationarity_verdicts(make_series):
    df = make_series(a=walk(300, 5), b=[4] * 40, c=[1, 2])
    rows = {(r.series, r.variant): r for r in statistical.stationarity_report(df).collect()}
    assert rows["a", "level"].adf_verdict == "not stationary"
    assert rows["a", "difference"].adf_verdict == "stationary"
    assert rows["a", "difference"].kpss_verdict == "stationary"
    assert rows["b", "level"].adf_verdict == "undetermined"
    assert rows["c", "level"].adf_p is None


def test_pooled_regression_is_the_closed_form_ridge(make_series):
    df = make_series(a=walk(90, 6), b=walk(70, 7))
    rows = pooled.training_rows(df).cache()
    model = pooled.fit_pooled(rows, "Linear Regression").stages[-1]
    train = rows.filter("split = 'train'").toPandas()
    x, y = train[FEATURES].to_numpy(float), train["value"].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    penalty = 0.05 / y.std()
    beta = np.linalg.solve(z.T @ z / len(y) + penalty * np.eye(z.shape[1]),
                           z.T @ (y - y.mean()) / len(y)) / x.std(0)
    assert np.allclose(model.coefficients.toArray(), beta, rtol=1e-6, atol=1e-9)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ beta)


def test_published_parameters():
    forest, boosted = pooled.regressor("Random Forest"), pooled.regressor("GBT")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 10, 42)
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getSeed()) == (100, 6, 42)
    with pytest.raises(ValueError):
        pooled.regressor("Oracle")


def test_forest_is_reproducible(make_series):
    df = make_series(a=walk(90, 8), b=walk(90, 9))
    first, second = (sorted(tuple(r) for r in pooled.pooled_forecast(
        df, ["Random Forest"])[0].collect()) for _ in range(2))
    assert first == second


@pytest.fixture
def light_trees(monkeypatch):
    full = pooled.regressor
    def light(name):
        model = full(name)
        if name == "Random Forest":
            model.setNumTrees(5)
        if name == "GBT":
            model.setMaxIter(2)
        return model
    monkeypatch.setattr(pooled, "regressor", light)


def test_forecast_run(make_series, light_trees):
    df = make_series(a=walk(100, 10), b=walk(60, 11))
    run = forecast_run(df)
    metrics = run.metrics.collect()
    assert {(r.series, r.model) for r in metrics} == {
        (s, m) for s in "ab" for m in
        ["Linear Regression", "Random Forest", "GBT", "ARIMA", "Holt-Winters"]}
    kinds = {r.model: r.horizon_kind for r in
             run.predictions.select("model", "horizon_kind").distinct().collect()}
    assert kinds["GBT"] == "one_step" and kinds["ARIMA"] == "multi_step"
    assert run.orders.count() == 2
    run.release()


def test_run_and_save(spark, make_series, light_trees, tmp_path):
    df = make_series(a=walk(100, 10), b=walk(60, 11))
    result = run_and_save(df, str(tmp_path))
    assert result["leaderboard"].count() == 5
    assert result["best"].count() == 1
    saved = sinks.read_predictions(spark, str(tmp_path))
    text = sinks.read_predictions_csv(spark, f"{tmp_path}/predictions.csv")
    assert saved.count() == text.count() == 5 * (20 + 12)
    assert text.first().model == "ARIMA"
    assert saved.filter("model = 'GBT'").count() == 32


def test_quick_analysis(make_series):
    df = make_series(a=walk(100, 12), b=range(10))
    assert {r.series for r in quick_metrics(df).collect()} == {"a"}
    tables = quick_analysis(df)
    sizes = {name: table.count() for name, table in tables.items()}
    assert sizes == {"split_counts": 1, "describe": 1, "overview": 100, "rolling": 80,
                     "difference": 79, "stationarity": 2, "correlograms": 2 * 27,
                     "forecast": 40, "metrics": 2}


def test_forest_ignores_the_session(spark, make_series):
    df = make_series(**{f"s{i}": walk(60, i) for i in range(6)})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in ("2", "4", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            for name in ("Random Forest", "GBT"):
                model = pooled.regressor(name)
                assert model.getSeed() == 42
            found.append(sorted(tuple(r) for r in pooled.pooled_forecast(
                df, ["Random Forest"])[0].collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]


def test_short_load_runs_without_pooled_models(make_series):
    run = forecast_run(make_series(a=walk(11, 1)))
    assert {r.model for r in run.metrics.collect()} == {"ARIMA", "Holt-Winters"}
    assert set(run.skipped) == set(pooled.POOLED)
    orders = run.orders.first()
    assert orders.fallback is None and orders.converged is not None
    run.release()


def test_every_baseline_predicts_the_same_rows(make_series):
    df = make_series(a=walk(9, 1), two=[1, 4], three=[2, 2, 5], one=[3])
    frames = [baselines.last_value(df), baselines.linear_trend(df),
              baselines.holt_on_grid(df, [(0.2, 0.1), (0.8, 0.1)])]
    rows = [{(r.series, r.date) for r in f.collect()} for f in frames]
    assert rows[0] == rows[1] == rows[2]
    assert predicted(frames[2], "two") == [1.0]


def test_only_numeric_failures_are_fallbacks():
    import pandas as pd

    def wrong(rows):
        raise TypeError("a coding error")
    with pytest.raises(TypeError):
        statistical._in_groups(pd.Series([[1.0, 2.0]]), wrong)

