import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidecast.operators import evaluate, reports, series

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def make_predictions(spark):
    def make(**models):
        rows = [(s, DAY + dt.timedelta(days=i), float(y), float(p), m)
                for m, by_series in models.items() for s, pairs in by_series.items()
                for i, (y, p) in enumerate(pairs)]
        return spark.createDataFrame(
            rows, "series string, date date, actual double, predicted double, model string")
    return make


@pytest.fixture(scope="module")
def metric_df(spark):
    rows = [("a", "GBT", 1.0, 2.0, None, 0.9), ("a", "ARIMA", 3.0, 2.0, 5.0, 0.1),
            ("b", "GBT", 2.0, 9.0, 4.0, 0.2), ("b", "ARIMA", 2.0, 4.0, 4.0, 0.3),
            ("c", "GBT", 1.0, 1.0, 1.0, 0.5)]
    return spark.createDataFrame(
        rows, "series string, model string, mae double, rmse double, mape double, r2 double")


def test_metrics(make_predictions):
    out = evaluate.evaluate(make_predictions(m={"a": [(1, 2), (3, 3), (5, 2)]})).first()
    assert (out.mae, out.rmse) == (pytest.approx(1.3333), pytest.approx(1.8257))
    assert out.mape == pytest.approx(round((1 + 0.6) / 3 * 100, 4))
    assert out.r2 == pytest.approx(round(1 - 10 / 8, 4))


def test_metrics_on_degenerate_actuals(make_predictions):
    rows = {r.series: r for r in evaluate.evaluate(make_predictions(m={
        "zeros": [(0, 1), (0, 2)], "some": [(0, 1), (4, 2)], "flat": [(7, 6), (7, 7)],
        "exact": [(1, 1), (2, 2)]})).collect()}
    assert rows["zeros"].mape is None and rows["zeros"].r2 == 0.0
    assert rows["some"].mape == 50.0
    assert rows["flat"].r2 == 0.0
    assert rows["exact"].r2 == 1.0 and rows["exact"].rmse == 0.0


def test_total_squares_survive_a_large_level(make_predictions):
    pairs = [(1e9 + i, 1e9 + i + 0.5) for i in range(4)]
    assert evaluate.metrics(make_predictions(m={"a": pairs})).first().r2 == pytest.approx(0.8)


def test_quick_rounding(make_predictions):
    df = make_predictions(m={"a": [(3, 1.23456), (7, 7)]})
    out = evaluate.evaluate(df, evaluate.QUICK_DIGITS).first()
    assert (out.mae, out.rmse) == (0.88, 1.25)


def test_leaderboard(metric_df):
    rows = reports.leaderboard(metric_df).collect()
    assert [r.model for r in rows] == ["ARIMA", "GBT"]
    assert rows[1].mape == 2.5 and rows[1].rmse == 4.0
    assert reports.overall_best(metric_df).first().model == "ARIMA"
    assert reports.model_order(metric_df) == ["ARIMA", "GBT"]


def test_matrix_and_grid(metric_df):
    rows = {r.series: r for r in
            reports.metric_matrix(metric_df, "rmse", ["ARIMA", "GBT", "LR"]).collect()}
    assert rows["b"]["ARIMA"] == 4.0 and rows["c"]["ARIMA"] is None
    assert rows["c"]["LR"] is None
    grid = reports.metric_grid(metric_df, ["ARIMA", "GBT"])
    assert grid.count() == 6 and grid.filter("rmse is null").count() == 1


def test_best_row_is_taken_whole(metric_df):
    rows = {r.series: r for r in reports.best_per_series(metric_df).collect()}
    # a tie at 2.0 goes to the first name
    assert rows["a"].best_model == "ARIMA" and rows["a"].mape == 5.0
    assert rows["b"].best_model == "ARIMA" and rows["c"].best_model == "GBT"
    wins = [(r.model, r.wins) for r in reports.win_counts(metric_df).collect()]
    assert wins == [("ARIMA", 2), ("GBT", 1)]


def test_null_metrics_do_not_win(spark):
    df = spark.createDataFrame([("a", "x", 1.0, None, 1.0, 1.0), ("a", "y", 2.0, 5.0, 1.0, 0.0)],
                               "series string, model string, mae double, rmse double, "
                               "mape double, r2 double")
    assert reports.best_per_series(df).first().best_model == "y"


def test_flags_mark_all_ties(metric_df):
    rows = {(r.series, r.model): r for r in reports.series_metric_table(metric_df).collect()}
    assert rows["a", "ARIMA"].best_rmse and rows["a", "GBT"].best_rmse
    assert rows["a", "ARIMA"].no == 1 and rows["a", "GBT"].no == 2
    assert rows["a", "GBT"].best_mape is None
    whole = reports.flag_best(reports.best_per_series(metric_df)).collect()
    assert [r.series for r in whole if r.best_rmse] == ["c"]


def test_metric_long(metric_df):
    assert reports.metric_long(metric_df).count() == 20


def test_numbering_matches_the_sort(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1009).alias("k"))
    rows = reports.number_rows(df, "k").orderBy("no").collect()
    assert [r.no for r in rows] == list(range(1, 1001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)


def test_overlay_keeps_predictions_without_observations(make_series, make_predictions):
    observed = series.with_split(make_series(start=DAY, a=[1, 2, 3, 4, 5]))
    predictions = make_predictions(
        GBT={"a": [(0, 0)] * 4 + [(5, 4.5)], "z": [(8, 7)]},
        ARIMA={"z": [(8, 6)]}).filter("series = 'z' or date = '2024-01-05'")
    rows = {(r.series, r.date.day): r for r in reports.forecast_overlay(
        observed, predictions, ["GBT", "ARIMA"]).collect()}
    assert len(rows) == 6
    assert rows["a", 1].train == 1.0 and rows["a", 1].actual is None
    assert rows["a", 5].actual == 5.0 and rows["a", 5].GBT == 4.5
    assert rows["z", 1].actual == 8.0 and rows["z", 1].ARIMA == 6.0


def test_lookup(make_predictions, metric_df):
    predictions = make_predictions(GBT={"a": [(1, 1)], "q": [(1, 1)]})
    out = reports.predictions_with_metrics(predictions, metric_df).collect()
    assert [(r.series, r.rmse) for r in out] == [("a", 2.0)]


@pytest.mark.parametrize("report", [
    reports.flag_best, lambda df: reports.number_rows(df, "series")])
def test_a_report_is_worked_out_once(spark, metric_df, report):
    """F8, F12: what is behind a report runs once, however often the report is read."""
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch
    best = reports.best_per_series(metric_df)
    rows = report(best.mapInArrow(counted, best.schema)).collect()
    assert len(rows) == runs.value == 3
