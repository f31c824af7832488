"""Published numbers as literals: the 43 test closes of one series and its accuracy rows."""

import datetime as dt

import pytest

from tidecast.operators import baselines, evaluate, reports, series

# fixed values: the test part of the published series TCX, in time order, and the train
# part's last close and length
TEST_CLOSES = [
    44850, 45000, 45000, 43500, 44750, 44300, 43650, 42200, 41750, 41950, 42800, 43500, 43100,
    41800, 41400, 40550, 41100, 39200, 37500, 38100, 38650, 40600, 41000, 40900, 40650, 39600,
    39400, 39300, 40000, 40800, 40500, 40000, 39150, 39200, 39800, 39450, 39500, 41000, 40800,
    40300, 41750, 40800, 40800]
LAST_TRAIN, TRAIN_ROWS = 44400, 171

# fixed values: published accuracy of the series (MAE, RMSE, MAPE, R²)
PUBLISHED = {
    "ARIMA": (3331.3953, 3754.1527, 8.3001, -2.9077),
    "GBT": (948.9849, 1249.1476, 2.3352, 0.5674),
    "Holt-Winters": (2759.0559, 3144.7329, 6.8795, -1.742),
    "Linear Regression": (680.2897, 856.8399, 1.6602, 0.7964),
    "Random Forest": (927.1798, 1223.214, 2.2832, 0.5851)}


@pytest.fixture
def published(spark):
    start = dt.date(2025, 1, 1)
    values = [LAST_TRAIN] * TRAIN_ROWS + TEST_CLOSES
    return spark.createDataFrame(
        [("TCX", start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)],
        "series string, date date, value double")


def test_split_counts(published):
    row = series.split_counts(published).first()
    assert (row.total, row.train, row.test) == (214, 171, 43)


def test_flat_forecast_has_the_published_arima_row(published):
    flat = baselines.last_value(published)
    assert {r.predicted for r in flat.collect()} == {44400.0}
    row = evaluate.evaluate(flat).first()
    assert (row.mae, row.rmse, row.mape, row.r2) == PUBLISHED["ARIMA"]


def test_published_rows_rank_the_models(spark):
    rows = spark.createDataFrame([("TCX", m, *v) for m, v in PUBLISHED.items()],
                                 "series string, model string, mae double, rmse double, "
                                 "mape double, r2 double")
    board = [r.model for r in reports.leaderboard(rows).collect()]
    assert board == ["Linear Regression", "Random Forest", "GBT", "Holt-Winters", "ARIMA"]
    assert [(r.model, r.wins) for r in reports.win_counts(rows).collect()] == [
        ("Linear Regression", 1)]
