import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidecast.operators import diagnostics, features, series

LENGTHS = [1, 2, 5, 11, 12, 19, 20, 214]


@pytest.fixture(scope="module")
def lengths(make_series):
    return make_series(**{f"s{n}": range(1, n + 1) for n in LENGTHS}).cache()


def test_one_row_per_day(spark):
    rows = [("a", "2024-01-01", 1.0, 1), ("a", "2024-01-01", 5.0, 2),
            ("a", "2024-01-01", 3.0, 3), ("a", None, 9.0, 4), ("a", "2024-01-02", None, 5)]
    raw = spark.createDataFrame(rows, "k string, d string, v double, o int")
    day = F.to_date("d")
    by_order = series.to_series(raw, F.col("k"), day, F.col("v"), F.col("o")).collect()
    assert [(r.series, r.date, r.value) for r in by_order] == [
        ("a", dt.date(2024, 1, 1), 3.0)]
    greatest = series.to_series(raw, F.col("k"), day, F.col("v")).collect()
    assert [r.value for r in greatest] == [5.0]


@pytest.mark.parametrize("n,train", [(1, 0), (2, 1), (5, 4), (11, 8), (12, 9), (19, 15),
                                     (20, 16), (214, 171)])
def test_split_sizes(lengths, n, train):
    one = lengths.filter(F.col("series") == f"s{n}")
    row = series.split_counts(one).first()
    assert (row.total, row.train, row.test) == (n, train, n - train)
    labels = [r.split for r in series.with_split(one).orderBy("date").collect()]
    assert labels == ["train"] * train + ["test"] * (n - train)


def test_machine_learning_rows_of_214(lengths):
    one = lengths.filter(F.col("series") == "s214")
    rows = features.complete_rows(features.add_features(one))
    assert rows.filter("split = 'train'").count() == 161
    assert rows.filter("split = 'test'").count() == 43


def test_length_gate(lengths):
    kept = series.long_enough(lengths, 20).select("series").distinct().collect()
    assert sorted(r.series for r in kept) == ["s20", "s214"]
    report = {r.series: r.status for r in series.length_report(lengths, 20).collect()}
    assert report["s19"] == "rejected" and report["s20"] == "accepted"


def test_load_summary(lengths):
    row = series.load_summary(lengths).first()
    assert (row.n_rows, row.n_series) == (sum(LENGTHS), len(LENGTHS))
    empty = series.load_summary(lengths.filter("false")).first()
    assert (empty.n_rows, empty.n_series) == (0, 0)


def test_membership(spark, lengths):
    wanted = spark.createDataFrame([("s5",), ("none",)], "series string")
    assert series.only_series(lengths, wanted).count() == 5
    assert series.only_series(lengths, wanted.filter("series = 'none'")).count() == 0


def grid(spark, rows):
    df = spark.createDataFrame([("a", d, v) for d, v in rows],
                               "series string, date string, value double")
    out = series.business_days(df.withColumn("date", F.to_date("date")))
    return [(r.date.isoformat(), r.value) for r in out.orderBy("date").collect()]


def test_weekend_is_not_carried(spark):
    # Friday, Saturday, Tuesday
    assert grid(spark, [("2024-01-05", 1.0), ("2024-01-06", 2.0), ("2024-01-09", 3.0)]) == [
        ("2024-01-05", 1.0), ("2024-01-08", 1.0), ("2024-01-09", 3.0)]


def test_weekend_start_and_end(spark):
    # Saturday, Tuesday, Sunday: no value before Tuesday, the week is filled to Friday
    rows = [("2024-01-06", 1.0), ("2024-01-09", 2.0), ("2024-01-14", 3.0)]
    assert grid(spark, rows) == [("2024-01-09", 2.0), ("2024-01-10", 2.0),
                                 ("2024-01-11", 2.0), ("2024-01-12", 2.0)]


def test_weekend_only_series_vanishes(spark):
    assert grid(spark, [("2024-01-06", 1.0)]) == []


def test_features_see_only_the_past(make_series):
    base = [float((7 * i) % 11) for i in range(40)]
    bent = base[:25] + [999.0] + base[26:]
    def rows(values):
        df = features.add_features(make_series(a=values)).orderBy("date")
        return [tuple(r[c] for c in features.FEATURES) for r in df.collect()]
    assert rows(base)[:26] == rows(bent)[:26]
    assert rows(base)[26] != rows(bent)[26]


def test_trailing_windows_allow_partial_frames(make_series):
    rows = features.add_features(make_series(a=[1, 2, 4, 8])).orderBy("date").collect()
    assert [r.rmean5 for r in rows] == [None, 1.0, 1.5, pytest.approx(7 / 3)]
    assert [r.rstd5 is None for r in rows] == [True, True, False, False]
    assert [r.dow for r in rows] == [2, 3, 4, 5]


def test_full_window_needs_twenty_rows(make_series):
    rows = features.rolling_full(make_series(a=range(1, 31))).orderBy("date").collect()
    assert len(rows) == 24
    assert all(r.roll_mean is None for r in rows[:19])
    assert rows[19].roll_mean == 10.5


def test_return_after_zero_is_null(make_series):
    rows = features.overview(make_series(a=[0, 5, 4, 4])).orderBy("date").collect()
    assert [r.return_pct for r in rows] == [None, None, pytest.approx(-20.0), 0.0]
    assert [r.direction for r in rows] == ["up", "up", "down", "up"]


def test_first_difference_drops_the_first_row(make_series):
    rows = features.first_difference(make_series(a=[1, 4, 9, 16, 25])).orderBy("date")
    assert [r["diff"] for r in rows.collect()] == [3.0, 5.0, 7.0]


def test_business_days_are_counted_without_being_made(spark):
    """the counts of the grid, at no row for each of its days."""
    start = dt.date(1969, 12, 20)
    rows = [(f"s{i}", start + dt.timedelta(days=i + k * k * (1 + i % 4)), 1.0)
            for i in range(21) for k in range(1 + i % 5)]
    rows += [("weekend", dt.date(2024, 1, 6), 1.0), ("ends on sunday", dt.date(2024, 1, 5), 1.0),
             ("ends on sunday", dt.date(2024, 1, 14), 1.0), (None, dt.date(2024, 1, 3), None)]
    df = spark.createDataFrame(rows, "series string, date date, value double")
    made = series.split_counts(series.business_days(df)).collect()
    counted = series.business_split_counts(df)
    assert sorted(counted.collect(), key=str) == sorted(made, key=str)
    short = diagnostics.undecomposable(df)
    assert {r.series: r.train_days for r in short.collect()} == {
        r.series: r.train for r in made if 0 < r.train < 10}
    assert "Generate" not in short._jdf.queryExecution().toString()
