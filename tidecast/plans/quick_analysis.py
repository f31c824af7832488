"""Quick analysis of uploaded series: two forecasts and the diagnostic tables."""

from pyspark.sql import functions as F

from tidecast.operators import diagnostics, features, statistical
from tidecast.operators.baselines import linear_trend, union_predictions
from tidecast.operators.evaluate import QUICK_DIGITS, evaluate
from tidecast.operators.series import long_enough, split_counts
from tidecast.session import shared_dir
from tidecast.sources.schema import MIN_ROWS


def _forecast(kept):
    return union_predictions(
        [linear_trend(kept), statistical.holt_predictions(statistical.holt_fits(kept))])


def quick_forecast(series_df):
    """Linear trend and Holt over the test part of every series that is long enough."""
    return _forecast(long_enough(series_df, MIN_ROWS))


def quick_metrics(series_df):
    return evaluate(quick_forecast(series_df), QUICK_DIGITS)


#: Rows of the train part for each lag of an uploaded series' correlogram.
ROWS_PER_LAG = 3


def quick_analysis(series_df):
    """Every table of the analysis, by name: the diagnostics, lazy, and the forecast with its
    metrics, fitted once and checkpointed."""
    kept = long_enough(series_df, MIN_ROWS)
    shared_dir(series_df.sparkSession)
    forecast = _forecast(kept).checkpoint()
    return diagnostic_tables(kept) | {
        "forecast": forecast, "metrics": evaluate(forecast, QUICK_DIGITS)}


def diagnostic_tables(kept):
    """The tables that need no forecast, of series that are long enough."""
    described = diagnostics.describe(kept)
    return {
        "split_counts": split_counts(kept),
        "describe": described.select(
            "series", "count", *[F.round(c, 2).alias(c) for c in described.columns[2:]]),
        "overview": features.overview(kept),
        "rolling": features.rolling_full(kept),
        "difference": features.first_difference(kept),
        "stationarity": statistical.stationarity_report(kept),
        "correlograms": diagnostics.correlograms(kept, rows_per_lag=ROWS_PER_LAG),
    }
