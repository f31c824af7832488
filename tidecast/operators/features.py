"""Lag, rolling and calendar features. One shuffle and one sort serve them all."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidecast.operators.series import SPLIT, by_date, train_part, with_split

# fixed values: lags and trailing windows, in rows
LAGS = [1, 2, 3, 5, 10]
WINDOWS = [5, 10, 20]

FEATURES = (
    [f"lag{k}" for k in LAGS]
    + [f"rmean{k}" for k in WINDOWS]
    + [f"rstd{k}" for k in WINDOWS]
    + ["dow", "month"]
)


def lag_columns():
    return [F.lag("value", k).over(by_date()).alias(f"lag{k}") for k in LAGS]


def trailing_columns():
    """Mean and sample deviation of the rows before the current one.

    The current row stays out, so a feature never sees the value it predicts; the first
    rows of a series use what history there is.
    """
    frames = {k: by_date().rowsBetween(-k, -1) for k in WINDOWS}
    return ([F.avg("value").over(frames[k]).alias(f"rmean{k}") for k in WINDOWS]
            + [F.stddev_samp("value").over(frames[k]).alias(f"rstd{k}") for k in WINDOWS])


def calendar_columns():
    """Day of week (1 is Sunday) and month."""
    return [F.dayofweek("date").alias("dow"), F.month("date").alias("month")]


def add_features(series_df, fraction=SPLIT):
    """Canonical series to feature rows with ``rn``, ``n`` and ``split``."""
    return with_split(series_df, fraction).select(
        "*", *lag_columns(), *trailing_columns(), *calendar_columns())


def complete_rows(features_df):
    """Rows on which every feature is known."""
    return features_df.dropna(subset=FEATURES + ["value"])


def assembler():
    return VectorAssembler(inputCols=FEATURES, outputCol="features")


def assemble(features_df):
    return assembler().transform(complete_rows(features_df))


def rolling_full(series_df, window=20, fraction=SPLIT):
    """Rolling mean and deviation of the train part, current row included.

    Null until the window is full.
    """
    frame = by_date().rowsBetween(-(window - 1), 0)
    full = F.count("value").over(frame) == window
    return train_part(series_df, fraction).select(
        "series", "date", "value",
        F.when(full, F.avg("value").over(frame)).alias("roll_mean"),
        F.when(full, F.stddev_samp("value").over(frame)).alias("roll_std"))


def overview(series_df, fraction=SPLIT):
    """Value, split, return in percent against the previous row, and its direction.

    The return is null on the first row and after a zero.
    """
    change = F.try_divide(F.col("value"), F.lag("value", 1).over(by_date())) - 1
    return (with_split(series_df, fraction)
            .select("series", "date", "value", "split", (change * 100).alias("return_pct"))
            .withColumn("direction",
                        F.when(F.col("return_pct") < 0, "down").otherwise("up")))


def first_difference(series_df, fraction=SPLIT):
    """Train values with their change against the previous row; the first row is dropped."""
    step = F.col("value") - F.lag("value", 1).over(by_date())
    return (train_part(series_df, fraction)
            .select("series", "date", "rn", "value", step.alias("diff"))
            .filter(F.col("rn") > 1))
