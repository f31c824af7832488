"""Accuracy of predictions by series and model."""

from pyspark.sql import functions as F

METRICS = ["mae", "rmse", "mape", "r2"]
# decimals kept by the offline run and by the quick analysis
RUN_DIGITS = {"mae": 4, "rmse": 4, "mape": 4, "r2": 4}
QUICK_DIGITS = {"mae": 2, "rmse": 2, "mape": 2, "r2": 4}


def metrics(predictions):
    """MAE, RMSE, MAPE and R² per (series, model), unrounded.

    One grouped aggregate, combined on the map side. MAPE looks only at non-zero actuals
    and is null where there are none; R² is 0 where the actuals do not vary. The total
    sum of squares comes from the variance, whose partial states merge without the
    cancellation of a sum of squares less a squared sum.
    """
    error = F.col("actual") - F.col("predicted")
    sums = predictions.groupBy("series", "model").agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.when(F.col("actual") != 0, F.abs(F.try_divide(error, F.col("actual")))))
         * 100).alias("mape"),
        F.sum(error * error).alias("_ssr"),
        (F.var_pop("actual") * F.count("actual")).alias("_sst"),
    )
    r2 = F.when(F.col("_sst") == 0, F.lit(0.0)).otherwise(
        1 - F.try_divide(F.col("_ssr"), F.col("_sst")))
    return sums.select("series", "model", "mae", "rmse", "mape", r2.alias("r2"))


def round_metrics(metric_df, digits=None):
    digits = digits or RUN_DIGITS
    return metric_df.select(
        *[F.round(c, digits[c]).alias(c) if c in digits else F.col(c)
          for c in metric_df.columns])


def evaluate(predictions, digits=None):
    return round_metrics(metrics(predictions), digits)
