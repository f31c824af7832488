"""Forecasts in plain DataFrame code: last value, linear trend, Holt at given weights."""

from functools import reduce

from pyspark.sql import functions as F

from tidecast.operators.series import SPLIT, packed_split, whole_series, with_split

ONE_STEP, MULTI_STEP = "one_step", "multi_step"
PREDICTION_COLUMNS = ["series", "date", "actual", "predicted", "model", "horizon_kind"]


def as_predictions(df, predicted, model, horizon_kind):
    """The common prediction columns, tagged with model name and kind of horizon."""
    return df.select(
        "series", "date", F.col("value").alias("actual"), predicted.alias("predicted"),
        F.lit(model).alias("model"), F.lit(horizon_kind).alias("horizon_kind"))


def union_predictions(frames):
    """All models' predictions in one table."""
    return reduce(lambda a, b: a.unionByName(b),
                  [f.select(*PREDICTION_COLUMNS) for f in frames])


def last_value(series_df, fraction=SPLIT):
    """The last train value, repeated over the test part.

    Series without a train row have nothing to repeat and are left out.
    """
    in_train = F.when(F.col("split") == "train", F.col("value"))
    known = with_split(series_df, fraction).select(
        "*", F.last(in_train, ignorenulls=True).over(whole_series()).alias("_last"))
    test = known.filter((F.col("split") == "test") & F.col("_last").isNotNull())
    return as_predictions(test, F.col("_last"), "Last Value", MULTI_STEP)


def linear_trend(series_df, fraction=SPLIT):
    """Least-squares line through the train part over the row index, extrapolated.

    A train part of one row is a flat line.
    """
    indexed = with_split(series_df, fraction).withColumn("idx", F.col("rn") - 1)
    y = F.when(F.col("split") == "train", F.col("value"))
    fitted = indexed.select(
        "*",
        F.regr_slope(y, F.col("idx")).over(whole_series()).alias("_slope"),
        F.avg(y).over(whole_series()).alias("_y"),
        F.avg(F.when(y.isNotNull(), F.col("idx"))).over(whole_series()).alias("_x"))
    test = fitted.filter((F.col("split") == "test") & F.col("_y").isNotNull())
    line = F.col("_y") + F.coalesce("_slope", F.lit(0.0)) * (F.col("idx") - F.col("_x"))
    return as_predictions(test, line, "Linear Trend", MULTI_STEP)


def _holt_pass(values, alpha, beta):
    """Level, trend and squared error of one Holt pass over an array, inside the JVM.

    Starts at the first value with the first step as trend; a single value stays level.
    """
    first = F.get(values, F.lit(0))
    rise = F.coalesce(F.get(values, F.lit(1)) - first, F.lit(0.0))
    start = F.struct(first.alias("level"), rise.alias("trend"), F.lit(0.0).alias("sse"))

    def step(state, y):
        ahead = state["level"] + state["trend"]
        level = alpha * y + (1 - alpha) * ahead
        trend = beta * (level - state["level"]) + (1 - beta) * state["trend"]
        miss = y - ahead
        return F.struct(level.alias("level"), trend.alias("trend"),
                        (state["sse"] + miss * miss).alias("sse"))

    return F.aggregate(F.slice(values, F.lit(2), F.size(values)), start, step)


def holt_states(series_df, grid, fraction=SPLIT):
    """Final level, trend and SSE for every (alpha, beta) of ``grid``, per series.

    Every pair reads the one packed array of the series; nothing is replicated.
    Series without a train row are left out.
    """
    packed = packed_split(series_df, fraction).filter(F.size("train") > 0)
    passes = F.array(*[
        F.struct(F.lit(float(a)).alias("alpha"), F.lit(float(b)).alias("beta"),
                 _holt_pass(F.col("train"), F.lit(float(a)), F.lit(float(b))).alias("end"))
        for a, b in grid])
    return (packed.select("series", "test", F.inline(passes))
            .select("series", "test", "alpha", "beta", "end.level", "end.trend", "end.sse"))


def holt_on_grid(series_df, grid, model="Holt-Winters", fraction=SPLIT):
    """Forecast from the grid point of lowest SSE: level + h * trend.

    A train part of one row has no trend, so its value is repeated. Errors that agree to
    eight digits count as equal, and the first of their points is taken: in short series
    several points fit alike.
    """
    packed = packed_split(series_df, fraction).filter(F.size("train") > 0)
    passes = [
        _holt_pass(F.col("train"), F.lit(float(a)), F.lit(float(b))) for a, b in grid]
    ranked = F.array_min(F.array(*[
        F.struct(F.round(F.log1p(p["sse"]), 8).alias("sse"), F.lit(i).alias("i"),
                 p["level"].alias("level"), p["trend"].alias("trend")) for i, p in enumerate(passes)]))
    test = (packed.select("series", "test", ranked.alias("best"))
            .select("series", "best", F.posexplode("test").alias("h", "row"))
            .select("series", F.col("row.date").alias("date"),
                    F.col("row.value").alias("value"),
                    (F.col("best.level") + (F.col("h") + 1) * F.col("best.trend"))
                    .alias("_ahead")))
    return as_predictions(test, F.col("_ahead"), model, MULTI_STEP)
