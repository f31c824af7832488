"""Comparison tables over predictions and metrics."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidecast.operators.evaluate import METRICS
from tidecast.session import shared_dir

# fixed values: model names as they appear in the result files
MODELS = ["Linear Regression", "Random Forest", "GBT", "ARIMA", "Holt-Winters"]


def leaderboard(metric_df):
    """Mean of every metric by model, rounded to 4 decimals, lowest RMSE first."""
    return (metric_df.groupBy("model")
            .agg(*[F.round(F.avg(m), 4).alias(m) for m in METRICS])
            .orderBy("rmse", "model"))


def overall_best(metric_df):
    """The model with the lowest mean RMSE."""
    return leaderboard(metric_df).agg(
        F.min_by("model", F.struct("rmse", "model")).alias("model"),
        F.min("rmse").alias("rmse"))


def labelled(report):
    """Metric columns under the names a reader sees."""
    return report.withColumnsRenamed(
        {"mae": "MAE", "rmse": "RMSE", "mape": "MAPE (%)", "r2": "R²"})


def model_order(metric_df):
    """Model names in leaderboard order. One row per model reaches the driver."""
    return [r["model"] for r in leaderboard(metric_df).select("model").collect()]


def metric_matrix(metric_df, metric, models):
    """Series by model; ``models`` gives the columns and their order, gaps are null."""
    return (metric_df.groupBy("series").pivot("model", models).agg(F.avg(metric))
            .select("series", *[F.col(f"`{m}`") for m in models]))


def metric_matrix_ranked(metric_df):
    """(series, models, mae, rmse, mape, r2): every series' cells in leaderboard order.

    Models are ranked within the plan: ``models`` holds their names, lowest mean RMSE first,
    and each metric is an array with one cell per name, null where a series lacks the model.
    Repeated rows of a model count by their mean, as in ``metric_matrix``.
    """
    ranked = leaderboard(metric_df).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("rmse", "model"))), lambda m: m["model"])).scalar()
    gathered = metric_df.groupBy("series").agg(
        F.collect_list(F.struct("model", *METRICS)).alias("_rows")).withColumn("models", ranked)

    def cells(metric):
        def mean(model):
            values = F.transform(F.filter(
                "_rows", lambda r: (r["model"] == model) & r[metric].isNotNull()),
                lambda r: r[metric])
            total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
            return F.when(F.size(values) > 0, total / F.size(values))
        return F.transform("models", mean)
    return gathered.select("series", "models", *[cells(m).alias(m) for m in METRICS])


def metric_grid(metric_df, models):
    """Every series with every model, in the given order, gaps null.

    One grouping gathers a series' few rows, from which each cell is looked up; the
    metrics are read once.
    """
    names = F.array(*[F.lit(m) for m in models])
    gathered = metric_df.groupBy("series").agg(
        F.collect_list(F.struct("model", *METRICS)).alias("_rows"))
    grid = gathered.select("series", "_rows", F.posexplode(names).alias("position", "model"))
    cell = F.get(F.filter("_rows", lambda row: row["model"] == F.col("model")), F.lit(0))
    return grid.select("series", "position", "model",
                       *[cell[m].alias(m) for m in METRICS])


def metric_long(metric_df):
    """(series, model, metric, value), as a bar chart reads it."""
    return metric_df.select("series", "model", *METRICS).unpivot(
        ["series", "model"], METRICS, "metric", "value")


def best_per_series(metric_df):
    """The row of the lowest RMSE of every series; the name decides between equals."""
    order = W.partitionBy("series").orderBy(F.col("rmse").asc_nulls_last(), "model")
    return (metric_df.withColumn("_rank", F.row_number().over(order))
            .filter(F.col("_rank") == 1)
            .select("series", F.col("model").alias("best_model"),
                    F.round("rmse", 2).alias("rmse"), F.round("r2", 4).alias("r2"),
                    F.round("mae", 2).alias("mae"), F.round("mape", 2).alias("mape")))


def win_counts(metric_df):
    """Number of series won by each model, most first; models without a win are absent."""
    return (best_per_series(metric_df).groupBy(F.col("best_model").alias("model"))
            .agg(F.count(F.lit(1)).alias("wins")).orderBy(F.desc("wins"), "model"))


def _stored(report):
    """The report in the checkpoint folder, so that what is behind it is worked out once."""
    shared_dir(report.sparkSession)
    return report.checkpoint()


def flag_best(report, lowest=("mae", "rmse", "mape"), highest=("r2",), within=None):
    """Boolean column per metric marking its best value, all ties included.

    ``within`` limits the comparison to rows of equal key (the models of a series).
    Without it the extremes of the whole report come from one aggregate, so that no
    window has to hold the report; it is stored first, as it is read twice.
    """
    flags = []
    extremes = [(c, F.min(c)) for c in lowest] + [(c, F.max(c)) for c in highest]
    if within is not None:
        group = W.partitionBy(within)
        flags = [(F.col(c) == best.over(group)).alias(f"best_{c}") for c, best in extremes]
        return report.select("*", *flags)
    report = _stored(report)
    best = report.agg(F.struct(*[e.alias(c) for c, e in extremes]).alias("best")).scalar()
    return report.select(
        "*", *[(F.col(c) == best[c]).alias(f"best_{c}") for c, _ in extremes])


def series_metric_table(metric_df):
    """Per series: models by RMSE, numbered, best values marked."""
    order = W.partitionBy("series").orderBy(F.col("rmse").asc_nulls_last(), "model")
    return flag_best(
        metric_df.select("*", F.row_number().over(order).alias("no")), within="series")


def number_rows(report, *order):
    """1-based ``no`` in the given order, for a report of any length.

    Sorted ranges are numbered side by side: a row's number is its place in its range
    plus the rows of the ranges before it. The ranges are written to the checkpoint
    folder first, so a lost executor cannot shift them between the two reads; before them
    the report itself, which is read to find the ranges and again to fill them.
    """
    placed = (_stored(report).repartitionByRange(*order).sortWithinPartitions(*order)
              .select("*", F.monotonically_increasing_id().alias("_id")).checkpoint())
    # the id holds the partition above bit 33 and the place in it below
    part = F.shiftright("_id", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per partition of the sort
    before = counts.select(
        "_part", (F.sum("_rows").over(W.orderBy("_part")) - F.col("_rows")).alias("_before"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("_part", part).withColumn("_place", place)
            .join(before, "_part")
            .withColumn("no", F.col("_before") + F.col("_place") + 1)
            .select("no", *report.columns))


def forecast_overlay(split_df, predictions, models):
    """Train, actual and one column per model on a single date axis.

    ``split_df`` is the split series. A full outer join keeps predictions of series whose
    observations are not at hand; their actuals come from the prediction.
    """
    wide = (predictions.groupBy("series", "date")
            .agg(F.max("actual").alias("_actual"),
                 *[F.max(F.when(F.col("model") == m, F.col("predicted"))).alias(m)
                   for m in models]))
    joined = split_df.select("series", "date", "split", "value").join(
        wide, ["series", "date"], "full")
    is_train = F.coalesce(F.col("split"), F.lit("test")) == "train"
    return joined.select(
        "series", "date",
        F.when(is_train, F.col("value")).alias("train"),
        F.when(~is_train, F.coalesce("value", "_actual")).alias("actual"),
        *[F.col(f"`{m}`") for m in models])


def predictions_with_metrics(predictions, metric_df):
    """Predictions beside the accuracy of their series and model."""
    return predictions.join(metric_df, ["series", "model"])
