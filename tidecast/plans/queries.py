"""Every query by name: (session, folder of the tables) to a DataFrame.

The SQL that must give the same rows is in ``oracles``. Doubles are rounded in both.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidecast.functions.text import (
    clean_number, iso_text, mark_missing, parse_day, parse_iso, year_part)
from tidecast.operators import (
    baselines, diagnostics, evaluate, features, pooled, reports, series, statistical, trees,
    unit_root)
from tidecast.plans.forecast_run import metrics_of_run, run_and_save
from tidecast.plans.quick_analysis import diagnostic_tables, quick_forecast, quick_metrics
from tidecast.session import scratch_path
from tidecast.sources import csv_scan, ingest, landing, pages, sinks, tables
from tidecast.sources.schema import MIN_ROWS, RAW_COLUMNS

QUERIES = {}

# smoothing weights of the fixed Holt passes
HOLT_GRID = [(a, b) for a in (0.2, 0.5, 0.8) for b in (0.05, 0.1, 0.2)]
BASELINES = ["Last Value", "Linear Trend", "Holt-Winters"]
URL_TEMPLATE = "https://data.example.com/%s/daily.htm"
# files of a load whose status is read together
UNITS_AT_ONCE = 10_000
LIST_NAMES = ["c1", "c2", "c3", "c4", "c5", "c6"]


def query(function):
    QUERIES[function.__name__] = function
    return function


def rounded(df, digits, *columns):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c)
                       for c in df.columns])


def baseline_predictions(source):
    """The three models whose predictions SQL can state.

    They share one placement of the series over all tasks.
    """
    source = series.spread(source)
    return baselines.union_predictions([
        baselines.last_value(source), baselines.linear_trend(source),
        baselines.holt_on_grid(source, HOLT_GRID)])


def supplier_metrics(spark, folder):
    return evaluate.evaluate(baseline_predictions(tables.supplier_bars(spark, folder)))


# --- sources and ingest ---

@query
def canonical_series(spark, folder):
    return tables.supplier_bars(spark, folder)


@query
def canonical_orders(spark, folder):
    return tables.customer_orders(spark, folder)


@query
def canonical_events(spark, folder):
    return tables.event_days(spark, folder)


@query
def load_summary(spark, folder):
    items = tables.read_table(spark, folder, "lineitem")
    orders = tables.read_table(spark, folder, "orders")
    lines = series.load_summaries(
        items, {"bars": F.col("l_returnflag"), "supplier_bars": F.col("l_suppkey")},
        F.to_date("l_shipdate"), F.col("l_extendedprice"))
    return lines.unionByName(series.load_summaries(
        orders, {"order_days": F.col("o_orderpriority"), "customer_orders": F.col("o_custkey")},
        F.to_date("o_orderdate"), F.col("o_totalprice")))


@query
def clean_numbers(spark, folder):
    text = tables.formatted_records(spark, folder)
    return text.select("Ticker", "Date", "Close_price",
                       clean_number("Close_price").alias("cleaned"))


@query
def parse_dates(spark, folder):
    text = tables.formatted_records(spark, folder)
    day = parse_day("Loose_date")
    return text.select("Ticker", "Date", "Loose_date", day.alias("day"),
                       iso_text(day).alias("iso"), parse_iso(iso_text(day)).alias("back"),
                       year_part("Date").alias("year"))


@query
def raw_text_series(spark, folder):
    """Cleaning, parsing, the null drop and the canonical form in one go."""
    return csv_scan.raw_to_series(tables.formatted_records(spark, folder))


@query
def csv_round_trip(spark, folder):
    """Raw files with the unit's own years in their keys, written, scanned back, summarised."""
    raw = tables.raw_records(spark, folder, placed=True)
    own = W.partitionBy("Ticker")
    year = F.year(parse_day("Date"))
    raw = raw.select("*", F.min(year).over(own).alias("_from"), F.max(year).over(own).alias("_to"))
    path = scratch_path(spark, "raw")
    csv_scan.write_raw(raw, path, F.col("_from"), F.col("_to"), compression="snappy")
    typed = csv_scan.typed_records(csv_scan.read_written(spark, path))
    return _summed(typed.groupBy("file_series", "year_from", "year_to"))


def _summed(grouped, *more):
    """Counts and sums over typed records that only come out if every column was read."""
    def whole(name):
        return F.round(F.sum(name), 0).cast("long")
    return grouped.agg(
        F.count("Close_price").alias("n_values"), F.count(F.lit(1)).alias("n_rows"),
        F.min("Date").alias("first_day"), F.max("Date").alias("last_day"),
        F.sum("No").alias("lines"), whole("Open_price").alias("parts"),
        whole("Market_cap").alias("orders"), whole("Total_volume").alias("quantity"),
        F.round(F.sum("Change"), 2).alias("discount"),
        F.round(F.sum("Change_percent"), 2).alias("tax"), *more)


def _three_layouts(spark, folder):
    """Records in files of three headers: in order, in reverse, and with another column."""
    raw = tables.raw_records(spark, folder)
    path = scratch_path(spark, "layouts")
    kind = F.pmod(F.col("Ticker").cast("long"), F.lit(3))
    layouts = [RAW_COLUMNS, RAW_COLUMNS[::-1], [c for c in RAW_COLUMNS if c != "Average"]]
    for i, columns in enumerate(layouts):
        some = raw.filter(kind == i).select(*columns)
        if i == 2:
            some = some.withColumn("Note", F.concat(F.lit("of "), F.col("Ticker")))
        some.write.csv(f"{path}/{i}", header=True)
    return path


@query
def scan_mixed_headers(spark, folder):
    """Files of three kinds of header read in one scan, columns matched by name.

    The averages of a series are those of all its groups, so one grouping serves both.
    """
    back = csv_scan.scan_files(spark, _three_layouts(spark, folder), "*/*.csv")
    typed = csv_scan.typed_records(back)
    groups = _summed(typed.filter(F.col("Ticker").isNotNull()).groupBy(
        F.col("Ticker").alias("series"), "Note"), F.count("Average").alias("averages"))
    return groups.withColumn("averages", F.sum("averages").over(W.partitionBy("series")))


@query
def ingest_files(spark, folder):
    """Status of the files of a load in which the units in debt are no text.

    Each unit is a file of its own, and the driver lists files, so the load arrives in parts
    of about ``UNITS_AT_ONCE`` units, and each part's status is stored before the next is read.
    """
    units = _units(spark, folder).join(
        tables.read_table(spark, folder, "supplier").select(
            F.col("s_suppkey").cast("string").alias("series"),
            (F.col("s_acctbal") < 0).alias("broken")), "series")
    path = scratch_path(spark, "load")
    line = F.when(F.col("broken"), F.unhex(F.lit("FFFE00FF")).cast("string")).otherwise("Ticker")
    units.select(csv_scan.file_key(F.col("series"), F.col("year_from"), F.col("year_to")).alias(
        "unit"), line.alias("value")).write.parquet(f"{path}/units")
    stored = spark.read.parquet(f"{path}/units")
    parts = stored.count() // UNITS_AT_ONCE + 1
    found = []
    for part in range(parts):
        some = stored.where(F.pmod(F.xxhash64("unit"), F.lit(parts)) == part)
        if parts > 1 and some.isEmpty():
            continue
        some.write.partitionBy("unit").text(f"{path}/part-{part}")
        found.append(csv_scan.file_status(spark, f"{path}/part-{part}", "unit=*/*.txt"))
    status = reduce(DataFrame.unionByName, found)
    named = status.withColumn("file_path", F.regexp_extract("file_path", "unit=([^/]+)", 1))
    return ingest.files_status(named)


@query
def dedupe_exact(spark, folder):
    """Whole records of a delivery that came twice."""
    items = tables.read_table(spark, folder, "lineitem")
    return ingest.drop_exact_duplicates(items.unionByName(items))


def _units(spark, folder):
    """One unit per supplier and the years its rows span."""
    return tables.supplier_bars(spark, folder).groupBy("series").agg(
        F.year(F.min("date")).alias("year_from"), F.year(F.max("date")).alias("year_to"))


@query
def skip_landed(spark, folder):
    """Units whose supplier has a negative balance count as not landed yet."""
    suppliers = tables.read_table(spark, folder, "supplier").filter("s_acctbal >= 0").select(
        F.col("s_suppkey").cast("string").alias("series"))
    units = _units(spark, folder)
    landed = units.join(suppliers, "series", "left_semi")
    return ingest.not_yet_landed(units, landed)


@query
def resume_after_failure(spark, folder):
    """Rows of each unit by the batch that landed it, after a load was killed and run again.

    The first batch lands the suppliers with a balance. The second is killed once its records
    are written, so that they stand there without a commit, and is then run twice.
    """
    rows = tables.supplier_bars(spark, folder)
    first = tables.read_table(spark, folder, "supplier").filter("s_acctbal >= 0").select(
        F.col("s_suppkey").cast("string").alias("series"))
    path = scratch_path(spark, "landing")
    landing.land(rows.join(first, "series", "left_semi"), path, "first")
    landing.write_records(rows, path, "second")
    landing.land(rows, path, "second")
    units = landing.land(rows, path, "second")
    found = landing.landed_records(spark, path, rows.schema).groupBy("series", "batch").agg(
        F.count(F.lit(1)).alias("n_found"), F.round(F.sum("value"), 2).alias("total"))
    return units.join(found, ["series", "batch"], "full")


@query
def upload_load(spark, folder):
    """Files from elsewhere: days without leading zeros, some with dashes, no known layout."""
    text = tables.formatted_records(spark, folder)
    return csv_scan.upload_to_series(text.select(
        "Ticker", F.col("Loose_date").alias("Date"), "Close_price"))


@query
def file_keys(spark, folder):
    return _units(spark, folder).select(
        "series", csv_scan.file_key(F.col("series"), F.col("year_from"),
                                    F.col("year_to")).alias("file_key"))


@query
def ingest_status(spark, folder):
    lengths = series.length_report(tables.customer_orders(spark, folder), 10)
    return ingest.ingest_status(lengths)


@query
def ingest_report(spark, folder):
    lengths = series.length_report(tables.customer_orders(spark, folder), 10)
    return ingest.ingest_summary(ingest.ingest_status(lengths))


@query
def page_rows(spark, folder):
    return pages.page_rows(tables.read_table(spark, folder, "pages"), row_tag="ul",
                           cell_tag="li", names=LIST_NAMES)


@query
def placeholder_cells(spark, folder):
    """Whole document texts, trimmed, the first run of five hashes marked."""
    html = tables.read_table(spark, folder, "pages")
    return html.select("page_id", mark_missing(
        F.concat(F.lit("  "), F.replace("html", F.lit("###"), F.lit("######")),
                 F.lit("\n"))).alias("cell"))


@query
def source_urls(spark, folder):
    return pages.source_urls(tables.supplier_bars(spark, folder), URL_TEMPLATE)


# --- series, split, windows ---

@query
def sorted_keys(spark, folder):
    return series.series_keys(tables.customer_orders(spark, folder))


@query
def split_counts(spark, folder):
    return series.split_counts(tables.customer_orders(spark, folder))


@query
def split_rows(spark, folder):
    return series.with_split(tables.customer_orders(spark, folder))


@query
def test_rows_of_split(spark, folder):
    return series.with_split(tables.supplier_bars(spark, folder)).filter(
        F.col("split") == "test").select("series", "date", "value")


@query
def time_index(spark, folder):
    return series.time_index(tables.supplier_bars(spark, folder))


@query
def min_length_gate(spark, folder):
    return series.long_enough(tables.customer_orders(spark, folder), 10)


@query
def length_report(spark, folder):
    return series.length_report(tables.customer_orders(spark, folder), MIN_ROWS)


@query
def membership_lookup(spark, folder):
    suppliers = tables.read_table(spark, folder, "supplier").filter("s_acctbal < 0").select(
        F.col("s_suppkey").cast("string").alias("series"))
    return series.only_series(tables.supplier_bars(spark, folder), suppliers)


@query
def lag_features(spark, folder):
    return tables.supplier_bars(spark, folder).select("*", *features.lag_columns())


@query
def trailing_stats(spark, folder):
    out = tables.supplier_bars(spark, folder).select(
        "series", "date", *features.trailing_columns())
    return rounded(out, 6, *out.columns[2:])


@query
def feature_complete_rows(spark, folder):
    out = features.complete_rows(features.add_features(tables.supplier_bars(spark, folder)))
    return rounded(out, 6, *[c for c in out.columns if c.startswith(("rmean", "rstd"))])


@query
def rolling20_full(spark, folder):
    out = features.rolling_full(tables.bars(spark, folder))
    return rounded(out, 6, "roll_mean", "roll_std")


@query
def daily_return(spark, folder):
    return rounded(features.overview(tables.supplier_bars(spark, folder)), 6, "return_pct")


@query
def first_difference(spark, folder):
    return rounded(features.first_difference(tables.supplier_bars(spark, folder)), 4, "diff")


@query
def bday_fill(spark, folder):
    return series.business_days(tables.order_days(spark, folder))


@query
def bday_fill_sparse(spark, folder):
    return series.business_days(tables.customer_orders(spark, folder))


# --- diagnostics ---

@query
def describe_series(spark, folder):
    out = diagnostics.describe(tables.supplier_bars(spark, folder))
    return rounded(out, 6, *out.columns[2:])


@query
def acf_band(spark, folder):
    out = diagnostics.acf(tables.supplier_bars(spark, folder))
    return rounded(out, 6, "value", "lo", "hi")


@query
def pacf_band(spark, folder):
    out = diagnostics.pacf(tables.supplier_bars(spark, folder))
    return rounded(out, 6, "value", "lo", "hi")


@query
def correlogram_bars(spark, folder):
    out = diagnostics.correlograms(tables.bars(spark, folder))
    return rounded(out, 6, "value", "upper", "lower")


@query
def decompose_additive(spark, folder):
    out = diagnostics.decompose(tables.quantity_days(spark, folder))
    return rounded(out, 6, "trend", "seasonal", "resid")


@query
def decomposition_long(spark, folder):
    out = diagnostics.decomposition_long(tables.quantity_days(spark, folder))
    return rounded(out, 6, "value")


@query
def decompose_weekly(spark, folder):
    """Series too short for two years fall back to the weekly period."""
    out = diagnostics.decompose(tables.event_days(spark, folder))
    return rounded(out, 5, "trend", "seasonal", "resid")


@query
def undecomposable(spark, folder):
    return diagnostics.undecomposable(tables.customer_orders(spark, folder))


@query
def undecomposable_short(spark, folder):
    """Orders: many are shipped within two weeks."""
    return diagnostics.undecomposable(tables.order_lines(spark, folder))


@query
def no_correlogram(spark, folder):
    return diagnostics.no_correlogram(tables.customer_orders(spark, folder))


@query
def kpss_statistic(spark, folder):
    out = diagnostics.kpss_statistic(tables.supplier_bars(spark, folder))
    return rounded(out, 6, "statistic")


@query
def kpss_verdicts(spark, folder):
    out = statistical.kpss_report(tables.supplier_bars(spark, folder))
    return rounded(out, 6, "kpss_stat", "kpss_p")


# --- forecasts SQL can state ---

@query
def linear_trend_forecast(spark, folder):
    return rounded(baselines.linear_trend(tables.supplier_bars(spark, folder)), 4, "predicted")


@query
def last_value_forecast(spark, folder):
    return baselines.last_value(tables.customer_orders(spark, folder))


@query
def holt_fixed(spark, folder):
    out = baselines.holt_states(tables.bars(spark, folder), HOLT_GRID).drop("test")
    return rounded(rounded(out, 4, "level", "trend"), 0, "sse")


@query
def holt_grid_forecast(spark, folder):
    return rounded(baselines.holt_on_grid(tables.bars(spark, folder), HOLT_GRID), 4,
                   "predicted")


@query
def prediction_union(spark, folder):
    return rounded(baseline_predictions(tables.supplier_bars(spark, folder)), 4, "predicted")


@query
def prediction_union_short(spark, folder):
    """Short series: every model predicts the same rows."""
    return rounded(baseline_predictions(tables.customer_orders(spark, folder)), 4, "predicted")


@query
def forecast_overlay(spark, folder):
    source = tables.bars(spark, folder)
    out = reports.forecast_overlay(series.with_split(source), baseline_predictions(source),
                                   BASELINES)
    return rounded(out, 4, *BASELINES)


@query
def series_result_lookup(spark, folder):
    predictions = baseline_predictions(tables.bars(spark, folder))
    out = reports.predictions_with_metrics(predictions, evaluate.evaluate(predictions))
    return rounded(out, 4, "predicted")


# --- evaluation and comparison ---

@query
def metrics_by_series_model(spark, folder):
    return supplier_metrics(spark, folder)


@query
def metrics_quick_rounding(spark, folder):
    return evaluate.evaluate(baseline_predictions(tables.bars(spark, folder)),
                             evaluate.QUICK_DIGITS)


@query
def model_leaderboard(spark, folder):
    return reports.leaderboard(supplier_metrics(spark, folder))


@query
def leaderboard_flags(spark, folder):
    return reports.flag_best(reports.leaderboard(supplier_metrics(spark, folder)))


@query
def labelled_leaderboard(spark, folder):
    return reports.labelled(reports.leaderboard(supplier_metrics(spark, folder)))


@query
def overall_best_model(spark, folder):
    return reports.overall_best(supplier_metrics(spark, folder))


def _matrix(metric):
    def matrix(spark, folder):
        return reports.metric_matrix(supplier_metrics(spark, folder), metric, BASELINES)
    matrix.__name__ = f"metric_matrix_{metric}"
    return matrix


for _metric in evaluate.METRICS:
    query(_matrix(_metric))


@query
def metric_grid(spark, folder):
    """Aligned to one model more than was run, whose cells stay empty."""
    return reports.metric_grid(supplier_metrics(spark, folder), [*BASELINES, "ARIMA"])


@query
def metric_long(spark, folder):
    return reports.metric_long(supplier_metrics(spark, folder))


@query
def best_model_per_series(spark, folder):
    return reports.best_per_series(supplier_metrics(spark, folder))


@query
def best_model_flags(spark, folder):
    return reports.flag_best(reports.best_per_series(supplier_metrics(spark, folder)))


@query
def best_model_numbered(spark, folder):
    best = reports.best_per_series(supplier_metrics(spark, folder))
    return reports.number_rows(best, "series")


@query
def win_counts(spark, folder):
    return reports.win_counts(supplier_metrics(spark, folder))


@query
def series_metric_table(spark, folder):
    return reports.series_metric_table(supplier_metrics(spark, folder))


@query
def metric_matrix_ranked(spark, folder):
    return reports.metric_matrix_ranked(supplier_metrics(spark, folder))


def _saved_predictions(spark, folder):
    path = scratch_path(spark, "results")
    sinks.write_predictions(baseline_predictions(tables.supplier_bars(spark, folder)), path)
    return path


@query
def predictions_read_back(spark, folder):
    """The CSV result file of the baselines, as a reader finds it."""
    path = _saved_predictions(spark, folder)
    return rounded(sinks.read_predictions_csv(spark, f"{path}/predictions.csv"), 4, "predicted")


@query
def prediction_file_order(spark, folder):
    """Rows and breaks of order by model over the part files of the CSV result."""
    path = _saved_predictions(spark, folder)
    parts = sinks.order_certificate(spark, f"{path}/predictions.csv")
    return parts.groupBy("model").agg(
        F.sum("n_rows").alias("n_rows"), F.min_by("first", "file").alias("first"),
        F.max_by("last", "file").alias("last"), F.sum("n_breaks").alias("n_breaks")).select(
        "model", "n_rows", F.col("first.series").alias("first_series"),
        F.col("first.date").alias("first_date"), F.col("last.series").alias("last_series"),
        F.col("last.date").alias("last_date"), "n_breaks")


@query
def metrics_read_back(spark, folder):
    """The metrics file of the baselines, computed from the saved predictions."""
    path = _saved_predictions(spark, folder)
    sinks.write_metrics(evaluate.evaluate(sinks.read_predictions(spark, path)), path)
    return sinks.read_metrics(spark, path)


# --- models without a SQL counterpart ---

@query
def feature_vectors(spark, folder):
    from pyspark.ml.functions import vector_to_array
    out = features.assemble(features.add_features(tables.supplier_bars(spark, folder)))
    numbers = F.transform(vector_to_array("features"), lambda x: F.round(x, 6))
    return out.select("series", "date", "split", "value", numbers.alias("features"))


def _pooled(name, spark, folder):
    return pooled.pooled_forecast(tables.supplier_bars(spark, folder), [name])[0]


@query
def lr_forecast(spark, folder):
    return rounded(_pooled("Linear Regression", spark, folder), 2, "predicted")


@query
def rf_forecast(spark, folder):
    return _pooled("Random Forest", spark, folder)


@query
def gbt_forecast(spark, folder):
    return _pooled("GBT", spark, folder)


@query
def forest_leaves(spark, folder):
    """The forest's node table, checked: train rows walk it down to the model's own answers.

    Rows and labels that reach a leaf of each tree, and rows for which the mean of the
    leaves differs from the fitted model.
    """
    rows = pooled.training_rows(tables.bars(spark, folder))
    fitted = pooled.fit_pooled(rows, "Random Forest")
    forest = fitted.stages[-1]
    train = rows.where("split = 'train'")
    answers = scratch_path(spark, "answers")
    fitted.transform(train).select("series", "date", "value", "features", "predicted") \
        .write.parquet(answers)
    own = spark.read.parquet(answers)
    routed = trees.leaves(own, trees.node_table(forest, spark), forest.getNumTrees,
                          forest.getMaxDepth())
    mean = routed.groupBy("series", "date", "predicted").agg(F.avg("prediction").alias("mean"))
    wrong = mean.where(F.abs(F.col("mean") - F.col("predicted"))
                       > 1e-9 * F.abs("predicted")).count()
    leaf = trees.leaf_statistics(routed)
    return leaf.groupBy("tree").agg(
        F.sum("n").alias("n_rows"), F.round(F.sum(F.col("n") * F.col("mean")), 0).alias("total"),
        F.lit(wrong).cast("long").alias("n_wrong"))


@query
def holt_forecast(spark, folder):
    return statistical.holt_predictions(
        statistical.holt_fits(tables.supplier_bars(spark, folder)))


@query
def arima_forecast(spark, folder):
    return statistical.arima_predictions(
        statistical.arima_fits(tables.supplier_bars(spark, folder)))


@query
def arima_orders(spark, folder):
    return statistical.arima_orders(
        statistical.arima_fits(tables.supplier_bars(spark, folder)))


@query
def unfitted_series(spark, folder):
    return statistical.unfitted(tables.customer_orders(spark, folder))


@query
def stationarity_report(spark, folder):
    return statistical.stationarity_report(tables.supplier_bars(spark, folder))


@query
def adf_fixed_lags(spark, folder):
    """t-ratios of the level and the first difference with up to three lagged steps."""
    variants = diagnostics.level_and_difference(
        series.with_split(tables.supplier_bars(spark, folder)))
    arrays = variants.groupBy("series", "variant").agg(F.transform(F.sort_array(
        F.collect_list(F.struct("rn", "x"))), lambda r: r["x"]).alias("x"))
    return rounded(unit_root.adf_at(arrays, [0, 1, 2, 3]).drop("x"), 6, "adf_stat")


@query
def five_model_run(spark, folder):
    return metrics_of_run(tables.bars(spark, folder))


@query
def five_model_run_many(spark, folder):
    """The same run over many series."""
    return metrics_of_run(tables.supplier_bars(spark, folder))


@query
def five_model_comparison(spark, folder):
    """The whole path: run, result files, read back, best model of each series with flags."""
    saved = run_and_save(tables.supplier_bars(spark, folder), scratch_path(spark, "results"))
    return reports.flag_best(reports.best_per_series(saved["metrics"]))


def _quick_table(name):
    def table(spark, folder):
        kept = series.long_enough(tables.event_days(spark, folder), MIN_ROWS)
        out = diagnostic_tables(kept)[name]
        return rounded(out, 6, *[c for c, kind in out.dtypes if kind == "double" and c != "value"
                                 or name == "correlograms" and c == "value"])
    table.__name__ = f"quick_{name}"
    return table


for _name in ("split_counts", "describe", "overview", "rolling", "difference", "stationarity",
              "correlograms"):
    query(_quick_table(_name))


@query
def quick_analysis(spark, folder):
    return quick_metrics(tables.supplier_bars(spark, folder))


@query
def quick_analysis_forecast(spark, folder):
    return quick_forecast(tables.customer_orders(spark, folder))
