"""Series diagnostics in plain DataFrame code: description, correlograms, decomposition."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidecast.operators.features import first_difference
from tidecast.operators.series import (
    SPLIT, business_days, business_split_counts, by_date, number_rows_in_time, split_counts,
    train_part, whole_series)

NORMAL_95 = 1.959964
YEAR = 252
WEEK = 5


def describe(series_df):
    """Count, mean, sample deviation, extremes and interpolated quartiles per series.

    The quartiles are read off the sorted rows, which spill where a percentile aggregate
    would hold every distinct value in memory.
    """
    ascending = W.partitionBy("series").orderBy("value")
    ranked = series_df.select(
        "series", "value", F.row_number().over(ascending).alias("rn"),
        F.count(F.lit(1)).over(ascending.rowsBetween(
            W.unboundedPreceding, W.unboundedFollowing)).alias("n"))

    def quantile(share):
        place = F.lit(share) * (F.col("n") - 1)
        below = F.floor(place)
        weight = place - below
        # the row at the place, and a part of the way to the next
        return F.sum(F.when(F.col("rn") == below + 1, F.col("value") * (1 - weight))
                     .when(F.col("rn") == below + 2, F.col("value") * weight))

    return ranked.groupBy("series").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        quantile(0.25).alias("p25"), quantile(0.5).alias("p50"), quantile(0.75).alias("p75"),
        F.max("value").alias("max"),
    )


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def _arrays(df, keys, columns, *aggregates):
    """One row per key with the columns as arrays in ``rn`` order.

    An array holds at most one element per calendar day. It is a column of its own: as a
    mere field of the gathered rows it would be read out again for every element used.
    """
    gathered = df.groupBy(*keys).agg(
        *aggregates, F.sort_array(F.collect_list(F.struct("rn", *columns))).alias("_rows"))

    def field(name):
        return F.transform("_rows", lambda row: row[name]).alias(name)

    return gathered.select("*", *[field(c) for c in columns]).drop("_rows")


def _difference_correlations(series_df, lags, fraction, rows_per_lag):
    """Per series: n, r_0..r_K of the differenced train part.

    K is ``lags``, or n - 1 in a shorter series; with ``rows_per_lag``, less where the train
    part has not that many rows for each. A series of constant differences keeps its rows,
    their correlations are null; one without a difference is named by ``no_correlogram``.
    """
    centred = first_difference(series_df, fraction).select(
        "series", "rn", (F.col("diff") - F.avg("diff").over(whole_series())).alias("z"))
    packed = _arrays(centred, ["series"], ["z"], F.count("z").cast("int").alias("n"),
                     F.sum(F.col("z") * F.col("z")).alias("_c0"))
    n, z = F.col("n"), F.col("z")
    most = F.least(F.lit(lags), n - 1)
    if rows_per_lag:
        most = F.least(most, F.floor((n + 1) / rows_per_lag).cast("int"))
    return packed.select("series", "n", F.transform(
        F.sequence(F.lit(0), most),
        lambda k: F.try_divide(dot(F.slice(z, k + 1, n - k), F.slice(z, F.lit(1), n - k)),
                               F.col("_c0"))).alias("r"))


def no_correlogram(series_df, fraction=SPLIT):
    """Series whose train part has no difference, with its length."""
    return (split_counts(series_df, fraction).filter(F.col("train") < 2)
            .select("series", "train", F.lit("fewer than two train rows").alias("error")))


def _acf_values():
    """Array of (value, half width of Bartlett's 95 % band) by lag, from ``r`` and ``n``."""
    def point(value, lag):
        # squares of r_1 .. r_(k-1)
        earlier = F.aggregate(F.slice("r", F.lit(2), F.greatest(lag - 1, F.lit(0))),
                              F.lit(0.0), lambda acc, x: acc + x * x)
        variance = F.when(lag == 0, F.lit(0.0)).otherwise((1 + 2 * earlier) / F.col("n"))
        return F.struct(value.alias("value"),
                        (F.lit(NORMAL_95) * F.sqrt(variance)).alias("half"))

    return F.transform("r", point)


def _pacf_values():
    """As ``_acf_values`` for the partial correlations: Durbin-Levinson over ``r``.

    The recursion runs over at most the lags asked for, inside the JVM.
    """
    r = F.col("r")

    def step(state, k):
        phi = state["phi"]
        known = F.slice(r, F.lit(2), k - 1)               # r_1 .. r_(k-1)
        last = F.try_divide(F.get(r, k) - dot(phi, F.reverse(known)),
                            F.lit(1.0) - dot(phi, known))
        # bound to a variable, or every element would work it out again
        return F.get(F.transform(F.array(last), lambda v: F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - v * y),
                     F.array(v)).alias("phi"),
            F.concat(state["out"], F.array(v)).alias("out"))), F.lit(0))

    start = F.struct(F.array().cast("array<double>").alias("phi"),
                     F.slice(r, F.lit(1), F.lit(1)).alias("out"))
    values = F.when(F.size(r) > 1, F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size(r) - 1, F.lit(1))), start, step,
        lambda state: state["out"])).otherwise(r)
    return F.transform(values, lambda value, lag: F.struct(
        value.alias("value"),
        F.when(lag == 0, F.lit(0.0)).otherwise(F.lit(NORMAL_95) / F.sqrt("n"))
        .alias("half")))


def _by_lag(r, values, *columns):
    # the outer form keeps the optimizer from copying the array into a filter on its size
    points = r.select("series", *columns, F.posexplode_outer(values).alias("lag", "_p"))
    return points.select("series", *columns, "lag", F.col("_p.value").alias("value"),
                         F.col("_p.half").alias("half"))


def _with_band(points):
    return points.select("series", "lag", "value",
                         (F.col("value") - F.col("half")).alias("lo"),
                         (F.col("value") + F.col("half")).alias("hi"))


def acf(series_df, lags=40, fraction=SPLIT, rows_per_lag=None):
    """Autocorrelations of the differenced train part with Bartlett's 95 % band."""
    return _with_band(_by_lag(_difference_correlations(series_df, lags, fraction,
                                                        rows_per_lag), _acf_values()))


def pacf(series_df, lags=40, fraction=SPLIT, rows_per_lag=None):
    """Partial autocorrelations of the differenced train part with their 95 % band."""
    return _with_band(_by_lag(_difference_correlations(series_df, lags, fraction,
                                                        rows_per_lag), _pacf_values()))


def correlograms(series_df, lags=40, fraction=SPLIT, rows_per_lag=None):
    """ACF and PACF in one long table with the error-bar lengths of the band."""
    r = _difference_correlations(series_df, lags, fraction, rows_per_lag)
    both = r.select("series", F.explode_outer(F.array(
        F.struct(F.lit("acf").alias("kind"), _acf_values().alias("values")),
        F.struct(F.lit("pacf").alias("kind"), _pacf_values().alias("values")))).alias("_k"))
    points = _by_lag(both.select("series", "_k.kind", "_k.values"), F.col("values"), "kind")
    return points.select(
        "series", "kind", "lag", "value",
        F.col("half").alias("upper"),
        F.col("half").alias("lower"))


def _centred_mean(period):
    """Moving average over one period, the two ends at half weight for an even one."""
    half = period // 2
    if period % 2:
        return F.avg("value").over(by_date().rowsBetween(-half, half))
    inner = F.sum("value").over(by_date().rowsBetween(-(half - 1), half - 1))
    ends = F.lag("value", half).over(by_date()) + F.lead("value", half).over(by_date())
    return (2 * inner + ends) / (2 * period)


def decompose(series_df, fraction=SPLIT):
    """Additive decomposition of the train part on the business-day grid.

    The period is a trading year where the train part holds two of them, else a week.
    Series with fewer than ten train days are left out here and named by
    ``undecomposable``. Every step keeps the partitioning by series.
    """
    train = (number_rows_in_time(train_part(business_days(series_df), fraction)
                                 .select("series", "date", "value"))
             .filter(F.col("n") >= 2 * WEEK))
    period = F.when(F.col("n") >= 2 * YEAR, YEAR).otherwise(WEEK)
    trended = train.select(
        "series", "date", "value", "rn", "n", period.alias("period"),
        _centred_mean(YEAR).alias("_year"), _centred_mean(WEEK).alias("_week"))
    half = F.floor(F.col("period") / 2)
    inside = (F.col("rn") > half) & (F.col("rn") <= F.col("n") - half)
    trend = F.when(inside, F.when(F.col("period") == YEAR, F.col("_year"))
                   .otherwise(F.col("_week")))
    phased = trended.select(
        "series", "date", "value", "period", trend.alias("trend"),
        ((F.col("rn") - 1) % F.col("period")).alias("phase"))
    by_phase = W.partitionBy("series", "phase")
    means = phased.select(
        "*",
        F.avg(F.col("value") - F.col("trend")).over(by_phase).alias("_phase_mean"),
        F.count(F.lit(1)).over(by_phase).alias("_phase_rows"))
    # each phase counts once, whatever its number of rows
    centre = F.sum(F.col("_phase_mean") / F.col("_phase_rows")).over(
        W.partitionBy("series")) / F.col("period")
    seasonal = F.col("_phase_mean") - centre
    return (means.select("series", "date", "period", F.col("value").alias("observed"),
                         "trend", seasonal.alias("seasonal"))
            .withColumn("resid", F.col("observed") - F.col("trend") - F.col("seasonal")))


def undecomposable(series_df, fraction=SPLIT):
    """Series too short for either period, with their train length."""
    days = business_split_counts(series_df, fraction)
    return (days.select("series", F.col("train").alias("train_days"))
            .filter((F.col("train_days") > 0) & (F.col("train_days") < 2 * WEEK))
            .withColumn("error", F.lit("fewer than two periods")))


def decomposition_long(series_df, fraction=SPLIT):
    """Component per row, as a four-panel chart reads it."""
    return decompose(series_df, fraction).select(
        "series", "date", "observed", "trend", "seasonal", "resid").unpivot(
            ["series", "date"], ["observed", "trend", "seasonal", "resid"],
            "component", "value")


def kpss_statistic(series_df, max_lag=8, fraction=SPLIT):
    """Level KPSS statistic of the train part at every lag 0..max_lag.

    With a fixed lag the long-run variance is a weighted sum of autocovariances, so one
    window pass and one aggregate give all lags at once.
    """
    train = train_part(series_df, fraction)
    centred = train.select(
        "series", "date", (F.col("value") - F.avg("value").over(whole_series())).alias("z"))
    partial = F.sum("z").over(by_date().rowsBetween(W.unboundedPreceding, 0))
    parts = centred.select(
        "series", "z", partial.alias("s"),
        *[(F.col("z") * F.lag("z", k).over(by_date())).alias(f"c{k}")
          for k in range(1, max_lag + 1)])
    sums = parts.groupBy("series").agg(
        F.count("z").alias("n"),
        F.sum(F.col("s") * F.col("s")).alias("ss"),
        F.sum(F.col("z") * F.col("z")).alias("c0"),
        *[F.coalesce(F.sum(f"c{k}"), F.lit(0.0)).alias(f"c{k}")
          for k in range(1, max_lag + 1)])

    def statistic(lag):
        long_run = F.col("c0")
        for k in range(1, lag + 1):
            long_run = long_run + F.lit(2.0 * (1 - k / (lag + 1))) * F.col(f"c{k}")
        return F.try_divide(F.col("ss"), F.col("n") * long_run)

    values = F.array(*[statistic(lag) for lag in range(max_lag + 1)])
    return sums.select("series", "n", F.posexplode(values).alias("lags", "statistic"))


def level_and_difference(split_df):
    """(series, variant, rn, x): the train values and their differences, from split rows."""
    step = F.col("value") - F.lag("value", 1).over(by_date())
    train = split_df.select("series", "rn", "split", "value", step.alias("_step")).filter(
        F.col("split") == "train")
    variants = F.array(F.struct(F.lit("level").alias("variant"), F.col("value").alias("x")),
                       F.struct(F.lit("difference").alias("variant"),
                                F.col("_step").alias("x")))
    return (train.select("series", "rn", F.inline(variants)).filter(F.col("x").isNotNull()))


def kpss(variants):
    """Level KPSS statistic, p-value and lag of each (series, variant), lag from the data.

    The lag is Hobijn et al.'s (1998); p is interpolated between the published levels and
    stays within [.01, .10]. Null where there are fewer than four values or all are equal.
    Means and partial sums come from windows. The long-run variance at lag L is the mean
    square of sums over L + 1 neighbours, each a difference of two partial sums, so its
    cost does not grow with the lag. ``x`` comes along as an array.
    """
    whole = W.partitionBy("series", "variant").orderBy("rn").rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing)
    so_far = W.partitionBy("series", "variant").orderBy("rn").rowsBetween(
        W.unboundedPreceding, 0)
    centred = variants.select("*", (F.col("x") - F.avg("x").over(whole)).alias("z"))
    summed = centred.select("*", F.sum("z").over(so_far).alias("s"))
    arrays = _arrays(summed, ["series", "variant"], ["x", "z", "s"],
                     F.count("x").cast("int").alias("n"),
                     F.avg(F.col("z") * F.col("z")).alias("_base"),
                     F.sum(F.col("s") * F.col("s")).alias("_ss"))

    n, z = F.col("n"), F.col("z")
    enough = (n >= 4) & (F.col("_base") > 0)
    first = F.floor(F.pow(n, F.lit(2.0 / 9.0))).cast("int")

    def near(weight):
        """Weighted sum of the first few autocovariances, twice."""
        return F.when(enough, F.aggregate(
            F.sequence(F.lit(1), F.greatest(first, F.lit(1))), F.lit(0.0),
            lambda acc, k: acc + weight(k) * 2 / n * dot(
                F.slice(z, k + 1, n - k), F.slice(z, F.lit(1), n - k))))

    sums = arrays.select("*", near(lambda k: F.lit(1.0)).alias("_g"),
                         near(lambda k: k).alias("_ig"))
    ratio = F.try_divide(F.col("_ig"), F.col("_base") + F.col("_g"))
    gamma = 1.1447 * F.pow(ratio * ratio, F.lit(1.0 / 3.0))
    # compared as doubles: the ratio has no bound where its divisor nears zero
    lags = F.least(F.floor(gamma * F.pow(n, F.lit(1.0 / 3.0))).cast("double"),
                   (n - 1).cast("double")).cast("int")
    lagged = sums.select("*", F.coalesce(F.when(enough, lags), F.lit(0)).alias("kpss_lags"))
    width = F.col("kpss_lags") + 1

    def partial(t):
        return F.when(t < 1, F.lit(0.0)).otherwise(F.get("s", F.least(t, n) - 1))

    squares = F.aggregate(
        F.sequence(F.lit(1), n + F.col("kpss_lags")), F.lit(0.0),
        lambda acc, t: acc + F.pow(partial(t) - partial(t - width), F.lit(2.0)))
    tail = lagged.select("*", (squares / (n * width)).alias("_long_run"))
    stat = F.when(enough & (F.col("_long_run") > 0), F.try_divide(
        F.col("_ss"), n.cast("double") * n * F.col("_long_run")))
    return tail.select("series", "variant", "x", "n", stat.alias("kpss_stat"),
                       _kpss_p(stat).alias("kpss_p"), "kpss_lags")


def _kpss_p(stat):
    # fixed values: critical values and their levels
    points = [(0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01)]
    p = F.when(stat <= points[0][0], F.lit(points[0][1]))
    for (x0, p0), (x1, p1) in zip(points, points[1:]):
        p = p.when(stat <= x1, p0 + (stat - x0) * ((p1 - p0) / (x1 - x0)))
    return p.when(stat > points[-1][0], F.lit(points[-1][1]))


def verdict(is_stationary, p):
    """Reading of a p-value; undetermined where the test gave none."""
    return F.when(p.isNull() | F.isnan(p), "undetermined").otherwise(
        F.when(is_stationary, "stationary").otherwise("not stationary"))
