"""Augmented Dickey-Fuller tests as array expressions: no value leaves the JVM.

The products of all regressors of a series form one small matrix, which a few passes over the
values give whatever the number of lags. Eliminating its columns one after another leaves the squared error of every shorter regression on the way, so the
search for a lag costs one matrix, and the test at the lag found another.
"""

from pyspark.sql import functions as F

from tidecast.operators.diagnostics import dot

# share of a regressor that must be left when those before it are taken out
INDEPENDENT = 1e-10


def _bound(value, function):
    """The function of a value that is worked out once, not again for every use."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


# places of the constant and of the lagged level beside those of the steps, 0 the step itself
CONSTANT, LEVEL = -1, -2


def _products(centred_df, lags, order, when):
    """Adds ``_p``, the products of the regressors in ``order``, where ``when`` holds.

    They are taken over the rows with ``lags`` steps before, of ``_z`` (the values about their
    mean, which changes no t-ratio) and ``_d`` (the steps). A product of two lagged steps is
    that of the steps themselves, as far apart, but for the ends; so it costs no pass.
    """
    z, d, size, rows = F.col("_z"), F.col("_d"), F.size("_d"), F.size("_d") - lags
    places = F.sequence(F.lit(0), lags)

    def ends(i, value):
        """What lagging by i adds at the start and takes from the end."""
        return F.when(i < 1, F.lit(0.0)).otherwise(F.aggregate(
            F.sequence(F.lit(1), F.greatest(i, F.lit(1))), F.lit(0.0),
            lambda acc, s: acc + value(lags - s) - value(size - s)))

    step = F.slice("_d", lags + 1, rows)
    level = F.slice("_z", lags + 1, rows)

    def total(values):
        return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)

    passes = F.struct(
        _bound(step, lambda own: F.transform(places, lambda k: dot(
            own, F.slice("_d", lags + 1 - k, rows)))).alias("apart"),
        dot(level, step).alias("cross"), total(step).alias("step"), total(level).alias("level"),
        dot(level, level).alias("square"))

    def further(own):
        """The level by each lagged step: a level is the one before and its step, so the next
        product is the last, with that of the steps as far apart, but for the ends."""
        return F.aggregate(_steps_before(lags), F.array(own["cross"]), lambda acc, k: F.concat(
            acc, F.array(F.element_at(acc, -1) + F.get(own["apart"], k - 1)
                         + F.get(z, lags) * F.get(d, lags - k) - F.get(z, size) * F.get(d, size - k))))

    def lagged(own):
        return F.struct(
            further(own).alias("cross"), own["level"].alias("level"), own["square"].alias("square"),
            F.transform(places, lambda i: own["step"] + ends(i, lambda t: F.get(d, t))).alias("sums"),
            F.transform(places, lambda i: F.transform(places, lambda j: F.get(
                own["apart"], F.abs(i - j)) + ends(F.least(i, j), lambda t: F.get(d, t) * F.get(
                    d, t - F.abs(i - j))))).alias("steps"))

    def product(own, a, b):
        return (F.when((a >= 0) & (b >= 0), _cell(own["steps"], a, b))
                .when((a == CONSTANT) & (b == CONSTANT), rows.cast("double"))
                .when((a == LEVEL) & (b == LEVEL), own["square"])
                .when((a < 0) & (b < 0), own["level"])
                .when(F.least(a, b) == CONSTANT, F.get(own["sums"], F.greatest(a, b)))
                .otherwise(F.get(own["cross"], F.greatest(a, b))))

    matrix = _bound(passes, lambda own: _bound(lagged(own), lambda found: F.transform(
        order, lambda a: F.transform(order, lambda b: product(found, a, b)))))
    return centred_df.select("*", F.when(when, matrix).alias("_p"))


def _steps_before(lags):
    return F.when(lags > 0, F.sequence(F.lit(1), F.greatest(lags, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))


def _cell(rows, i, j):
    return F.get(F.get(rows, i), j)


def _eliminated(matrix, columns):
    """What is left when the first ``columns`` regressors are taken out, one by one.

    A struct: ``rows``, the last diagonal element after each (``errors``), and whether all
    regressors were independent of those before.
    """
    size = F.size(matrix) - 1

    def take(state, k):
        rows = state["rows"]
        pivot, head = F.get(rows, k), _cell(rows, k, k)
        whole = head > INDEPENDENT * _cell(matrix, k, k)
        left = F.transform(rows, lambda row, i: F.when((i > k) & whole, F.zip_with(
            row, pivot, lambda a, s: a - F.get(row, k) / head * s)).otherwise(row))
        return _bound(left, lambda own: F.struct(
            own.alias("rows"),
            F.concat(state["errors"], F.array(_cell(own, size, size))).alias("errors"),
            (state["whole"] & whole).alias("whole")))

    return F.aggregate(F.sequence(F.lit(0), columns - 1), F.struct(
        matrix.alias("rows"), F.array().cast("array<double>").alias("errors"),
        F.lit(True).alias("whole")), take)


def centred(arrays):
    """Adds ``_z`` and ``_d`` to rows with the values in ``x``."""
    x = F.col("x")
    mean = F.try_divide(F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v), F.size(x))
    # A column of its own would be put back into the function, and worked out for every value.
    return arrays.select(
        "*", _bound(mean, lambda m: F.transform(x, lambda v: v - m)).alias("_z"),
        F.transform(F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))),
                    lambda v, i: v - F.get(x, i)).alias("_d"))


def t_ratios(centred_df, lags, out):
    """Adds the t-ratio of the lagged level with that number of lagged steps.

    Null where a regressor depends on the others, rows are too few or nothing is left over.
    """
    freedom = F.size("_d") - lags - lags - 2
    order = F.concat(F.array(F.lit(CONSTANT)), _steps_before(lags), F.array(F.lit(LEVEL), F.lit(0)))
    found = _products(centred_df, lags, order, freedom > 0)
    found = found.select("*", F.when(freedom > 0, _eliminated(F.col("_p"), lags + 1)).alias("_e"))
    rows = F.col("_e.rows")
    level, both = _cell(rows, lags + 1, lags + 1), _cell(rows, lags + 1, lags + 2)
    error = _cell(rows, lags + 2, lags + 2) - both * both / level
    whole = F.col("_e.whole") & (level > INDEPENDENT * _cell(F.col("_p"), lags + 1, lags + 1))
    ratio = both / level / F.sqrt(error / freedom / level)
    return found.select("*", F.when(whole & (error > 0), ratio).alias(out)).drop("_p", "_e")


def best_lags(centred_df, out):
    """Adds the number of lagged steps of lowest AIC, on the sample common to all.

    At most 12 (n / 100)^(1/4), and fewer for short series; null under four values.
    """
    n = F.size("x")
    most = F.least(F.ceil(12 * F.pow(n / F.lit(100.0), F.lit(0.25))), F.floor(n / 2) - 2).cast("int")
    found = centred_df.select("*", F.when(n >= 4, most).alias("_most"))
    most = F.col("_most")
    order = F.concat(F.array(F.lit(CONSTANT), F.lit(LEVEL)), _steps_before(most), F.array(F.lit(0)))
    found = _products(found, most, order, most >= 0)
    found = found.select("*", F.when(
        most >= 0, _eliminated(F.col("_p"), most + 2)).alias("_e"))
    rows = F.size("_d") - most
    aic = F.transform(F.slice("_e.errors", F.lit(2), most + 1), lambda e, p: rows * F.log(
        F.greatest(e, F.lit(1e-300)) / rows) + 2 * (p + 2))
    found = found.select("*", aic.alias("_aic"))
    return found.select("*", (F.array_position("_aic", F.array_min("_aic")) - 1).cast("int")
                        .alias(out)).drop("_p", "_e", "_most", "_aic")


def normal_share(z):
    """The standard normal distribution function, by a series of positive terms."""
    def below(x):
        total = _bound(2 * x * x, lambda y: F.aggregate(F.sequence(F.lit(1), F.lit(120)), F.struct(
            x.alias("term"), x.alias("sum")), lambda s, k: F.struct(
            (s["term"] * y / (2 * k + 1)).alias("term"),
            (s["sum"] + s["term"] * y / (2 * k + 1)).alias("sum")), lambda s: s["sum"]))
        return total * F.exp(-x * x) / F.sqrt(F.lit(3.141592653589793))

    half = _bound(F.least(F.abs(z) / F.sqrt(F.lit(2.0)), F.lit(6.0)), below)
    return F.when(z < 0, 0.5 - half).when(z >= 0, F.least(0.5 + half, F.lit(1.0)))


def p_value(tau):
    """Approximate p-value of the constant-only Dickey-Fuller t-ratio (MacKinnon 1994)."""
    # fixed values: response surface coefficients
    low = 2.1659 + 1.4412 * tau + 0.038269 * tau * tau
    high = 1.7339 + 0.93202 * tau - 0.12745 * tau * tau - 0.010368 * tau * tau * tau
    share = _bound(F.when(tau <= -1.61, low).otherwise(high), normal_share)
    return F.when(tau > 2.74, 1.0).when(tau < -18.83, 0.0).otherwise(share)


def adf(arrays):
    """Adds ``adf_stat``, ``adf_p`` and ``adf_lags`` to rows with the values in ``x``."""
    found = best_lags(centred(arrays), "adf_lags")
    found = t_ratios(found, F.col("adf_lags"), "adf_stat").drop("_z", "_d")
    return found.select("*", p_value(F.col("adf_stat")).alias("adf_p"))


def adf_at(arrays, lags):
    """One row for each of the given numbers of lagged steps: ``lags`` and ``adf_stat``."""
    every = centred(arrays).select("*", F.explode(F.array(*map(F.lit, lags))).alias("lags"))
    return t_ratios(every, F.col("lags"), "adf_stat").drop("_z", "_d")
