"""Per-series fits: Holt with searched weights, ARIMA with order search; stationarity.

Spark orders and splits the series and packs each train part into one array; a
vectorised UDF turns the array into a fit; scoring and everything after it is Spark
again. A failed fit repeats the last train value, and says so.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions import fits
from tidecast.operators import unit_root
from tidecast.operators.baselines import MULTI_STEP, as_predictions
from tidecast.operators.diagnostics import kpss, level_and_difference, verdict
from tidecast.operators.series import SPLIT, packed_split, spread, with_split
from tidecast.session import reach_workers


def _struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_INT, _DOUBLE, _TEXT = T.IntegerType(), T.DoubleType(), T.StringType()

HOLT_FIT = _struct(level=_DOUBLE, trend=_DOUBLE, alpha=_DOUBLE, beta=_DOUBLE, sse=_DOUBLE,
                   converged=T.BooleanType(), fallback=_TEXT)
ARIMA_FIT = _struct(ahead=T.ArrayType(_DOUBLE), p=_INT, d=_INT, q=_INT,
                    constant=T.BooleanType(), aic=_DOUBLE,
                    converged=T.BooleanType(), fallback=_TEXT)


# Series fitted side by side: enough to fill the vector operations of a time step. An order
# search bounds what it has open by itself and takes new series as others are done, so it is
# given many at a time: only at the end of them are few left.
SIDE_BY_SIDE = 16
SEARCHED_TOGETHER, SEARCHED_VALUES = 4096, 4_000_000


def _in_groups(train, fit, most=SIDE_BY_SIDE, values=math.inf):
    """``fit(rows)`` on groups of series of like length; a result or exception per row.

    A group has ``most`` series and ``values`` values at most, one series at least. One that
    fails is halved, so that only the series at fault has no fit.
    """
    def together(rows):
        try:
            return fit(rows)
        except (ValueError, ArithmeticError, np.linalg.LinAlgError) as error:
            # one series must not cost its neighbours their fit
            half = len(rows) // 2
            return [error] if half == 0 else together(rows[:half]) + together(rows[half:])

    by_length = train.str.len().sort_values(kind="stable").index.tolist()
    found = {}
    group, size = [], 0
    for i in by_length:
        if group and (len(group) == most or size + len(train[i]) > values):
            found.update(zip(group, together(group)))
            group, size = [], 0
        group.append(i)
        size += len(train[i])
    if group:
        found.update(zip(group, together(group)))
    return [found[i] for i in train.index]


def _reason(error):
    return f"{type(error).__name__}: {error}"


@F.pandas_udf(HOLT_FIT)
def _holt(train: pd.Series) -> pd.DataFrame:
    def fit(rows):
        if any(len(train[i]) < 3 for i in rows):
            raise ValueError("fewer than three values")
        return fits.holt_fits([train[i] for i in rows])

    def one(y, found):
        if isinstance(found, Exception):
            return float(y[-1]), 0.0, None, None, None, None, _reason(found)
        return (*found, None)

    return pd.DataFrame([one(y, f) for y, f in zip(train, _in_groups(train, fit))])


@F.pandas_udf(ARIMA_FIT)
def _arima(train: pd.Series, horizon: pd.Series) -> pd.DataFrame:
    def fit(rows):
        return fits.arima_forecasts([train[i] for i in rows],
                                    [int(horizon[i]) for i in rows])

    def one(y, steps, found):
        if isinstance(found, Exception):
            return ([float(y[-1])] * int(steps), None, None, None, None, None, None,
                    _reason(found))
        ahead, (p, d, q), constant, aic, converged = found
        return ahead.tolist(), p, d, q, constant, aic, converged, None

    return pd.DataFrame([one(y, h, f) for y, h, f in
                         zip(train, horizon, _in_groups(
                             train, fit, SEARCHED_TOGETHER, SEARCHED_VALUES))])


def _fit_input(series_df, fraction):
    """Packed series with at least one train row; ``unfitted`` names the others."""
    reach_workers(series_df.sparkSession)
    return packed_split(spread(series_df), fraction).filter(F.size("train") > 0)


def unfitted(series_df, fraction=SPLIT):
    """Series without a train row, which no model can be fitted to."""
    return (series_df.groupBy("series").agg(F.count(F.lit(1)).alias("total"))
            .filter(F.floor(F.col("total") * F.lit(fraction)) < 1))


def _test_rows(fitted, *columns):
    return fitted.select("series", *columns, F.posexplode("test").alias("h", "row")).select(
        "series", "h", *columns, F.col("row.date").alias("date"),
        F.col("row.value").alias("value"))


def holt_fits(series_df, fraction=SPLIT):
    """One row per series: level, trend, weights, SSE, the fallback reason, test rows."""
    return (_fit_input(series_df, fraction)
            .select("series", "test", _holt("train").alias("fit"))
            .select("series", "fit.*", "test"))


def holt_predictions(fitted):
    ahead = _test_rows(fitted, "level", "trend")
    return as_predictions(ahead, F.col("level") + (F.col("h") + 1) * F.col("trend"),
                          "Holt-Winters", MULTI_STEP)


def arima_fits(series_df, fraction=SPLIT):
    """One row per series: order, AIC, the fallback reason, forecast and test rows."""
    return (_fit_input(series_df, fraction)
            .select("series", "test", _arima("train", F.size("test")).alias("fit"))
            .select("series", "fit.*", "test"))


def arima_predictions(fitted):
    ahead = _test_rows(fitted, "ahead")
    return as_predictions(ahead, F.get("ahead", F.col("h")), "ARIMA", MULTI_STEP)


def arima_orders(fitted):
    return fitted.select("series", "p", "d", "q", "constant", "aic", "converged",
                         "fallback")


def stationarity_report(series_df, fraction=SPLIT):
    """ADF and KPSS on the train part and on its first difference, with verdicts."""
    tested = unit_root.adf(kpss(level_and_difference(with_split(spread(series_df), fraction))))
    adf_p, kpss_p = F.col("adf_p"), F.col("kpss_p")
    return tested.select(
        "series", "variant", "n", "adf_stat", F.round(adf_p, 6).alias("adf_p"), "adf_lags",
        verdict(adf_p <= 0.05, adf_p).alias("adf_verdict"),
        "kpss_stat", F.round(kpss_p, 6).alias("kpss_p"), "kpss_lags",
        verdict(kpss_p > 0.05, kpss_p).alias("kpss_verdict"))


def kpss_report(series_df, fraction=SPLIT):
    """The KPSS half of the report, which needs no Python."""
    tested = kpss(level_and_difference(with_split(series_df, fraction)))
    return tested.select("series", "variant", "n", "kpss_stat", "kpss_p", "kpss_lags",
                         verdict(F.col("kpss_p") > 0.05, F.col("kpss_p"))
                         .alias("kpss_verdict"))
