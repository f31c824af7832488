"""The canonical series: one row per (series, date), numbered and split in time order.

``to_series`` makes (series, date) unique, so a series never has more rows than there
are calendar days, however many raw rows its key holds. That bound is what allows the
operators downstream to window over a whole series.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPLIT = 0.80


def by_date():
    return W.partitionBy("series").orderBy("date")


def whole_series():
    """Same partitioning and order as ``by_date``, so both share one sort."""
    return by_date().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def to_series(df, series, date, value, order=None):
    """Canonical (series, date, value) from raw rows.

    Rows without a date or a value are dropped. Of several rows on one day the one with
    the greatest ``order`` is the day's value (the greatest value where none is given).
    The aggregate combines on the map side, so a key that holds much of the input
    reaches the shuffle as one row per day and task.
    """
    rows = df.select(
        series.alias("series"), date.alias("date"), value.alias("value"),
        (value if order is None else order).alias("_order"),
    ).dropna(subset=["date", "value"])
    return rows.groupBy("series", "date").agg(F.max_by("value", "_order").alias("value"))


def spread(series_df, partitions=None):
    """Series hashed over a fixed number of partitions (``spark.sql.shuffle.partitions``).

    For the fits, whose cost is in the computing and not in the bytes: adaptive execution
    would merge the small partitions and leave most cores idle. Windows and groupings by
    series downstream keep this partitioning and add no shuffle.
    """
    if partitions is None:
        partitions = int(series_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return series_df.repartition(partitions, "series")


def packed_split(series_df, fraction=SPLIT):
    """One row per series: the train values in order, and the test rows as structs.

    The arrays hold at most one element per calendar day.
    """
    rows = F.sort_array(F.collect_list(F.struct("rn", "date", "value", "split")))
    packed = with_split(series_df, fraction).groupBy("series").agg(rows.alias("rows"))
    train = F.transform(F.filter("rows", lambda x: x["split"] == "train"),
                        lambda x: x["value"])
    return packed.select("series", train.alias("train"),
                         F.filter("rows", lambda x: x["split"] == "test").alias("test"))


def number_rows_in_time(series_df):
    """``rn``, 1-based in date order, and ``n``, the series length."""
    return series_df.select(
        "*",
        F.row_number().over(by_date()).alias("rn"),
        F.count(F.lit(1)).over(whole_series()).cast("int").alias("n"),
    )


def with_split(series_df, fraction=SPLIT):
    """Chronological train/test label; numbering and length come along."""
    return number_rows_in_time(series_df).withColumn(
        "split", F.when(F.col("rn") <= F.col("n") * F.lit(fraction), "train").otherwise("test"))


def train_part(series_df, fraction=SPLIT):
    return with_split(series_df, fraction).filter(F.col("split") == "train")


def split_counts(series_df, fraction=SPLIT):
    """Total, train and test rows per series from one grouped count."""
    return _counts_by_part(series_df.groupBy("series").agg(F.count(F.lit(1)).alias("total")),
                           fraction)


def _counts_by_part(totals, fraction):
    return (totals.select("series", "total",
                          F.floor(F.col("total") * F.lit(fraction)).cast("bigint").alias("train"))
            .withColumn("test", F.col("total") - F.col("train")))


def load_summary(series_df):
    """Row count and number of series, in one job."""
    # two levels: rows per series first, so that no distinct set is ever held
    per_series = series_df.groupBy("series").agg(F.count(F.lit(1)).alias("rows"))
    return per_series.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
                          F.count(F.lit(1)).alias("n_series"))


def load_summaries(df, keys, date, value):
    """``load_summary`` of several series frames over one table, in one pass.

    ``keys`` names each frame and the column that is its series. Rows of one day combine on
    the map side, so what is shuffled is a row per source, series, day and task.
    """
    sources = F.array(*[F.struct(F.lit(name).alias("source"), key.cast("string").alias("series"))
                        for name, key in keys.items()])
    days = df.filter(date.isNotNull() & value.isNotNull()).select(
        F.inline(sources), date.alias("date")).distinct()
    per_series = days.groupBy("source", "series").agg(F.count(F.lit(1)).alias("rows"))
    return per_series.groupBy("source").agg(F.sum("rows").alias("n_rows"),
                                            F.count(F.lit(1)).alias("n_series"))


def series_keys(series_df):
    """Sorted list of series names, as a frame."""
    return series_df.select("series").distinct().orderBy("series")


def long_enough(series_df, min_rows):
    """Rows of the series that have at least ``min_rows`` rows.

    The count shares its shuffle and sort with the windows that follow.
    """
    counted = series_df.select("*", F.count(F.lit(1)).over(whole_series()).alias("_rows"))
    return counted.filter(F.col("_rows") >= min_rows).drop("_rows")


def length_report(series_df, min_rows):
    """Per series: row count, accepted or rejected."""
    return (series_df.groupBy("series").agg(F.count(F.lit(1)).alias("total"))
            .withColumn("status", F.when(F.col("total") >= min_rows, "accepted")
                        .otherwise("rejected")))


def only_series(df, wanted):
    """Rows whose series occurs in ``wanted``; empty where none does."""
    return df.join(wanted.select("series"), "series", "left_semi")


def time_index(series_df):
    """0-based position in the series."""
    return series_df.select("*", (F.row_number().over(by_date()) - 1).alias("idx"))


def _covered(series_df):
    """Each weekday observation with ``until``, the last day it covers on the business grid.

    Weekend observations go first, so they are never carried into the week. Each
    remaining observation covers the days up to the next one. The grid ends on the last
    observed day, weekends included, as a grid between the first and last date would.
    """
    observed = (
        series_df.select("*", F.max("date").over(whole_series()).alias("_last"))
        .filter(_weekday())
        .select("*", F.lead("date", 1).over(by_date()).alias("_next"))
    )
    return observed.select("series", "date", "value", F.coalesce(
        F.date_sub("_next", 1), F.col("_last")).alias("until"))


def _weekday():
    return F.dayofweek("date").between(2, 6)


def business_days(series_df):
    """The series on a Monday-to-Friday grid, gaps filled with the last observation.

    Every observation is exploded over the days it covers, which needs neither a calendar
    table nor a join.
    """
    days = F.sequence(F.col("date"), F.col("until"), F.expr("interval 1 day"))
    return (_covered(series_df).select("series", "value", F.explode(days).alias("date"))
            .filter(_weekday()).select("series", "date", "value"))


def business_split_counts(series_df, fraction=SPLIT):
    """``split_counts`` of ``business_days``, without making a row for each day.

    The weekdays that an observation covers are counted from its first and last day, so the
    work follows the observations and not the years between them.
    """
    def weekdays_to(day):
        """Weekdays up to a day, from a fixed Monday on."""
        place = F.unix_date(day) + 3
        return 5 * F.floor(place / 7) + F.least(F.pmod(place, F.lit(7)) + 1, F.lit(5))
    covered = weekdays_to(F.col("until")) - weekdays_to(F.date_sub("date", 1))
    return _counts_by_part(_covered(series_df).groupBy("series").agg(
        F.sum(covered).alias("total")), fraction)
