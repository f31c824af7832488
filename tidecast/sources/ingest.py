"""Ingest steps around a load: duplicates, resumption, the report of what arrived."""

from pyspark.sql import functions as F


def drop_exact_duplicates(records):
    """Each distinct record once."""
    return records.dropDuplicates()


def not_yet_landed(incoming, landed, keys=("series", "year_from", "year_to")):
    """Incoming units without a landed counterpart, so an interrupted load can resume."""
    return incoming.join(landed.select(*keys), list(keys), "left_anti")


def ingest_status(length_report_df):
    """(series, status, reason) from a length report."""
    ok = F.col("status") == "accepted"
    return length_report_df.select(
        "series", F.when(ok, "ok").otherwise("failed").alias("status"),
        F.when(~ok, F.format_string("only %d rows", F.col("total"))).alias("reason"))


def files_status(file_status_df):
    """(unit, status, reason) of every file of a load, from ``csv_scan.file_status``.

    A unit is the file's name without its ending, ``{series}_{from}_{to}``.
    """
    ok = F.col("status") == "ok"
    name = F.substring_index("file_path", "/", -1)
    return file_status_df.select(
        F.regexp_replace(name, r"\.csv(\.\w+)?$", "").alias("unit"),
        F.when(ok, "ok").otherwise("failed").alias("status"),
        F.when(~ok, F.concat_ws(": ", "status", "error")).alias("reason"))


def failed_units(status_df):
    """The units that failed, with the reason, in the order of their names."""
    return status_df.filter(F.col("status") == "failed").orderBy(status_df.columns[0])


def ingest_summary(status_df):
    """Units per status. The names behind a count are rows of ``status_df``, so that the
    summary stays one row per status however many units a load has; ``failed_units`` lists
    the ones that need attention."""
    unit = status_df.columns[0]
    return (status_df.groupBy("status").agg(F.count(F.lit(1)).alias("units"),
                                            F.min(unit).alias(f"first_{unit}"),
                                            F.max(unit).alias(f"last_{unit}")))
