"""Loads that can be killed and run again: batches of records and the ledger of what landed.

A batch is written in three steps: its records, the units found in the written records, and
one row in one file that commits both. Readers see committed batches only, so what a killed
load left behind is neither read nor counted as landed, and the next attempt replaces it.
"""

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMITS = T.StructType([T.StructField("batch", T.StringType())])


def _with_batch(fields):
    return T.StructType([*fields, T.StructField("batch", T.StringType())])


def _parts(spark, path, schema):
    """What a folder of batches holds; nothing where no batch was begun."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def committed(spark, folder):
    """(batch) of every batch that was finished."""
    return _parts(spark, f"{folder}/commits", _COMMITS)


def landed_records(spark, folder, schema):
    """Records of all committed batches with their ``batch``; ``schema`` is the records'."""
    records = _parts(spark, f"{folder}/records", _with_batch(schema.fields))
    return records.join(committed(spark, folder), "batch", "left_semi")


def ledger(spark, folder, schema, keys):
    """(keys, n_rows, batch) of every unit that landed."""
    fields = [*[schema[k] for k in keys], T.StructField("n_rows", T.LongType())]
    units = _parts(spark, f"{folder}/units", _with_batch(fields))
    return units.join(committed(spark, folder), "batch", "left_semi").select(
        *keys, "n_rows", "batch")


def write_records(records, folder, batch):
    """The first step of a batch, in place of what an earlier attempt left."""
    records.write.mode("overwrite").parquet(f"{folder}/records/batch={batch}")


def land(records, folder, batch, keys=("series",)):
    """Lands the units of ``records`` that no committed batch holds, and returns the ledger.

    A batch that is committed stays as it is, so a load may be run again at any time; a unit
    belongs to the batch that landed it first. A null in a key is a key like any other. One
    load at a time writes to a folder. ``batch`` names a folder: letters, digits, ``_.-``.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", batch):
        raise ValueError(f"not a name for a batch: {batch!r}")
    spark, schema = records.sparkSession, records.schema
    known = committed(spark, folder).where(F.col("batch") == batch)
    if known.isEmpty():
        old = ledger(spark, folder, schema, keys).select(
            *[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{i}"))
                                           for i, k in enumerate(keys)])
        write_records(records.join(old, same, "left_anti"), folder, batch)
        written = spark.read.schema(schema).parquet(f"{folder}/records/batch={batch}")
        written.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).write.mode(
            "overwrite").parquet(f"{folder}/units/batch={batch}")
        spark.createDataFrame([(batch,)], _COMMITS).coalesce(1).write.mode("append").parquet(
            f"{folder}/commits")
    return ledger(spark, folder, schema, keys)
