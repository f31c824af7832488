"""Small helpers on DataFrames that several operators share."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import reach_workers, scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, label: str, **options) -> DataFrame:
    """The frame, written once to the shared folder and read again.

    A later stage, or a retry after a lost executor, goes back to the files.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    # Small row groups: a writer holds one in memory, and rows may be long.
    frame.write.options(**{"parquet.block.size": 16 << 20, **options}).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: For ``written``, where a row holds megabytes: the size of a page and of a row group is looked
#: at after every row. By default that is after a hundred, and whoever writes or reads the
#: group holds all of them.
LONG_ROWS = {f"parquet.{part}.row.check.min": 1 for part in ("page.size", "block.size")}


def numbered(frame: DataFrame, key: str) -> DataFrame:
    """The frame, written with a column that numbers its rows, each by another number."""
    return written(frame.withColumn(key, F.monotonically_increasing_id()), "numbered",
                   compression="zstd")


#: Bytes of an Arrow batch between the JVM and a Python worker: rows may be long.
BATCH_BYTES = 4 << 20


def mapped(frame: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, not only in rows."""
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return frame.mapInArrow(function, schema)


def without(frame: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows whose key (a null is a key too) isn't among ``dropped(key)``."""
    gone = dropped.select(F.col(key).alias("gone")).distinct()
    return frame.join(gone, frame[key].eqNullSafe(gone["gone"]), "left_anti")


def lower_ascii(column):
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def met(left, key, blocks, on=()):
    """Every row of ``left``, dealt by its key, beside every row of ``blocks``.

    ``blocks`` are few large rows; they go to each share of the left rows, by a shuffle: all
    their copies would be a broadcast without a bound. With ``on`` rows also agree in that.
    """
    shares = parallelism(left.sparkSession)
    spread = blocks.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    dealt = left.withColumn("share", F.pmod(F.xxhash64(key), F.lit(shares)).cast("int"))
    return dealt.join(spread.hint("merge"), ["share", *on]).drop("share")
