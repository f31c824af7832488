"""Reading directories of raw daily CSV files into the canonical series."""

import bz2
import re
import zlib
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.text import clean_number, parse_day, parse_day_lenient
from tidecast.operators.series import to_series
from tidecast.session import reach_workers, scratch_path
from tidecast.sources.schema import (
    FORMATTED_COLUMNS, PLAIN_NUMERIC_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, TARGET)


def read_raw(spark, folder):
    """All ``*.csv`` of a folder in one scan, every column as text.

    For files of the known 18 columns in their order. Sub-folders are not entered.
    """
    return spark.read.schema(RAW_SCHEMA).csv(f"{folder}/*.csv", header=True,
                                             mode="PERMISSIVE")


#: Names of files that Spark's readers decompress.
COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst|zstd)$"
#: Those whose end is looked for in one pass, up to this size.
PROBED, PROBED_BYTES = r"\.(gz|bz2|deflate)$", 256 << 20
#: A file's rows meet its header by pieces of this size.
PIECE = 128 << 20
#: While the status of files is read, opening one counts as so many bytes, they are listed in so
#: many tasks, and the listing isn't kept for later readers. Spark's own values make a task for
#: each few files, or for each one listed, and the driver keeps a record of every task.
MANY_FILES = {"spark.sql.files.openCostInBytes": 64 << 10,
              "spark.sql.sources.parallelPartitionDiscovery.parallelism": 64,
              "spark.sql.hive.filesourcePartitionFileCacheSize": 0}


@contextmanager
def _many_files(spark):
    before = {key: spark.conf.get(key) for key in MANY_FILES}
    for key, value in MANY_FILES.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _but(frame, left_out):
    """Rows of a file scan without those of some files, which aren't opened."""
    return frame.where(~F.col("_metadata.file_path").isin(left_out)) if left_out else frame


def _member_end(member, content, at):
    """Where a compressed member ends, or None where the content ends first."""
    bounded = 1 << 22
    while not member.eof:
        if at == len(content):
            return None
        more = content[at:at + (1 << 16)]
        at += len(more)
        if isinstance(member, bz2.BZ2Decompressor):
            member.decompress(more, bounded)
            while not member.eof and not member.needs_input:
                member.decompress(b"", bounded)
        else:
            member.decompress(more, bounded)
            while not member.eof and member.unconsumed_tail:
                member.decompress(member.unconsumed_tail, bounded)
    return at - len(member.unused_data)


def _reaches_end(name, content):
    """Whether every member of a compressed file can be read to its end, little kept at a time."""
    at = 0
    try:
        while at is not None and at < len(content):
            member = bz2.BZ2Decompressor() if name.endswith(".bz2") else zlib.decompressobj(
                31 if name.endswith(".gz") else 15)
            at = _member_end(member, content, at)
    except (OSError, EOFError, zlib.error):
        return False
    return at is not None


def _ends(batches):
    for batch in batches:
        names = batch.column("file_path").to_pylist()
        ok = [_reaches_end(n, memoryview(c.as_buffer()))
              for n, c in zip(names, batch.column("content"))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, k in zip(names, ok) if not k], pa.string())], ["file_path"])


def _probed(spark, location):
    """Paths of the broken ones among the compressed files of ``PROBED``, by one read of each."""
    reach_workers(spark)
    files = spark.read.format("binaryFile").load(location).where(
        F.rlike(F.col("_metadata.file_path"), F.lit(PROBED))
        & F.col("length").between(1, PROBED_BYTES))
    found = files.select(F.col("_metadata.file_path").alias("file_path"), "content").mapInArrow(
        _ends, "file_path string")
    return [r["file_path"] for r in found.collect()]


def _until_whole(spark, location, write):
    """Runs ``write(torn)`` until no file outside ``torn`` breaks it; the paths in ``torn``.

    One pass finds the broken files of common kinds. Another kind of file, or one that only
    Spark's codec refuses, shows by the error of the write and costs one more write.
    """
    path = F.col("_metadata.file_path")
    files = spark.read.format("binaryFile").load(location)
    packed = not files.where(F.rlike(path, F.lit(COMPRESSED))).select("length").isEmpty()
    torn = _probed(spark, location) if packed else []
    while True:
        try:
            write(torn)
            return torn
        except (Py4JJavaError, PySparkException) as error:
            named = re.search(r"\[FAILED_READ_FILE\.NO_HINT\] .*? reading file (\S+)\. ", str(error))
            # The message has file:///x where the metadata column has file:/x.
            name = named and re.sub(r"^([\w+.-]+):///", r"\1:/", named[1])
            if not name or name in torn or not re.search(COMPRESSED, name):
                raise
            torn.append(name)


def file_status(spark, folder, pattern="*.csv"):
    """(file_path, header, status, error) of every file, all by Spark's own readers.

    The header is the first line that isn't blank. A file whose header isn't UTF-8 is
    unreadable, one without any line is empty, and a compressed one that cannot be read to
    its end is unreadable too. All files are read at once, and the status is stored in the
    shared folder, so that nothing made from it reads them again. Any other read error fails
    its task. Raises AnalysisException where nothing matches.
    """
    return _status(spark, f"{folder}/{pattern}")[0].drop("length")


def _status(spark, location):
    """The stored status of every file, and the paths of the torn ones."""
    with _many_files(spark):
        return _stored_status(spark, location)


def _stored_status(spark, location):
    listed = (spark.read.format("binaryFile").load(location)
              .select(F.col("_metadata.file_path").alias("file_path"), "length"))
    blank = F.trim(F.regexp_replace("value", "^\ufeff|[\r\t]", "")) == ""
    valid = F.is_valid_utf8("line")
    path = scratch_path(spark, "file-status")

    def write(torn):
        lines = (_but(spark.read.option("ignoreCorruptFiles", False).text(location), torn)
                 .select(F.col("_metadata.file_path").alias("file_path"), "value",
                         F.struct(F.col("_metadata.file_block_start"),
                                  F.monotonically_increasing_id()).alias("place")))
        first = lines.groupBy("file_path").agg(
            F.min_by("value", F.when(~blank, F.col("place"))).alias("line"),
            F.count(F.lit(1)).alias("lines"))
        whole = ~F.col("file_path").isin(torn) if torn else F.lit(True)
        listed.join(first, "file_path", "left").select(
            "file_path", "length",
            F.when(valid, F.trim(F.regexp_replace("line", "^\ufeff|\r$", ""))).alias("header"),
            F.when(~whole | F.col("lines").isNull() & (F.col("length") > 0), "unreadable")
            .when(F.col("line").isNull(), "empty")
            .when(valid, "ok").otherwise("unreadable").alias("status"),
            F.when(~whole, "not readable to its end").when(F.col("line").isNull(), "no header")
            .when(~valid, "header isn't UTF-8").alias("error")).write.mode(
            "overwrite").parquet(path)
    torn = _until_whole(spark, location, write)
    return spark.read.parquet(path), torn


def _names(header):
    """The column names of a CSV header line, quotes undone, no name twice.

    A repeated name gets the first number from 2 that makes a new one: ``a, a, a_2`` are
    read as ``a, a_3, a_2``.
    """
    cells = F.regexp_extract_all(header, F.lit(r'(?:^|,)\s*("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    given = F.transform(cells, lambda c: F.trim(F.replace(
        F.regexp_replace(F.trim(c), '^"|"$', ""), F.lit('""'), F.lit('"'))))

    def free(used, name):
        tries = F.transform(F.sequence(F.lit(2), 2 * F.size(given) + 2),
                            lambda k: F.concat_ws("_", name, k.cast("string")))
        return F.get(F.array_except(tries, F.concat(used, given)), F.lit(0))
    numbered = F.aggregate(given, F.array().cast("array<string>"), lambda used, name: F.concat(
        used, F.array(F.when(F.array_contains(used, name), free(used, name)).otherwise(name))))
    return F.when(F.size(F.array_distinct(given)) == F.size(given), given).otherwise(numbered)


def _text_schema(names):
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def scan_files(spark, folder, pattern="*.csv"):
    """Rows of all readable files, columns matched by name, everything as text.

    Spark matches CSV columns by position, so one positional scan reads all files and every
    row finds its columns by the header of its file; a column a file lacks is null, a name
    that a header repeats is numbered. The files are read twice: for their status, which is
    stored, and for the rows; compressed files once more for their end. Rows meet their
    header by pieces of the file, known from its length, so one large file is not one key.
    Only the distinct column names reach the driver. Files that are no CSV text are left out
    and named by ``file_status``; where files exist and none is readable that is an error.
    Empty, with the raw columns, where no file matches.
    """
    try:
        status, torn = _status(spark, f"{folder}/{pattern}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RAW_SCHEMA)
    readable = status.filter(F.col("status") == "ok").select(
        "file_path", "length", _names(F.col("header")).alias("names"))
    found = readable.select(F.posexplode("names").alias("place", "name")).groupBy("name").agg(
        F.min("place").alias("place")).orderBy("place", "name").collect()
    if not found:
        failed = status.groupBy("status").count().collect()
        if failed:
            raise ValueError(f"no file under {folder} is readable: {dict(map(tuple, failed))}")
        return spark.createDataFrame([], RAW_SCHEMA)
    width = readable.agg(F.max(F.size("names"))).first()[0]
    reader = spark.read.option("ignoreCorruptFiles", False)
    piece = F.floor(F.col("_metadata.file_block_start") / PIECE)
    rows = _but(reader.schema(_text_schema([f"_c{i}" for i in range(width)])).csv(
        f"{folder}/{pattern}", header=True, maxColumns=max(width, 20480)), torn).select(
        F.array(*[f"_c{i}" for i in range(width)]).alias("cells"),
        F.col("_metadata.file_path").alias("file_path"), piece.alias("piece"))
    places = F.transform(F.array(*[F.lit(r["name"]) for r in found]),
                         lambda name: F.array_position("names", name).cast("int") - 1)
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / PIECE))
    headers = readable.select("file_path", F.explode(pieces).alias("piece"), places.alias("places"))

    def cell(i):
        place = F.get("places", F.lit(i))
        return F.when(place >= 0, F.get("cells", place))
    return rows.join(headers, ["file_path", "piece"]).select(
        *[cell(i).alias(r["name"]) for i, r in enumerate(found)])


def clean_columns(raw, columns=FORMATTED_COLUMNS):
    """Formatted numbers to doubles, over those of the columns that exist."""
    wanted = {c for c in columns if c in raw.columns}
    return raw.select(*[clean_number(c).alias(c) if c in wanted else F.col(c)
                        for c in raw.columns])


def typed_records(raw):
    """The full record typed: date, all numbers as doubles, the running number as int."""
    cleaned = clean_columns(raw, FORMATTED_COLUMNS + PLAIN_NUMERIC_COLUMNS)
    typed = {"Date": parse_day("Date"), "No": F.col("No").try_cast("int")}
    return cleaned.select(*[typed[c].alias(c) if c in typed else F.col(c)
                            for c in cleaned.columns])


def raw_to_series(raw, target=TARGET):
    """Raw text rows to the canonical series; rows without a date or target go."""
    return to_series(raw, F.col("Ticker"), parse_day("Date"), clean_number(target))


def upload_to_series(raw, target=TARGET, name="upload"):
    """As ``raw_to_series`` for files from elsewhere: dates are read leniently and the
    series name may be missing."""
    missing = [c for c in ("Date", target) if c not in raw.columns]
    if missing:
        raise ValueError(f"the file needs the columns {missing}")
    series = F.col("Ticker") if "Ticker" in raw.columns else F.lit(name)
    return to_series(raw, series, parse_day_lenient("Date"), clean_number(target))


def with_file_key(df):
    """Series and year range from the file name ``{series}_{from}_{to}.csv``."""
    name = F.substring_index(F.col("_metadata.file_path"), "/", -1)
    return _split_key(df, F.regexp_replace(name, r"\.csv$", ""))


def _split_key(df, named):
    key = F.when(F.rlike(named, F.lit(r"^.+_\d{4}_\d{4}$")), named)
    size = F.length(key)
    return df.select("*", key.substr(F.lit(1), size - 10).alias("file_series"),
                     key.substr(size - 8, F.lit(4)).try_cast("int").alias("year_from"),
                     key.substr(size - 3, F.lit(4)).try_cast("int").alias("year_to"))


def file_key(series, year_from, year_to):
    return F.format_string("%s_%s_%s", series, year_from, year_to)


def write_raw(raw, folder, year_from, year_to, buckets=64, compression=None):
    """Raw records with their ``file_key`` as CSV files in a bounded number of folders.

    The years are numbers or columns. A folder holds the units of one hash bucket, so the
    number of folders doesn't grow with the number of series. Rebalancing gathers a unit's
    rows and splits a bucket that is too large for one file. ``compression`` names a codec
    of Spark's CSV writer; the files are plain without it.
    """
    def column(year):
        return F.lit(year) if isinstance(year, int) else year
    keyed = raw.withColumn("file_key", file_key(F.col("Ticker"), column(year_from),
                                                column(year_to)))
    keyed = keyed.select(*RAW_COLUMNS, "file_key",
                         F.pmod(F.xxhash64("file_key"), F.lit(buckets)).alias("bucket"))
    (keyed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
     .csv(folder, header=True, compression=compression))


def read_written(spark, folder):
    """Files written by ``write_raw``, with series and years of each record's key."""
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField("file_key", T.StringType())])
    rows = spark.read.schema(schema).csv(f"{folder}/bucket=*/*.csv*", header=True)
    return _split_key(rows, F.col("file_key"))
