"""Landed bar files: one gzip CSV per trading day, ``YYYY/MM/YYYY-MM-DD.csv.gz``.

The root is any Hadoop path (``file:``, ``hdfs:``, ``s3a:``). A gzip file cannot be split,
so it is read by one task; everything after the read is spread again by the writer.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.times import file_date
from barloom.schemas import BARS_CSV, CORRUPT, LANDED_CSV

PATTERN = "*.csv.gz"
CSV_OPTIONS = {
    "header": True,
    "enforceSchema": False,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # A line counts as corrupt whichever columns a query reads.
    "columnPruning": False,
    "recursiveFileLookup": True,
    "pathGlobFilter": PATTERN,
}
FILES_SCHEMA = "path string, modification_time timestamp, length long"


def list_files(spark: SparkSession, root: str, pattern: str = PATTERN) -> DataFrame:
    """Files below ``root``, oldest first; a root that does not exist has none."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .load(root)
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES_SCHEMA)
    return files.select(
        "path", F.col("modificationTime").alias("modification_time"), "length"
    ).orderBy("modification_time", "path")


def dated_files(
    spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Files with a date in their name as (path, date, length, modification_time)."""
    files = list_files(spark, root).select(
        "path", file_date(F.col("path")).alias("date"), "length", "modification_time"
    )
    files = files.filter(F.col("date").isNotNull())
    if start is not None:
        files = files.filter(F.col("date") >= F.lit(start))
    if end is not None:
        files = files.filter(F.col("date") <= F.lit(end))
    return files


def available_dates(
    spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Distinct dates of the files below ``root``, in order."""
    return dated_files(spark, root, start, end).select("date").distinct().orderBy("date")


def date_range(spark: SparkSession, root: str) -> DataFrame:
    """One row (first_date, last_date); both null where there are no files."""
    return dated_files(spark, root).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def new_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files whose path is not in ``loaded``."""
    return files.join(loaded.select("path"), "path", "left_anti")


def read_paths(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Bars of the given files or folders with ``path`` and the text of unreadable rows.

    The schema is fixed and the header must match it: a file with other columns fails
    instead of being read into the wrong ones (see :func:`read_by_name`).
    """
    return (
        spark.read.schema(LANDED_CSV)
        .options(**CSV_OPTIONS)
        .csv(paths)
        .withColumn("path", F.col("_metadata.file_path"))
    )


def readable_row() -> Column:
    """Lines that parse and say which bar they are of."""
    return (
        F.col(CORRUPT).isNull() & F.col("ticker").isNotNull() & F.col("window_start").isNotNull()
    )


def read_bars(
    spark: SparkSession, root: str, dates: list[dt.date] | None = None
) -> DataFrame:
    """Bars as landed (nanosecond epoch), of all files below ``root`` or of some dates.

    Only the paths of the dates pass the driver, of which a calendar has few.
    """
    if dates is None:
        rows = read_paths(spark, root)
    else:
        wanted = dated_files(spark, root).filter(F.col("date").isin(dates))
        paths = [r.path for r in wanted.select("path").toLocalIterator()]
        if not paths:
            return spark.createDataFrame([], BARS_CSV)
        rows = read_paths(spark, paths)
    return rows.filter(readable_row()).select(*BARS_CSV.names)


def rows_per_file(spark: SparkSession, root: str) -> DataFrame:
    """Rows of each file, the header not counted."""
    return (
        spark.read.text(root, recursiveFileLookup=True, pathGlobFilter=PATTERN)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg((F.count("*") - 1).alias("row_count"))
    )


def read_by_name(spark: SparkSession, path: str) -> DataFrame:
    """One file whose columns stand in another order or among others, as :func:`read_paths` gives
    files. A value that does not parse makes its line unreadable."""
    rows = spark.read.options(**{**CSV_OPTIONS, "enforceSchema": True}).csv(path)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in BARS_CSV}
    bad = reduce(or_, [F.col(c).isNotNull() & value.isNull() for c, value in typed.items()])
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in typed])
    return rows.select(
        *[value.alias(c) for c, value in typed.items()],
        F.when(bad, line).alias(CORRUPT),
        F.col("_metadata.file_path").alias("path"),
    )


# What Spark says of files that it cannot read, whatever else may go wrong in a job.
HEADER_ERRORS = ("CSV header does not conform", "Number of column in CSV header")
READ_ERRORS = (
    *HEADER_ERRORS, "FAILED_READ_FILE", "EOFException", "ZipException", "not a gzip file",
    "incorrect header check", "invalid stored block", "invalid code lengths", "invalid distance",
    "invalid block type", "incorrect data check",
)


def is_read_error(error: Exception) -> bool:
    return any(said in str(error) for said in READ_ERRORS)


def unreadable_files(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Those of the files that :func:`read_paths` cannot read, with ``header`` or ``damaged``.

    The reader that loads them is asked: a list that fails is halved until single files are
    left, so a few broken files cost a few passes over their neighbours.
    """
    try:
        read_paths(spark, paths).write.format("noop").mode("overwrite").save()
        return {}
    except (PySparkException, Py4JJavaError) as error:
        if not is_read_error(error):
            raise
        if len(paths) == 1:
            return {paths[0]: "header" if any(said in str(error) for said in HEADER_ERRORS) else "damaged"}
    middle = len(paths) // 2
    return unreadable_files(spark, paths[:middle]) | unreadable_files(spark, paths[middle:])


def has_all_columns(spark: SparkSession, path: str) -> bool:
    """Whether a file's header names every column of a bar."""
    try:
        found = spark.read.option("header", True).csv(path).columns
    except (PySparkException, Py4JJavaError) as error:
        if not is_read_error(error):
            raise
        return False
    return set(BARS_CSV.names) <= set(found)
