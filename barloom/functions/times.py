"""Epoch, ISO and file-name times as column expressions (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a bar file is named YYYY-MM-DD.csv.gz; a file that Spark wrote is a part
# file below a folder ``<name>=YYYY-MM-DD``.
FILE_DATE = r"([0-9]{4}-[0-9]{2}-[0-9]{2})(?:\.csv\.gz|/part-[^/]*\.csv\.gz)\z"


def ns_to_ts(ns: Column) -> Column:
    """Nanoseconds since the epoch to a timestamp cut to milliseconds."""
    return F.timestamp_millis(F.call_function("div", ns, F.lit(1_000_000)))


def ns_to_ts_micros(ns: Column) -> Column:
    """Nanoseconds since the epoch to a timestamp cut to microseconds."""
    return F.timestamp_micros(F.call_function("div", ns, F.lit(1_000)))


def ms_to_ts(ms: Column) -> Column:
    """Milliseconds since the epoch to a timestamp."""
    return F.timestamp_millis(ms)


# A whole date, perhaps a time to the minute or finer, perhaps an offset.
ISO_SHAPE = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?\z"
)


def iso_to_ts(text: Column) -> Column:
    """ISO-8601 text to a timestamp, null where it cannot be read.

    The shape is checked first: Spark completes a time without a date by today's.
    """
    return F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(text))


def file_date(path: Column) -> Column:
    """The trading date in a file's path, null where there is none."""
    return F.try_to_date(F.regexp_extract(path, FILE_DATE, 1), "yyyy-MM-dd")
