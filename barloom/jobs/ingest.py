"""Loading landed bar files into the raw stock and option tables.

Fixed values: the keys of the reports are those that users of the jobs read.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from barloom.functions.symbols import strip_prefix
from barloom.functions.times import file_date
from barloom.operators.bars import typed_bars
from barloom.operators.calendar import missing_dates
from barloom.operators.options import parse_option_tickers
from barloom.plans.filters import keep_where
from barloom.schemas import CORRUPT
from barloom.sources import flatfiles
from barloom.sources.warehouse import SOURCE, Warehouse

TABLE_OF = {"stocks": "stocks_raw", "options": "options"}


def landed_rows(files: DataFrame, kind: str) -> DataFrame:
    """Typed rows of landed files with ``reject``: null, ``row`` or (options) ``symbol``.

    ``row`` marks lines that do not parse or lack ticker or time, negative counts, which
    the tables' unsigned types rule out, and volumes that are no whole number of 64 bits.
    """
    negative = (F.col("volume") < 0) | (F.col("transactions") < 0)
    count = F.col("volume").try_cast("long")
    no_count = F.col("volume").isNotNull() & (count.isNull() | F.isnan(F.col("volume").cast("double")))
    bad_row = ~flatfiles.readable_row() | F.coalesce(negative, F.lit(False)) | no_count
    rows = typed_bars(files).withColumn(
        SOURCE, F.date_format(file_date(F.col("path")), "yyyy-MM-dd")
    )
    reject = F.when(bad_row, "row")
    if kind == "options":
        rows = parse_option_tickers(rows)
        reject = reject.when(~F.col("parse_ok"), "symbol")
        rows = rows.withColumn("reject", reject).withColumn("ticker", strip_prefix(F.col("ticker")))
    else:
        rows = rows.withColumn("reject", reject)
    return rows.withColumn("volume", count)


def rejected_rows(
    wh: Warehouse, kind: str, root: str, dates: list[dt.date] | None = None
) -> DataFrame:
    """The rows of landed files that a load leaves out, as landed, with the reason."""
    files = [path for path, _ in _files(wh, root, dates)]
    rows = landed_rows(flatfiles.read_paths(wh.spark, files), kind)
    return keep_where(rows, F.col("reject").isNotNull()).select("path", "ticker", CORRUPT, "reject")


REFUSED = "path string, length long, modification_time timestamp"


def refused_files(wh: Warehouse) -> DataFrame:
    """Files that a load could not read. One that changes is tried again."""
    folder = f"{wh.root}/_refused"
    path, fs = wh._path(folder)
    if not fs.exists(path):
        return wh.spark.createDataFrame([], REFUSED)
    return wh.spark.read.schema(REFUSED).parquet(folder)


def _refuse(wh: Warehouse, root: str, paths: list[str]) -> None:
    found = flatfiles.list_files(wh.spark, root).filter(F.col("path").isin(paths))
    found.select("path", "length", "modification_time").coalesce(1).write.mode("append").parquet(f"{wh.root}/_refused")


def _files(wh: Warehouse, root: str, dates: list[dt.date] | None) -> list[tuple[str, dt.date]]:
    files = flatfiles.dated_files(wh.spark, root)
    if dates is not None:
        files = files.filter(F.col("date").isin(dates))
    files = files.join(refused_files(wh), ["path", "length", "modification_time"], "left_anti")
    return [(r.path, r.date) for r in files.select("path", "date").orderBy("path").toLocalIterator()]


def _write(wh: Warehouse, kind: str, files: list[tuple[str, dt.date]], by_name: set[str] = frozenset()) -> dict[str, int]:
    seen = Observation()
    plain = [path for path, _ in files if path not in by_name]
    parts = [flatfiles.read_paths(wh.spark, plain)] if plain else []
    parts += [flatfiles.read_by_name(wh.spark, path) for path in sorted(by_name)]
    rows = landed_rows(reduce(DataFrame.unionByName, parts), kind)
    counts = (
        F.count_if(F.col("reject").isNull()).alias("rows"),
        F.count_if(F.col("reject") == "symbol").alias("parse_errors"),
        F.count_if(F.col("reject") == "row").alias("bad_rows"),
    )
    counted = rows.observe(seen, *counts)
    sources = sorted({date.isoformat() for _, date in files})
    wh.write(keep_where(counted, F.col("reject").isNull()), TABLE_OF[kind], "replace", sources)
    try:
        return dict(seen.get)
    except Py4JJavaError:  # without any good row the planner drops the counters with the rows
        return rows.agg(*counts).first().asDict()


def load_dates(
    wh: Warehouse, kind: str, root: str, dates: list[dt.date] | None = None
) -> dict[str, int]:
    """Load the files of the dates (all if None) in one read and one write.

    Only if that fails because of files, these are looked for: files with the columns in
    another order are read by name, the others are left out, counted, and not tried again
    until they change. The counts are for reports; they come from the tasks themselves and
    may be too high where lost tasks ran twice.
    """
    files = _files(wh, root, dates)
    errors = 0
    counts = {"rows": 0, "parse_errors": 0, "bad_rows": 0}
    if files:
        try:
            counts = _write(wh, kind, files)
        except (PySparkException, Py4JJavaError) as error:
            if not flatfiles.is_read_error(error):
                raise
            broken = flatfiles.unreadable_files(wh.spark, [path for path, _ in files])
            if not broken:
                raise
            by_name = {p for p, why in broken.items() if why == "header" and flatfiles.has_all_columns(wh.spark, p)}
            refused = set(broken) - by_name
            files = [f for f in files if f[0] not in refused]
            errors = len(refused)
            if refused:
                _refuse(wh, root, sorted(refused))
            if files:
                counts = _write(wh, kind, files, by_name)
    return {"files_processed": len(files), "errors": errors, **counts}


def ingest_missing(
    wh: Warehouse, kind: str, root: str, only: list[dt.date] | None = None
) -> dict[str, int]:
    """Load the dates that have a file and are not in the table yet."""
    available = flatfiles.available_dates(wh.spark, root)
    missing = missing_dates(available, wh.loaded_dates(TABLE_OF[kind]))
    if only is not None:
        missing = missing.filter(F.col("date").isin(only))
    dates = [r.date for r in missing.toLocalIterator()]
    if not dates:
        return {"files_processed": 0, "errors": 0, "rows": 0, "parse_errors": 0, "bad_rows": 0}
    return load_dates(wh, kind, root, dates)
