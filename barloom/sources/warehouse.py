"""The six tables as Parquet folders.

Layout: ``<root>/<table>/v00001``, and a marker ``<root>/<table>/_versions/v00001`` once that
version is whole; readers take the highest marked version. Markers are created and never
changed, so a lost job leaves the version before it in place, and a job may rebuild a table
from the table itself. Appending adds to the current version. One writer per table at a time.

Tables by ticker are partitioned by a hash bucket of the ticker. Replacing some tickers writes
their buckets only, into a new version whose marker names the folders that make it up: the
new ones and those of earlier versions that stay. No file moves, and readers of the version
before go on with it. Replacing rows from a year on leaves the folders of earlier years.

Bars as landed are partitioned by ``source`` (the file's date) and by ``trade_date``. Writing
a source again replaces the whole source: the new rows are written aside and then take the
place of the folder. A source that is lost between these steps is not there, so the next
ingest loads it again. Bars written directly, without a file, share a folder for each month.
Derived tables are partitioned by ``ticker_bucket`` and ``trade_year``. Rows reach the
writer by one rebalancing shuffle on the partition columns: large days and months are cut
into several files, small ones share a task, and the input is computed once (range
partitioning would run it a second time to sample it). Files are sorted by their keys, so a
single ticker is found by row-group, dictionary and page statistics; partitioning by ticker
would make one small file per ticker and load. Columns that scans look up by equality have Bloom
filters, as large as their distinct values need: where there are too many for a dictionary, as of
option contracts, and they are not the sort key, row groups without the value are skipped by these.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from barloom.operators import bars as bar_ops
from barloom.plans.sizing import broadcast_if_small
from barloom.schemas import TABLES, Table, conform, ticker_bucket
from barloom.session import use_utc

SOURCE = "source"
DIRECT = "direct"
#: Sizes of a Bloom filter to choose from, each half of the one before, from 1 MB on.
FILTER_SIZES = 11


class Warehouse:
    """Scans and writes of the tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = use_utc(spark)
        self.root = root.rstrip("/")

    # -- versions -----------------------------------------------------------------------

    def _path(self, text: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(text)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        """Names in a folder, in order; none if it does not exist."""
        path, fs = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _current(self, table: str) -> str | None:
        marked = [n for n in self._names(f"{self.root}/{table}/_versions") if n.startswith("v")]
        return f"{self.root}/{table}/{marked[-1]}" if marked else None

    def _next(self, table: str) -> str:
        used = [int(n[1:]) for n in self._names(f"{self.root}/{table}") if n.startswith("v") and n[1:].isdigit()]
        return f"{self.root}/{table}/v{max(used, default=0) + 1:05d}"

    def _publish(self, table: str, version: str, folders: list[str] | None = None) -> None:
        """Mark a version; ``folders``, below the table, make it up if it is not its own folder alone."""
        name = version.rsplit("/", 1)[1]
        marker, fs = self._path(f"{self.root}/{table}/_versions/{name}")
        if folders is None:
            fs.create(marker, False).close()
            return
        aside, _ = self._path(f"{self.root}/{table}/_versions/_{name}-{uuid.uuid4().hex[:12]}")
        out = fs.create(aside, False)
        out.write(bytearray("\n".join(folders).encode()))
        out.close()
        if not fs.rename(aside, marker):
            raise OSError(f"cannot publish {version}")

    def folders(self, table: str, version: str | None = None) -> list[str]:
        """The folders below the table, such as ``v00001`` or ``v00002/ticker_bucket=3``, that make up a
        version (the current one if None)."""
        current = version or (self._current(table) or "").rsplit("/", 1)[-1]
        if not current:
            return []
        marker, fs = self._path(f"{self.root}/{table}/_versions/{current}")
        if not fs.getFileStatus(marker).getLen():
            return [current]
        stream = fs.open(marker)
        text = bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        stream.close()
        return text.split("\n")

    def drop_old_versions(self, table: str, keep: int = 2) -> list[str]:
        """Delete all but the last ``keep`` marked versions, which readers may still have open; folders
        that these are made of stay."""
        marked = [n for n in self._names(f"{self.root}/{table}/_versions") if n.startswith("v")]
        old, kept = marked[: -max(1, keep)], marked[-max(1, keep) :]
        needed = {f for name in kept for f in self.folders(table, name)}
        for name in [n for n in self._names(f"{self.root}/{table}") if n.startswith("v") and n < min(kept, default="")]:
            for folder in (f"_versions/{name}", *self._unneeded(table, name, needed)):
                path, fs = self._path(f"{self.root}/{table}/{folder}")
                fs.delete(path, True)
        return old

    def _unneeded(self, table: str, folder: str, needed: set[str]) -> list[str]:
        """The topmost folders at or below ``folder`` that hold none of the needed ones."""
        if folder in needed:
            return []
        if not any(f.startswith(f"{folder}/") for f in needed):
            return [folder]
        return [g for n in self._names(f"{self.root}/{table}/{folder}") for g in self._unneeded(table, f"{folder}/{n}", needed)]

    def sources(self, table: str) -> list[str]:
        """Names of the sources that a landed table holds: a few per date."""
        current = self._current(table)
        names = self._names(current) if current else []
        return [n.removeprefix(f"{SOURCE}=") for n in names if n.startswith(f"{SOURCE}=")]

    def _swap_in(self, staged: str, target: str, sources: list[str]) -> None:
        """Folders of sources in ``staged`` take the place of those in ``target``; further
        ``sources`` of the target go, with what streams wrote under their names."""
        new = [n for n in self._names(staged) if n.startswith(f"{SOURCE}=")]
        gone = {*new, *(f"{SOURCE}={s}" for s in sources)}
        for name in self._names(target):
            if name in gone or any(name.startswith(f"{g}_b") for g in gone):
                path, fs = self._path(f"{target}/{name}")
                fs.delete(path, True)
        for name in new:
            path, fs = self._path(f"{staged}/{name}")
            if not fs.rename(path, self._path(f"{target}/{name}")[0]):
                raise OSError(f"cannot move {staged}/{name}")
        path, fs = self._path(staged)
        fs.delete(path, True)

    def exists(self, table: str) -> bool:
        return self._current(table) is not None

    # -- scans --------------------------------------------------------------------------

    def scan(
        self,
        table: str,
        ticker: str | None = None,
        start: dt.date | dt.datetime | None = None,
        end: dt.date | dt.datetime | None = None,
        underlying_symbol: str | None = None,
        active_only: bool = False,
    ) -> DataFrame:
        """A lazily filtered table; empty with the right schema if it does not exist.

        Dates bound the UTC date of the table's date column, datetimes the column itself,
        both inclusive. Bounds on time also become bounds on the partition column.
        """
        spec = TABLES[table]
        stored = self._stored(table)
        if ticker is not None:
            stored = stored.filter(F.col("ticker") == ticker)
            if spec.bucketed:
                stored = stored.filter(F.col("ticker_bucket") == ticker_bucket(F.lit(ticker)))
        if underlying_symbol is not None:
            stored = stored.filter(F.col("underlying_symbol") == underlying_symbol)
        if active_only:
            stored = stored.filter(F.col("active"))
        for bound, is_start in ((start, True), (end, False)):
            if bound is not None:
                stored = stored.filter(_bound(spec, bound, is_start))
        return stored.select(*spec.schema.names)

    def _stored(self, table: str, folders: list[str] | None = None) -> DataFrame:
        """All stored columns of the current version, or of some of its folders."""
        schema, versions = TABLES[table].stored_schema, {}
        for folder in self.folders(table) if folders is None else folders:
            versions.setdefault(folder.split("/")[0], []).append(f"{self.root}/{table}/{folder}")
        if not versions:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema)
        parts = [read.option("basePath", f"{self.root}/{table}/{v}").parquet(*paths) for v, paths in versions.items()]
        return reduce(DataFrame.union, parts)

    def loaded_dates(self, table: str) -> DataFrame:
        """Distinct trading dates of a landed table.

        That is the date of the source file where there is one, from the partition values alone, else
        the UTC date, for which the bars written directly are read.
        """
        stored = self._stored(table)
        named = F.try_to_date(F.substring(SOURCE, 1, 10), "yyyy-MM-dd")
        landed = stored.filter(F.col(SOURCE) != DIRECT).select(F.coalesce(named, F.col("trade_date")).alias("date"))
        direct = stored.filter(F.col(SOURCE) == DIRECT).select(F.to_date(TABLES[table].date_column).alias("date"))
        return landed.distinct().union(direct.distinct()).distinct()

    def register_views(self) -> None:
        """Temporary views of all tables, for ``spark.sql``."""
        for table in TABLES:
            self.scan(table).createOrReplaceTempView(table)

    def stats(self) -> DataFrame:
        """Rows and date range of the tables that exist."""
        present = {t: (self.scan(t), spec.date_column) for t, spec in TABLES.items() if self.exists(t)}
        if not present:
            present = {"stocks_raw": (self.scan("stocks_raw"), "window_start")}
            return bar_ops.table_stats(present).filter("row_count > 0")
        return bar_ops.table_stats(present)

    # -- writes -------------------------------------------------------------------------

    def write(
        self, df: DataFrame, table: str, mode: str | None = None, sources: list[str] | None = None
    ) -> None:
        """Cast to the table's schema and write.

        ``append`` adds rows, ``overwrite`` replaces the table, and ``replace`` (tables of
        landed bars) replaces the sources in ``df`` as a whole: writing the same file twice
        leaves it there once, and rows it no longer has are gone. ``sources`` names further
        sources to replace, such as files of which no row was good.
        """
        spec, mode = TABLES[table], mode or TABLES[table].default_mode
        if mode not in ("append", "overwrite", "replace"):
            raise ValueError(f"unknown mode {mode!r}")
        if mode == "replace" and spec.grain != "day":
            raise ValueError(f"{table} is not written by source")
        current = self._current(table)
        own = current is not None and self.folders(table) == [current.rsplit("/", 1)[1]]
        target = current if own and mode != "overwrite" else self._next(table)
        writer = _writer(df, spec)
        if spec.partition_columns:
            writer = writer.partitionBy(*spec.partition_columns)
        if mode == "replace" and target == current:
            staged = f"{target}/_staged-{uuid.uuid4().hex[:12]}"
            writer.parquet(staged)
            self._swap_in(staged, target, sources or [])
        else:
            writer.mode("append").parquet(target)
        if target != current:
            made = self.folders(table) if mode == "append" and current else []
            self._publish(table, target, [*made, target.rsplit("/", 1)[1]] if made else None)

    def replace_tickers(self, new: DataFrame, table: str, tickers: list[str]) -> list[int]:
        """Replace the rows of some tickers and keep all others; the buckets that were written.

        Other buckets are neither read nor written: the new version names their folders.
        """
        if not TABLES[table].bucketed:
            raise ValueError(f"{table} is not laid out by ticker")
        wanted = self.spark.createDataFrame([(t,) for t in tickers], "ticker string")
        touched = sorted(r.b for r in wanted.select(ticker_bucket(F.col("ticker")).alias("b")).distinct().collect())  # at most BUCKETS
        if not touched:
            return []
        held = self._stored(table).filter(F.col("ticker_bucket").isin(touched))
        spec = TABLES[table]
        kept = held.filter(~F.coalesce(F.col("ticker").isin(tickers), F.lit(False)))
        rows = spec.rows(kept).unionByName(spec.rows(new.filter(F.col("ticker").isin(tickers))))
        stay = [f for folder in self.folders(table) for f in self._inner(table, folder, 1) if _bucket(f) not in touched]
        self._add_version(rows, table, stay)
        return touched

    def replace_since(self, new: DataFrame, table: str, since: DataFrame) -> dict[str, int]:
        """Replace the rows of each ticker in ``since`` from the year of its date ``since`` on.

        ``since`` has each ticker once; ``new`` has the rows that take the place. Folders of other buckets and
        of earlier years are neither read nor written: the new version names them. Returns how many folders
        were written and how many stay.
        """
        spec = TABLES[table]
        if spec.grain != "year":
            raise ValueError(f"{table} is not laid out by ticker and year")
        begin = F.trunc("since", "year")
        lows = since.groupBy(ticker_bucket(F.col("ticker")).alias("b")).agg(F.min(begin).alias("low"))
        low = {r.b: r.low.isoformat() for r in lows.collect()}  # at most BUCKETS rows
        stay, touched = [], []
        for folder in self.folders(table):
            for bucket in self._inner(table, folder, 1):
                if _bucket(bucket) not in low:
                    stay.append(bucket)
                    continue
                for leaf in self._inner(table, bucket, 2):
                    year = leaf.rsplit("trade_year=", 1)[1]
                    (touched if year[:1].isdigit() and year >= low[_bucket(bucket)] else stay).append(leaf)
        marked = broadcast_if_small(since.select(F.col("ticker").alias("_ticker"), begin.alias("_since")))
        gone = F.col("ticker").eqNullSafe(F.col("_ticker")) & (F.col("trade_year") >= F.col("_since"))
        rows = spec.rows(self._stored(table, touched).join(marked, gone, "left_anti")).unionByName(spec.rows(new))
        written = self._add_version(rows, table, stay)
        return {"folders_written": len(written), "folders_kept": len([f for s in stay for f in self._inner(table, s, 2)])}

    def _add_version(self, rows: DataFrame, table: str, stay: list[str]) -> list[str]:
        """Write ``rows`` as a version that also names the folders that stay; the folders written."""
        target, spec = self._next(table), TABLES[table]
        _writer(rows, spec).partitionBy(*spec.partition_columns).parquet(target)
        written = self._inner(table, target.rsplit("/", 1)[1], 1)
        self._publish(table, target, [*stay, *written] or None)
        return [f for w in written for f in self._inner(table, w, len(spec.partition_columns))]

    def _inner(self, table: str, folder: str, depth: int) -> list[str]:
        """A folder of a version as its folders of ``depth`` partition columns (itself if it is one already)."""
        if folder.count("/") >= depth:
            return [folder]
        names = [n for n in self._names(f"{self.root}/{table}/{folder}") if "=" in n]
        return [f for n in names for f in self._inner(table, f"{folder}/{n}", depth)]

    def years(self, table: str) -> list[int]:
        """Years that a table by ticker and year holds, in order, from its folders' names."""
        leaves = [f for folder in self.folders(table) for f in self._inner(table, folder, 2)]
        found = (re.search(r"trade_year=([0-9]+)", f) for f in leaves)
        return sorted({int(m.group(1)) for m in found if m})


def _bucket(folder: str) -> int:
    return int(re.search(r"ticker_bucket=([0-9]+)", folder).group(1))


def _bound(spec: Table, bound: dt.date | dt.datetime, is_start: bool) -> Column:
    """``column`` on the right side of ``bound``, as a comparison that reaches the scan."""
    column = F.col(spec.date_column)
    if isinstance(bound, dt.datetime) and bound.tzinfo is not None:
        bound = bound.astimezone(dt.timezone.utc).replace(tzinfo=None)
    day = bound.date() if isinstance(bound, dt.datetime) else bound
    if spec.date_column == "execution_date":
        condition = column >= F.lit(day) if is_start else column <= F.lit(day)
    elif isinstance(bound, dt.datetime):
        condition = column >= _instant(bound) if is_start else column <= _instant(bound)
    elif is_start:
        condition = column >= _instant(day)
    else:
        condition = column < _instant(day + dt.timedelta(days=1))
    if spec.grain in ("day", "year"):
        partition = F.col(spec.partition_columns[-1])
        within = lambda edge: partition >= F.lit(edge) if is_start else partition <= F.lit(edge)
        if spec.grain == "year":
            condition = condition & within(day.replace(month=1, day=1))
        else:  # bars written directly lie at the first of their month
            direct = F.col(SOURCE) == DIRECT
            condition = condition & ((direct & within(day.replace(day=1))) | (~direct & within(day)))
    return condition


def _instant(moment: dt.date | dt.datetime) -> Column:
    """A UTC literal; as text, since Python would apply the machine's own time zone."""
    return F.lit(moment.isoformat()).cast("timestamp")


def _writer(df: DataFrame, spec: Table) -> DataFrameWriter:
    """A writer of the table's files."""
    writer = _laid_out(df, spec).write.option("compression", "zstd")
    for name in spec.lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.candidates.number#{name}", FILTER_SIZES)
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true") if spec.lookups else writer


def _laid_out(df: DataFrame, spec: Table) -> DataFrame:
    """Conformed rows with partition columns, distributed and sorted for writing."""
    rows = conform(df, spec.schema)
    if spec.grain is None:
        return rows.hint("rebalance")
    date = F.to_date(F.col(spec.date_column))
    if spec.grain == "day":
        direct = SOURCE not in df.columns
        source = F.lit(DIRECT) if direct else F.col(SOURCE)
        landed = df.withColumn(SOURCE, source).withColumn("trade_date", F.trunc(date, "month") if direct else date)
        rows = conform(landed, spec.stored_schema)
    else:
        rows = spec.rows(df).withColumn("ticker_bucket", ticker_bucket(F.col("ticker")))
        if spec.grain == "year":
            rows = rows.withColumn("trade_year", F.trunc(date, "year"))
    columns = spec.partition_columns
    return rows.hint("rebalance", *columns).sortWithinPartitions(*columns, *spec.sort_keys)
