"""Bringing adjusted prices and indicators up to date with what has changed, without a rebuild.

A record beside the tables says which raw files and which splits they reflect. From it follows
the range that is out of date: a ticker with bars in new or changed date folders from the first
of their dates on, a ticker whose splits changed as a whole. Only the years from there on, in
the buckets of these tickers, are computed and written. Indicators go on from the stored state
of the year before: the last bars that the windows reach, and the average true range in double
precision, which stands for all earlier bars.

The record is written last, so a refresh that is lost is done again by the next one, with the
same result.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.operators.bars import dedupe_bars
from barloom.operators.splits import adjust_prices
from barloom.operators.technical import continued_indicators, technical_indicators
from barloom.plans.series import MAX_ROWS
from barloom.plans.sizing import broadcast_if_small
from barloom.session import materialize
from barloom.sources.flatfiles import list_files
from barloom.sources.warehouse import Warehouse

RECORD = "_refreshed"
BEGIN = dt.date(1000, 1, 1)
# Bars before the first new one that a window of 200 reaches, with those the range needs.
REACH = 203
# Up to so many tickers are named in the filter, where the reader can skip row groups by them.
NAMED = 500
RECORD_SCHEMA = "trade_date date, digest long, id string, ticker string, execution_date date, split_factor double"


def refresh(wh: Warehouse) -> dict[str, int]:
    """Update ``stocks_adjusted`` and ``stocks_technical`` after loads and syncs of splits.

    The first refresh of a warehouse builds both tables. Afterwards they equal a full rebuild, but for the
    last bits of the average true range. The report counts tickers that were out of date, and folders of the
    two tables that were written or kept as they are.
    """
    now = materialize(_state(wh), "refresh-state")
    since = materialize(stale_since(wh, now), "stale")
    report = {"tickers": since.count(), "folders_written": 0, "folders_kept": 0}
    if report["tickers"]:
        first = not (wh.exists("stocks_adjusted") and wh.exists("stocks_technical"))
        raw = _rows_since(wh, "stocks_raw", since)
        adjusted = adjust_prices(dedupe_bars(raw), wh.scan("splits"))
        parts = [wh.replace_since(adjusted, "stocks_adjusted", since)]
        whole = technical_indicators(wh.scan("stocks_adjusted")) if first else _indicators_since(wh, since)
        parts.append(wh.replace_since(whole, "stocks_technical", since))
        for name in ("folders_written", "folders_kept"):
            report[name] = sum(p[name] for p in parts)
    version = wh._next(RECORD)
    now.coalesce(1).write.parquet(version)
    wh._publish(RECORD, version)
    return report


def _state(wh: Warehouse) -> DataFrame:
    """What the tables depend on: a digest of the raw files of each date folder, and the splits."""
    nothing = wh.spark.createDataFrame([], RECORD_SCHEMA)
    roots = [f"{wh.root}/stocks_raw/{f}" for f in wh.folders("stocks_raw")]
    files = [list_files(wh.spark, root, "*.parquet").select("path") for root in roots]
    if files:
        date = F.regexp_extract("path", "/trade_date=([0-9-]{10})/", 1).try_cast("date")
        found = reduce(DataFrame.union, files).groupBy(date.alias("trade_date"))
        nothing = nothing.unionByName(found.agg(F.bit_xor(F.xxhash64("path")).alias("digest")), allowMissingColumns=True)
    splits = wh.scan("splits").select("id", "ticker", "execution_date", "split_factor")
    return nothing.unionByName(splits, allowMissingColumns=True)


def stale_since(wh: Warehouse, now: DataFrame) -> DataFrame:
    """Tickers that are out of date, once each, with the first day from which they are (``since``)."""
    current = wh._current(RECORD)
    then = wh.spark.read.schema(RECORD_SCHEMA).parquet(current) if current else now.limit(0)
    if not (wh.exists("stocks_adjusted") and wh.exists("stocks_technical")):
        then = now.limit(0)
    dates = lambda state: state.filter("digest is not null").select("trade_date", "digest")
    before = dates(then).withColumnRenamed("digest", "_old")
    pairs = dates(now).join(before, "trade_date", "full").filter("not (digest <=> _old)")
    changed = [(r.trade_date, r._old is not None) for r in pairs.collect()]  # one row per date of the calendar
    found = []
    if changed:
        days = [d for d, _ in changed]
        added = wh._stored("stocks_raw").filter(F.col("trade_date").isin(days))
        found.append(added.select("ticker", F.to_date("window_start").alias("since")))
    held = [d for d, known in changed if known]
    if held:  # bars that have gone from a date; bars written directly lie at the first of their month
        day = F.to_date("window_start")
        last = max(held).replace(day=28) + dt.timedelta(days=4)
        gone = wh.scan("stocks_adjusted", start=min(held), end=last)
        firsts = [d for d in held if d.day == 1]
        gone = gone.filter(day.isin(held) | F.trunc(day, "month").isin(firsts))
        found.append(gone.select("ticker", day.alias("since")))
    splits = lambda state: state.filter("digest is null").select("id", "ticker", "execution_date", "split_factor")
    other = splits(now).exceptAll(splits(then)).union(splits(then).exceptAll(splits(now)))
    found.append(other.select("ticker", F.lit(BEGIN).alias("since")))
    rows = reduce(DataFrame.union, found).groupBy("ticker").agg(F.min("since").alias("since"))
    return rows.select("ticker", F.trunc(F.coalesce("since", F.lit(BEGIN)), "year").alias("since"))


def _same_ticker(other: str = "_ticker") -> Column:
    return F.col("ticker").eqNullSafe(F.col(other))


def _named(rows: DataFrame, tickers: DataFrame) -> DataFrame:
    """``rows`` with a filter of the tickers' names, if these are few: the reader skips by it."""
    few = [r.ticker for r in tickers.select("ticker").limit(NAMED + 1).collect()]
    if len(few) > NAMED or None in few:
        return rows
    return rows.filter(F.col("ticker").isin(few))


def _rows_since(wh: Warehouse, table: str, since: DataFrame) -> DataFrame:
    """Rows of the tickers from their date on: whole series and recent ones are read apart."""
    parts = []
    for group in (since.filter(F.col("since") <= F.lit(BEGIN)), since.filter(F.col("since") > F.lit(BEGIN))):
        low = group.agg(F.min("since")).first()[0]
        if low is None:
            continue
        rows = _named(wh.scan(table, start=low if low > BEGIN else None), group)
        marked = broadcast_if_small(group.select(F.col("ticker").alias("_ticker"), F.col("since").alias("_since")))
        after = F.coalesce(F.to_date("window_start") >= F.col("_since"), F.col("_since") <= F.lit(BEGIN))
        parts.append(rows.join(marked, _same_ticker() & after, "left_semi"))
    return reduce(DataFrame.unionByName, parts) if parts else wh.scan(table).limit(0)


def _bars_before(wh: Warehouse, since: DataFrame) -> DataFrame:
    """The last ``REACH`` bars of each ticker before its date, fewer if there are no more.

    One year is read first; tickers with fewer bars in it look back twice as far each time.
    """
    first_year, pending, years, parts = min(wh.years("stocks_adjusted"), default=BEGIN.year), since, 1, []
    latest = W.partitionBy("ticker").orderBy(F.desc("window_start"))
    while not pending.isEmpty():
        bounds = pending.agg(F.min("since").alias("low"), F.max("since").alias("high")).first()
        low = max(bounds.low.year - years, BEGIN.year)
        rows = _named(wh.scan("stocks_adjusted", start=dt.date(low, 1, 1), end=bounds.high), pending)
        marked = broadcast_if_small(pending.select(F.col("ticker").alias("_ticker"), F.col("since").alias("_since")))
        within = (F.to_date("window_start") < F.col("_since")) & (F.year("window_start") >= F.year("_since") - years)
        rows = rows.join(marked, _same_ticker() & within, "left_semi")
        rows = rows.withColumn("_back", F.row_number().over(latest)).filter(F.col("_back") <= REACH)
        rows = materialize(rows, "bars-before")
        if low <= first_year:
            parts.append(rows)
            break
        done = rows.filter(F.col("_back") == REACH).select(F.col("ticker").alias("_ticker"))
        done = broadcast_if_small(materialize(done, "looked-back"))
        parts.append(rows.join(done, _same_ticker(), "left_semi"))
        pending = materialize(pending.join(done, _same_ticker(), "left_anti"), "pending")
        years *= 2
    empty = wh.scan("stocks_adjusted").limit(0).withColumn("_back", F.lit(0))
    return reduce(DataFrame.unionByName, parts) if parts else empty


def _indicators_since(wh: Warehouse, since: DataFrame) -> DataFrame:
    """Indicators of each ticker from its date on.

    Whole series are computed anew: where splits changed, where the range that is out of date has too many
    rows for one task, and where the stored state is missing.
    """
    recent = since.filter(F.col("since") > F.lit(BEGIN))
    own = materialize(_rows_since(wh, "stocks_adjusted", recent), "own")
    before = materialize(_bars_before(wh, recent), "before")
    cut = before.filter(F.col("_back") == REACH).select(F.col("ticker").alias("_ticker"))
    last = before.filter("_back = 1").join(broadcast_if_small(cut), _same_ticker(), "left_semi")
    last = last.select(F.col("ticker").alias("_ticker"), F.col("window_start").alias("_last"))
    bounds = last.agg(F.min("_last"), F.max("_last")).first()
    stored = wh._stored("stocks_technical")
    if bounds[0] is not None:
        within = [F.trunc(F.lit(b).cast("timestamp").cast("date"), "year") for b in bounds]
        stored = stored.filter(F.col("trade_year").between(*within))
    state = stored.join(broadcast_if_small(last), _same_ticker() & (F.col("window_start") == F.col("_last")))
    carried = F.coalesce("atr_exact", F.col("atr").cast("double"))
    state = materialize(state.select("_ticker", "_last", carried.alias("_atr")), "carried")
    crowded = own.groupBy("ticker").agg(F.count("*").alias("n")).filter(F.col("n") + REACH > MAX_ROWS)
    lost = last.join(broadcast_if_small(state.select(F.col("_ticker").alias("_known"))), F.expr("_ticker <=> _known"), "left_anti")
    anew = since.filter(F.col("since") <= F.lit(BEGIN)).select("ticker").union(crowded.select("ticker")).union(lost.select("_ticker"))
    anew = materialize(anew.distinct(), "anew")
    whole = broadcast_if_small(anew.select(F.col("ticker").alias("_ticker")))

    rows = own.withColumn("own", F.lit(True)).unionByName(before.drop("_back").withColumn("own", F.lit(False)))
    rows = rows.join(whole, _same_ticker(), "left_anti").join(broadcast_if_small(state), _same_ticker(), "left")
    is_cut = F.col("_last").isNotNull()
    at_last = F.when(F.col("window_start") == F.col("_last"), F.coalesce("_atr", F.lit(0.0))).otherwise(0.0)
    rows = rows.select(
        "ticker", "window_start", "own", "volume",
        *[F.col(c).cast("double").alias(c) for c in ("high", "low", "close")],
        F.when(is_cut, F.lit(MAX_ROWS)).otherwise(0).cast("long").alias("base"),
        (is_cut & F.col("_atr").isNull()).alias("flagged_before"),
        F.when(is_cut & ~F.col("own"), at_last).alias("given"),
    )
    again = wh.scan("stocks_adjusted")
    again = _named(again, anew).join(whole, _same_ticker(), "left_semi")
    made = technical_indicators(again)
    begins = broadcast_if_small(since.select(F.col("ticker").alias("_ticker"), F.col("since").alias("_since")))
    made = made.join(begins, _same_ticker() & F.coalesce(F.to_date("window_start") >= F.col("_since"), F.lit(True)), "left_semi")
    return continued_indicators(rows).unionByName(made)
