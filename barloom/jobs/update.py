"""The jobs a user runs: daily update, bulk load, gap check, verification, readiness.

Fixed values: the keys of the reports are those that users of the jobs read.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.jobs.ingest import ingest_missing
from barloom.jobs.rebuild import sync_splits, sync_tickers
from barloom.jobs.refresh import refresh
from barloom.operators.calendar import nyse_holidays, ready_dates, trading_day_gaps
from barloom.operators.checks import CheckFailure, price_checks, summarize_checks
from barloom.sources.flatfiles import available_dates
from barloom.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Feeds:
    """Where the inputs of an update are: two folders of bar files and vendor extracts."""

    stocks: str
    options: str
    splits: DataFrame
    tickers: DataFrame
    reference_prices: DataFrame
    holidays: DataFrame | None = None


def fill_gaps(
    wh: Warehouse, root: str, holidays: DataFrame | None = None, readjust: bool = True
) -> dict[str, int]:
    """Load trading days that are missing between the first and last loaded date, and bring
    adjusted prices and indicators up to date if any were found.

    Without ``holidays`` (a frame with ``date``) the exchange's rules tell them, for the
    years of the loaded dates.
    """
    loaded = wh.loaded_dates("stocks_raw")
    years = loaded.agg(F.year(F.min("date")).alias("first"), F.year(F.max("date")).alias("last")).first()
    if years.first is None:
        return {"gaps_found": 0, "dates_filled": 0, "raw_rows_added": 0}
    if holidays is None:
        holidays = nyse_holidays(wh.spark, years.first, years.last)
    gaps = [r.date for r in trading_day_gaps(loaded, holidays).toLocalIterator()]
    if not gaps:
        return {"gaps_found": 0, "dates_filled": 0, "raw_rows_added": 0}
    filled = ingest_missing(wh, "stocks", root, only=gaps)
    if readjust and filled["rows"]:
        refresh(wh)
    return {
        "gaps_found": len(gaps),
        "dates_filled": filled["files_processed"],
        "raw_rows_added": filled["rows"],
    }


def verify(
    wh: Warehouse,
    reference: DataFrame,
    n: int = 10,
    days_back: int = 365,
    seed: int = 0,
    as_of: dt.date | None = None,
    strict: bool = True,
) -> dict[str, int]:
    """Compare adjusted closes with the vendor's around the splits of ``n`` tickers.

    Raises :class:`CheckFailure` if a close differs and ``strict`` is set; that nothing could be compared shows
    as ``dates_checked`` 0.
    """
    end = as_of or dt.date.today()
    start = end - dt.timedelta(days=days_back)
    # The dates around the splits: a scan of those months only.
    adjusted = wh.scan(
        "stocks_adjusted", start=start - dt.timedelta(days=30), end=end + dt.timedelta(days=1)
    )
    checks = price_checks(adjusted, wh.scan("splits"), reference, n, seed, start, end)
    total = summarize_checks(checks).filter("ticker is null").first().asDict()
    total.pop("ticker")
    if strict and total["failed"]:
        raise CheckFailure(f"{total['failed']} of {total['dates_checked']} closes differ: {total}")
    return total


def new_data_ready(
    wh: Warehouse, stocks_root: str, options_root: str, as_of: dt.date | None = None
) -> DataFrame:
    """Dates of this year and last that both feeds offer beyond what is loaded, in order.

    The first row is the next date to load; without rows there is nothing to do yet.
    """

    def last(table: str) -> dt.date | None:
        return wh.loaded_dates(table).agg({"date": "max"}).first()[0]

    return ready_dates(
        available_dates(wh.spark, stocks_root),
        available_dates(wh.spark, options_root),
        last("stocks_raw"),
        last("options"),
        (as_of or dt.date.today()).year - 1,
    )


def daily_update(
    wh: Warehouse,
    feeds: Feeds,
    check_tickers: int = 5,
    days_back: int = 365,
    as_of: dt.date | None = None,
) -> dict[str, object]:
    """Load what is new, bring what depends on it up to date, verify, and report per step.

    Splits and gap filling come before the adjustment and the indicators after it, so one
    run leaves all tables consistent, on an empty warehouse as well (the bulk load).
    """
    report: dict[str, object] = {}
    report["stocks"] = ingest_missing(wh, "stocks", feeds.stocks)
    report["gaps"] = fill_gaps(wh, feeds.stocks, feeds.holidays, readjust=False)
    report["splits"] = sync_splits(wh, feeds.splits)
    report["refresh"] = refresh(wh)
    report["adjusted"] = wh.scan("stocks_adjusted").count()
    report["technical"] = wh.scan("stocks_technical").count()
    report["options"] = ingest_missing(wh, "options", feeds.options)
    report["tickers"] = sync_tickers(wh, feeds.tickers)
    report["checks"] = verify(wh, feeds.reference_prices, check_tickers, days_back, as_of=as_of)
    report["tables"] = {r.table_name: r.row_count for r in wh.stats().toLocalIterator()}
    return report


bulk_load = daily_update
